"""The driver's entry module imports when PySpark comes from a zip archive."""

import glob
import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_and_oracles_import_from_pyspark_zip():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = sorted(glob.glob(os.path.join(lib, "*.zip")))
    assert zips
    env = dict(os.environ, PYTHONPATH=os.pathsep.join([*zips, ROOT]))
    code = "import pyspark, __spark_entry__ as e; print(pyspark.__file__); print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    where, counts = done.stdout.strip().splitlines()[-2:]
    assert ".zip" in where
    n_queries, n_oracles = map(int, counts.split())
    assert n_queries >= 58 and n_oracles >= 50
