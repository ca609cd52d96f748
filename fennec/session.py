"""Session helpers.

Library code never creates its own session; it takes the caller's.  These
helpers exist for tests, the bench and examples.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def _default_driver_memory() -> str:
    """60% of the machine's memory, at most 16 GB (local mode: the driver is
    the only JVM, and a heap larger than the machine gets the process killed)."""
    try:
        with open("/proc/meminfo") as fh:
            kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        return f"{max(1, min(16, int(kb * 0.6 / 1024 / 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fennec") -> SparkSession:
    """A local session for tests/bench: AQE on, UI off, UTC, Arrow on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FENNEC_DRIVER_MEMORY", _default_driver_memory()))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (unset on a cluster is an error).  Only for a local master without it
    (tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = (
        sc.getConf().get("spark.checkpoint.dir", None)
        or spark.conf.get("spark.checkpoint.dir", None)
        or sc.getCheckpointDir()
    )
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        # a machine-local folder would not survive the loss of that machine
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (fitted state and iteration inputs are written there)")
    path = tempfile.mkdtemp(prefix="fennec-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


_HOMES: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder for written state, in the application's own folder
    under the shared checkpoint folder.  That folder goes when the driver ends:
    what is written there belongs to the running application alone."""
    home = f"{ensure_checkpoint_dir(spark)}/fennec-{spark.sparkContext.applicationId}"
    if home not in _HOMES:
        path = spark._jvm.org.apache.hadoop.fs.Path(home)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _HOMES.add(home)
    return f"{home}/{name}-{uuid.uuid4().hex[:12]}"


@functools.lru_cache(maxsize=1)
def _package_archive() -> str:
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="fennec-zip-")) / "fennec.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*")):
            if f.suffix in (".py", ".txt"):
                z.write(f, f.relative_to(root.parent))
    return str(path)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: unless it lies where they look
    anyway (the working folder or PYTHONPATH), Spark sends them an archive of it."""
    root = str(Path(__file__).resolve().parent.parent)
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root not in [os.path.realpath(p) for p in places if p]:
        spark.sparkContext.addPyFile(_package_archive())
