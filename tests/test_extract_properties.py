"""Random catalog-like strings: the JVM expressions agree with Python's own
``re`` / ``str`` semantics of the rules (the dialect rewrite is what is tested).
Digits are ASCII (a documented narrowing)."""

import math
import random
import re

from pyspark.sql import functions as F

from fennec.functions import extract as X
from fennec.functions import measures as M

PIECES = ["Item Name:", "Value:", "Unit:", "Pack of ", "Bullet Point 1:", "pack of", " ct", " Count", "-Count", "-Pack",
          " Pack", "pk", "(", ")", "The ", "an ", "A ", "\n", " ", "  ", "\t", "\xa0", " ", "\x1c", "\x85", "\r",
          "12", "3", ".", "0", "99999", "Fluid Ounce", "ounce", "Kilogram", "Café", "Zoë's", "®™", "_", "-", "x", "Ölçü",
          "ABC", "def", "fresh", "snack", ",", "'", "été"]


def py_value(t):
    if t is None:
        return None
    m = re.search(r"Value:\s*([\d.]+)", t)
    if not m:
        return None
    try:
        return float(m.group(1))
    except ValueError:
        return None


def py_unit_raw(t):
    if t is None:
        return "Unknown"
    m = re.search(r"Unit:\s*([^\n]+)", t)
    return (m.group(1).strip() or "Unknown") if m else "Unknown"


def py_unit_norm(t):
    if t is None:
        return "unknown"
    m = re.search(r"Unit:\s*([^\n]+)", t)
    if not m:
        return "unknown"
    u = m.group(1).strip().lower()
    for k, v in X.UNIT_MAP:
        if k in u:
            return v
    return u[:20]


def py_name(t):
    if t is None:
        return ""
    m = re.search(r"Item Name:\s*([^\n]+)", t)
    return m.group(1).strip() if m else ""


def py_pack(t, variant):
    pats = X.PACK_PATTERNS if variant == "A" else X.PACK_PATTERNS_SIMPLE
    for p in pats:
        m = re.search(p, str(t), re.I) if t is not None else None
        if m:
            q = int(m.group(1))
            return min(q, 100) if variant == "A" else float(q)
    return 1 if variant == "A" else 1.0


def py_brand_raw(n):
    if not n:
        return "Unknown"
    w = n.split()
    if not w:
        return "Unknown"
    b = re.sub(r"[^\w\s]", "", w[0])
    return b or "Unknown"


def py_brand_norm(n):
    s = str(n).strip()
    if not s:
        return "unknown"
    s = re.sub(r"^(The|A|An)\s+", "", s, flags=re.I)
    w = s.split()
    if not w:
        return "unknown"
    b = re.sub(r"[^a-z0-9]", "", w[0].lower())
    return b or "unknown"


def test_random_strings_match_python_rules(spark):
    rnd = random.Random(11)
    texts = [None, ""]
    for _ in range(400):
        texts.append("".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 14))))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    c = F.col("c")
    rows = (
        df.select("i", c, X.item_name(c).alias("n"))
        .select(
            "i", X.value(c).alias("value"), X.unit_raw(c).alias("unit_raw"), X.unit_normalized(c).alias("unit"), "n",
            X.pack_quantity(c, "A").alias("pack_a"), X.pack_quantity(c, "B").alias("pack_b"),
            X.brand_raw(F.col("n")).alias("brand_raw"), X.brand_normalized(F.col("n")).alias("brand"),
            M.char_length(c).alias("len"), M.word_count(F.col("n")).alias("words"), M.unique_words(F.col("n")).alias("uniq"),
            M.special_chars(F.col("n")).alias("special"), M.uppercase_count(F.col("n")).alias("upper"),
        )
        .orderBy("i")
        .collect()
    )
    for r in rows:
        t = texts[r.i]
        n = py_name(t)
        v = py_value(t)
        assert (r.value is None and v is None) or (v is not None and math.isclose(r.value, v)), (t, r.value, v)
        assert r.unit_raw == py_unit_raw(t), (t, r.unit_raw)
        assert r.unit == py_unit_norm(t), (t, r.unit)
        assert r.n == n, (t, r.n, n)
        assert r.pack_a == py_pack(t, "A"), (t, r.pack_a)
        assert r.pack_b == py_pack(t, "B"), (t, r.pack_b)
        assert r.brand_raw == py_brand_raw(n), (t, r.brand_raw)
        assert r.brand == py_brand_norm(n), (t, r.brand)
        assert r.len == len(t or ""), t
        assert r.words == len(n.split()), (t, n)
        assert r.uniq == len(set(n.lower().split())), (t, n)
        assert r.special == sum(not ch.isalnum() and not ch.isspace() for ch in n), (t, n)
        assert r.upper == sum(ch.isupper() for ch in n), (t, n)
