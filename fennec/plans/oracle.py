"""DuckDB SQL text for the independent oracle.

The rules (patterns, word lists, tables) are the same constants the Spark
expressions use; the *evaluation* is DuckDB's (RE2 regexes, its own
aggregates and joins).  Helpers return SQL expression strings.  Accent
folding here is the single-character table only: the driver's documents hold
no character whose fold is several characters (checked), so the multi-
character expansion of the Spark side is exercised by the tests instead.
"""

from __future__ import annotations

import re

from ..functions import extract as X
from ..functions.flags import default_rules
from ..functions.measures import BULLET_LABEL
from ..functions.regex import NOT_WS, WS, WS_CHARS, py_regex
from ..functions.text import TOKEN_PATTERN, accent_table, english_stop_words
from ..sources.catalog import CATALOG_SQL


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{WS}+|{WS}+' + chr(92) + 'z')}, '', 'g')"


def nullif_empty(x: str) -> str:
    return f"NULLIF({x}, '')"


def search(t: str, pattern: str, flags: str = "") -> str:
    p = (f"(?{flags})" if flags else "") + py_regex(pattern)
    return nullif_empty(f"regexp_extract({t}, {lit(p)}, 1)")


def value(t: str) -> str:
    return f"TRY_CAST({search(t, X.VALUE_PATTERN)} AS DOUBLE)"


def unit_raw(t: str) -> str:
    return f"COALESCE({nullif_empty(strip(f'regexp_extract({t}, {lit(py_regex(X.UNIT_PATTERN))}, 1)'))}, 'Unknown')"


def unit_normalized(t: str) -> str:
    u = f"lower({strip(f'regexp_extract({t}, {lit(py_regex(X.UNIT_PATTERN))}, 1)')})"
    arms = " ".join(f"WHEN contains({u}, {lit(k)}) THEN {lit(v)}" for k, v in X.UNIT_MAP)
    return (
        f"CASE WHEN COALESCE(regexp_matches({t}, {lit(py_regex(X.UNIT_PATTERN))}), false) "
        f"THEN (CASE {arms} ELSE left({u}, {X.UNIT_TRUNCATE}) END) ELSE 'unknown' END"
    )


def item_name(t: str) -> str:
    return f"COALESCE({strip(f'regexp_extract({t}, {lit(py_regex(X.ITEM_NAME_PATTERN))}, 1)')}, '')"


def pack_digits(t: str, variant: str) -> str:
    pats = X.PACK_PATTERNS if variant == "A" else X.PACK_PATTERNS_SIMPLE
    return "COALESCE(" + ", ".join(search(t, p, "i") for p in pats) + ")"


def pack_quantity(t: str, variant: str) -> str:
    d = pack_digits(t, variant)
    if variant == "A":
        return (
            f"CASE WHEN {d} IS NULL THEN 1 WHEN length(regexp_replace({d}, '^0+', '')) > 3 THEN {X.PACK_CAP} "
            f"ELSE least(CAST({d} AS INTEGER), {X.PACK_CAP}) END"
        )
    return f"COALESCE(TRY_CAST({d} AS DOUBLE), 1.0)"


def split_ws(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(NOT_WS + '+')})"


def brand_raw(n: str) -> str:
    first = f"({split_ws(n)})[1]"
    return f"COALESCE(NULLIF(regexp_replace({first}, {lit(py_regex(r'[^\w\s]'))}, '', 'g'), ''), 'Unknown')"


def brand_normalized(n: str) -> str:
    no_prefix = f"regexp_replace({strip(f'COALESCE({n}, {lit(chr(39) * 0)})')}, {lit('(?i)' + py_regex(X.BRAND_PREFIX_PATTERN))}, '')"
    first = f"lower(({split_ws(no_prefix)})[1])"
    return f"COALESCE(NULLIF(regexp_replace({first}, '[^a-z0-9]', '', 'g'), ''), 'unknown')"


def char_length(x: str) -> str:
    return f"CAST(length(COALESCE({x}, '')) AS BIGINT)"


def word_count(x: str) -> str:
    return f"CAST(len({split_ws(f'COALESCE({x}, {lit(chr(39) * 0)})')}) AS BIGINT)"


def unique_words(x: str) -> str:
    return f"CAST(len(list_distinct({split_ws(f'lower(COALESCE({x}, {lit(chr(39) * 0)}))')})) AS BIGINT)"


def count_matches(x: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all(COALESCE({x}, ''), {lit(pattern)})) AS BIGINT)"


def per_word_plus_one(num: str, words: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST({words} + 1 AS DOUBLE))"


def measures_a(t: str, n: str) -> dict[str, str]:
    d = {
        "catalog_length": char_length(t),
        "name_length": char_length(n),
        "word_count": word_count(n),
        "unique_words": unique_words(n),
    }
    d["avg_word_length"] = per_word_plus_one(d["name_length"], d["word_count"])
    d["unique_ratio"] = per_word_plus_one(d["unique_words"], d["word_count"])
    d["bullet_points"] = count_matches(t, BULLET_LABEL)
    d["special_chars"] = count_matches(n, f"[^\\p{{L}}\\p{{N}}{WS_CHARS}]")
    d["digit_count"] = count_matches(n, r"\p{Nd}")
    d["uppercase_count"] = count_matches(n, r"\p{Lu}")
    return d


def flags(t: str, rules: dict[str, str] | None = None) -> dict[str, str]:
    low = f"lower(COALESCE({t}, ''))"
    return {k: f"CAST(regexp_matches({low}, {lit(py_regex(p))}) AS INTEGER)" for k, p in (rules or default_rules()).items()}


def ieee_divide(a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {b} <> 0 THEN {a} / {b} "
        f"WHEN {a} > 0 THEN CAST('Infinity' AS DOUBLE) WHEN {a} < 0 THEN CAST('-Infinity' AS DOUBLE) ELSE NULL END"
    )


def key_hash(key: str, salt: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || {lit(salt)}), 1, 8)) AS BIGINT)"


def fold(key: str, k: int = 5, seed: int = 42) -> str:
    return f"CAST({key_hash(key, f':{seed}')} % {k} AS INTEGER)"


def holdout(key: str, test_size: float = 0.12, seed: int = 42) -> str:
    return f"({key_hash(key, f':split:{seed}')} % 10000 < {int(round(test_size * 10000))})"


def r6(x: str) -> str:
    return f"round({x}, 6)"


# --- catalog CTEs ----------------------------------------------------------

def catalog_cte() -> str:
    return f"catalog AS ({CATALOG_SQL})"


def extract_a_cte(src: str = "catalog", name: str = "cat_a") -> str:
    """Variant A extraction + measures + flags over ``src``."""
    t = "catalog_content"
    cols = {
        "value": value(t),
        "unit": unit_normalized(t),
        "item_name": item_name(t),
        "pack_qty": pack_quantity(t, "A"),
    }
    inner = ", ".join(f"{v} AS {k}" for k, v in cols.items())
    m = measures_a(t, "item_name")
    outer = ", ".join(f"{v} AS {k}" for k, v in m.items())
    fl = ", ".join(f"{v} AS {k}" for k, v in flags(t).items())
    return (
        f"{name}_0 AS (SELECT *, {inner} FROM {src}),\n"
        f"{name} AS (SELECT *, {brand_normalized('item_name')} AS brand, {outer}, {fl} FROM {name}_0)"
    )


def extract_b_cte(src: str = "catalog", name: str = "cat_b") -> str:
    t = "catalog_content"
    return (
        f"{name}_0 AS (SELECT *, {value(t)} AS value, {unit_raw(t)} AS unit, {item_name(t)} AS item_name FROM {src}),\n"
        f"{name}_1 AS (SELECT *, {brand_raw('item_name')} AS brand, {char_length(t)} AS catalog_length, "
        f"{char_length('item_name')} AS item_name_length, {word_count('item_name')} AS item_name_word_count, "
        f"{pack_quantity(t, 'B')} AS pack_quantity FROM {name}_0),\n"
        f"{name} AS (SELECT *, COALESCE(value, (SELECT median(value) FROM {name}_1)) AS value_filled FROM {name}_1)"
    )


# --- TF-IDF ------------------------------------------------------------------

def tfidf_terms_cte(src: str, id_col: str, text_col: str, ngram: tuple[int, int], strip_accents: bool, stop: bool, name: str = "terms") -> str:
    t = f"lower(COALESCE({text_col}, ''))"
    if strip_accents:
        a, b = accent_table()
        t = f"translate({t}, {lit(a)}, {lit(b)})"
    toks = f"regexp_extract_all({t}, {lit(TOKEN_PATTERN)})"
    if stop:
        words = ", ".join(lit(w) for w in english_stop_words())
        toks = f"list_filter({toks}, lambda x: NOT list_contains([{words}], x))"
    grams = []
    for n in range(ngram[0], ngram[1] + 1):
        if n == 1:
            grams.append("toks")
        else:
            grams.append(
                f"CASE WHEN len(toks) >= {n} THEN list_transform(range(0, len(toks) - {n} + 1), "
                f"lambda i: array_to_string(list_slice(toks, i + 1, i + {n}), ' ')) ELSE [] END"
            )
    allg = grams[0] if len(grams) == 1 else "list_concat(" + ", ".join(grams) + ")" if len(grams) == 2 else "list_concat(list_concat(" + grams[0] + ", " + grams[1] + "), " + grams[2] + ")"
    return (
        f"{name}_t AS (SELECT {id_col} AS _id, {toks} AS toks FROM {src}),\n"
        f"{name} AS (SELECT _id, unnest({allg}) AS term FROM {name}_t)"
    )


def tfidf_vocab_sql(src: str, id_col: str, text_col: str, max_features: int, ngram, min_df, max_df, strip_accents: bool, stop: bool) -> str:
    """CTEs ending in ``vocab(term, idx, df, total_tf, idf)``."""
    lo = f"{float(min_df)}" if isinstance(min_df, int) else f"{float(min_df)} * n"
    hi = f"{float(max_df)}" if isinstance(max_df, int) else f"{float(max_df)} * n"
    return (
        tfidf_terms_cte(src, id_col, text_col, ngram, strip_accents, stop) + ",\n"
        f"ndocs AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {src}),\n"
        "tf AS (SELECT _id, term, count(*) AS tf FROM terms GROUP BY _id, term),\n"
        "dfs AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf FROM tf GROUP BY term),\n"
        f"kept AS (SELECT term, df, total_tf FROM dfs, ndocs WHERE df >= {lo} AND df <= {hi} ORDER BY total_tf DESC, term ASC LIMIT {max_features}),\n"
        "vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, total_tf, "
        "ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM kept, ndocs)"
    )


def _matching_paren(s: str, open_idx: int) -> int:
    depth = 0
    quote = False
    for i in range(open_idx, len(s)):
        ch = s[i]
        if ch == "'":
            quote = not quote
        elif not quote:
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    return i
    raise ValueError("unbalanced")


def portable_rounding(sql: str) -> str:
    """Rewrite ``round(x, d)`` into ``floor(x * 10^d + 0.5) / 10^d`` (for
    |x| < 1e9), the same float operations the Spark side uses, so both engines
    produce identical doubles (their ``round`` differ on exact half-way values)."""
    out = []
    i = 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i : j + 6])
            i = j + 6
            continue
        k = _matching_paren(sql, j + 5)
        inner = sql[j + 6 : k]
        m = re.match(r"^(.*),\s*(\d+)\s*$", inner, re.S)
        if not m:
            out.append(sql[i : k + 1])
            i = k + 1
            continue
        x = portable_rounding(m.group(1))
        q = f"{10 ** int(m.group(2))}.0"
        out.append(sql[i:j])
        out.append(f"(CASE WHEN abs({x}) < 1e9 THEN floor(({x}) * {q} + 0.5) / {q} ELSE ({x}) END)")
        i = k + 1
