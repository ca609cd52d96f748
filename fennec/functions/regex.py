"""Portable regular-expression vocabulary.

Catalog rules are written in Python ``re`` syntax (Unicode by default).  Spark
evaluates regexes with ``java.util.regex`` whose ``\\s`` and ``\\w`` are ASCII
only, and the SQL oracle runs RE2 whose ``\\s`` also lacks ``\\v``.  ``py_regex``
rewrites the three constructs whose meaning differs into explicit classes that
mean the same in Python, Java and RE2:

* ``\\s``  -> the ``str.isspace()`` set
* ``\\w``  -> letters, numbers and ``_``
* ``.``    -> any character but ``\\n`` (Java's ``.`` also stops at ``\\r``,
  ``\\u0085``, ``\\u2028``, ``\\u2029``)

``\\d`` is left alone: it is ASCII ``[0-9]`` in both Java and RE2 (a known,
documented narrowing of Python's Unicode digits).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace set (str.isspace), as class content valid in Java and RE2.
WS_CHARS = r"\t\n\x0B\f\r \x{1C}-\x{1F}\x{85}\p{Z}"
WS = f"[{WS_CHARS}]"
NOT_WS = f"[^{WS_CHARS}]"
WORD_CHARS = r"\p{L}\p{N}_"
WORD = f"[{WORD_CHARS}]"
ANY_BUT_NL = r"[^\n]"


def py_regex(pattern: str) -> str:
    """Rewrite a Python ``re`` pattern into the portable dialect above."""
    out: list[str] = []
    in_class = False
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt == "s":
                out.append(WS_CHARS if in_class else WS)
            elif nxt == "w":
                out.append(WORD_CHARS if in_class else WORD)
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if in_class:
            if ch == "]":
                in_class = False
            out.append(ch)
        elif ch == "[":
            in_class = True
            out.append(ch)
            # a leading ']' or '^]' is literal inside a class
            if pattern[i + 1 : i + 2] == "^":
                out.append("^")
                i += 1
            if pattern[i + 1 : i + 2] == "]":
                out.append("]")
                i += 1
        elif ch == ".":
            out.append(ANY_BUT_NL)
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def nullif_empty(c: Column) -> Column:
    """NULL for NULL and ''; the value otherwise (``regexp_extract`` gives '' on no match)."""
    return F.nullif(c, F.lit(""))


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: Spark's ``trim`` only removes U+0020."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+\\z", "")


def py_split(c: Column) -> Column:
    """Python ``str.split()``: whitespace runs, no empty tokens ('' -> [])."""
    return F.regexp_extract_all(c, F.lit(f"{NOT_WS}+"), F.lit(0))


def py_count(c: Column, pattern: str) -> Column:
    """Number of non-overlapping matches of a Python pattern (``Series.str.count``)."""
    return F.regexp_count(c, F.lit(py_regex(pattern)))


def search_group(c: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    """First match of a Python pattern, capture ``group``; NULL when there is none."""
    prefix = f"(?{flags})" if flags else ""
    return nullif_empty(F.regexp_extract(c, prefix + py_regex(pattern), group))
