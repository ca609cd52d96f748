"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Candidates are found by pattern and validated (card check digits, IBAN mod 97,
SSN ranges, octets, calendar dates, digit counts); what is not valid stays.  A
valid value is a list of digits in mixed radices, and a keyed Feistel network
permutes that list inside its format: a card gives a card with a right check
digit, a date a date that reads the same way, an e-mail address an address in the
same shape.  The permutation depends on key, kind and value alone, so equal values
get equal pseudonyms in every document, different ones different, and the holder of
the key can turn them back (``inverse=True``).  Octets written with leading zeros
come back without them.

Everything is a DataFrame expression over one row: no shuffle, no Python.
"""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

ROUNDS = 8
#: Dates are permuted within these 200 years.  Days that can be written alike
#: form a class: day of month below 10, 10 to 12 or more (that one is never read
#: as a month), month below 10 or not.  So every spelling of a day, padded or
#: not, month or day first, is one of each day of its class.
FIRST_YEAR, YEARS = 1900, 200
#: Radices of the classes, whose products are the numbers of their days; the last
#: two are days from the 13th on in January to September of common and leap years.
DATE_RADICES = ((120, 135), (72, 75), (72, 75), (40, 45), (100, 112), (151, 165), (83, 98))
#: Days from the 13th on before each month of a class (September and December are the last).
MONTH_STARTS = ((0, 19, 37), (0, 19, 35, 54, 72, 91, 109, 128, 147), (0, 19, 36, 55, 73, 92, 110, 129, 148))
#: Valid SSN areas (001-899 without 666) times groups, and serials.
SSN_RADICES = (898 * 99, 9999)

#: Patterns of the kinds, first match wins (fixed values).
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "date": r"(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])\+1(?:[ .()-]{0,2}\d){10}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .()-]{0,2}\d){6,12}(?!\d)"
             r"|(?<![\w+-])(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])\d{3}[ .-]\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
}
KINDS = tuple(PATTERNS)
#: Only texts with one of these can hold a candidate.
_HINT = "[0-9@]"


def _feistel(values: Column, radices: Column, key: Column, inverse: bool) -> Column:
    """Permute ``values`` (each below its radix): both halves take turns in
    being shifted by a keyed hash of the other."""
    half = F.floor(F.size(values) / 2).cast("int")

    def shifted(part: Column, other: Column, radix: Column, round_: Column, side: str) -> Column:
        seed = F.concat_ws("|", key, F.lit(side), round_.cast("string"), F.size(part).cast("string"), F.array_join(other.cast("array<string>"), ","))
        return let(F.sha2(seed.cast("binary"), 256), lambda s: F.transform(part, lambda v, i: F.pmod(
            v + (-1 if inverse else 1) * F.pmod(
                F.conv(F.substring(F.sha2(F.concat_ws("|", s, i.cast("string")).cast("binary"), 256), 1, 12), 16, 10).cast("bigint"),
                F.get(radix, i)),
            F.get(radix, i))))

    def run(v: Column, r: Column) -> Column:
        ra, rb = F.slice(r, 1, half), F.slice(r, half + 1, F.size(r) - half)
        start = F.struct(F.slice(v, 1, half).alias("a"), F.slice(v, half + 1, F.size(v) - half).alias("b"))

        def forward(st, i):
            return let(shifted(st["a"], st["b"], ra, i, "a"), lambda a: F.struct(a.alias("a"), shifted(st["b"], a, rb, i, "b").alias("b")))

        def backward(st, i):
            return let(shifted(st["b"], st["a"], rb, i, "b"), lambda b: F.struct(shifted(st["a"], b, ra, i, "a").alias("a"), b.alias("b")))

        order = F.sequence(F.lit(ROUNDS), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))
        return F.aggregate(order, start, backward if inverse else forward, lambda st: F.concat(st["a"], st["b"]))

    return let(values, lambda v: let(radices, lambda r: run(v, r)))


def _numbers(*cols: Column) -> Column:
    return F.array(*[c.cast("bigint") for c in cols])


def _list(values) -> Column:
    return F.expr(f"array({', '.join(map(str, values))})")


def _characters(text: Column, fixed: Callable[[Column], Column], key: Column, inverse: bool) -> Column:
    """Letters and digits of ``text`` permuted within their class; places for
    which ``fixed`` holds, and all other characters, stay."""
    def code(c: Column) -> Column:
        return (F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).when(c.rlike("^[a-z]$"), F.ascii(c) - 97)
                .when(c.rlike("^[A-Z]$"), F.ascii(c) - 65).otherwise(F.lit(0)).cast("bigint"))

    def radix(c: Column, i: Column) -> Column:
        return (F.when(fixed(i), F.lit(1)).when(c.rlike("^[0-9]$"), F.lit(10)).when(c.rlike("^[A-Za-z]$"), F.lit(26))
                .otherwise(F.lit(1)).cast("bigint"))

    def back(c: Column, v: Column, i: Column) -> Column:
        return (F.when(fixed(i), c).when(c.rlike("^[0-9]$"), v.cast("string")).when(c.rlike("^[a-z]$"), F.char(v + 97))
                .when(c.rlike("^[A-Z]$"), F.char(v + 65)).otherwise(c))

    return let(F.split(text, ""), lambda cs: let(
        _feistel(F.transform(cs, lambda c, i: F.when(fixed(i), F.lit(0).cast("bigint")).otherwise(code(c))),
                 F.transform(cs, radix), key, inverse),
        lambda vs: F.array_join(F.transform(cs, lambda c, i: back(c, F.get(vs, i), i)), "")))


def _digits(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "[^0-9]", ""), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of digits, the last one taken once."""
    return F.aggregate(
        F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 1, let(
            d.cast("int") * 2, lambda x: F.when(x > 9, x - 9).otherwise(x))).otherwise(d.cast("int"))),
        F.lit(0), lambda a, x: a + x)


def _mod97(iban: Column) -> Column:
    """The account (without spaces), country and check digits moved to its end, modulo 97."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _day(m: Column) -> Column:
    """A date in one of the formats as a struct ``y`` (years since ``FIRST_YEAR``),
    ``m``, ``d``, and whether the month is written before the day; null if it is none."""
    def parts(year: int, month: int, day: int, month_first: bool) -> Column:
        n = [F.regexp_extract(m, r"^(\d+)\D(\d+)\D(\d+)$", i).cast("int") for i in (year, month, day)]
        leap = (n[0] % 4 == 0) & (n[0] != FIRST_YEAR)
        length = F.when((n[1] == 2) & leap, F.lit(29)).otherwise(F.get(_list([monthrange(2001, k)[1] for k in range(1, 13)]), n[1] - 1))
        real = n[0].between(FIRST_YEAR, FIRST_YEAR + YEARS - 1) & n[1].between(1, 12) & (n[2] >= 1) & (n[2] <= length)
        return F.when(real, F.struct((n[0] - FIRST_YEAR).alias("y"), n[1].alias("m"), n[2].alias("d"), F.lit(month_first).alias("month_first")))

    return (F.when(m.rlike(r"^\d{4}\D"), parts(1, 2, 3, True)).when(m.contains("."), parts(3, 2, 1, False))
            .otherwise(F.coalesce(parts(3, 1, 2, True), parts(3, 2, 1, False))))


def _place(t: Column) -> Column:
    """The class of a day, and its number there."""
    def late(starts: tuple[int, ...], first: int) -> Column:
        return F.get(_list(starts), t["m"] - first) + t["d"] - 13

    def small(c: int, month: int, months: int, day: int, days: int) -> Column:
        return F.struct(F.lit(c).alias("c"), ((t["y"] * months + t["m"] - month) * days + t["d"] - day).alias("i"))

    early, leap = t["m"] < 10, (t["y"] % 4 == 0) & (t["y"] > 0)
    return (F.when(early & (t["d"] < 10), small(0, 1, 9, 1, 9)).when(t["d"] < 10, small(1, 10, 3, 1, 9))
            .when(early & (t["d"] < 13), small(2, 1, 9, 10, 3)).when(t["d"] < 13, small(3, 10, 3, 10, 3))
            .when(~early, F.struct(F.lit(4).alias("c"), (t["y"] * 56 + late(MONTH_STARTS[0], 10)).alias("i")))
            .when(~leap, F.struct(F.lit(5).alias("c"), ((t["y"] - F.floor(t["y"] / 4).cast("int")) * 165 + late(MONTH_STARTS[1], 1)).alias("i")))
            .otherwise(F.struct(F.lit(6).alias("c"), ((F.floor(t["y"] / 4).cast("int") - 1) * 166 + late(MONTH_STARTS[2], 1)).alias("i"))))


def _placed(c: Column, i: Column) -> Column:
    """The day with number ``i`` of a class: ``_place`` turned back."""
    def whole(x: Column, by: int) -> Column:
        return F.floor(x / by).cast("int")

    def ymd(y: Column, month: Column, d: Column) -> Column:
        return F.struct(y.alias("y"), month.alias("m"), d.alias("d"))

    def small(month: int, months: int, day: int, days: int) -> Column:
        return ymd(whole(i, months * days), whole(i, days) % months + month, i % days + day)

    def late(starts: tuple[int, ...], first: int, per_year: int, year: Column) -> Column:
        at = _list(starts)
        return let(F.size(F.filter(at, lambda s: s <= i % per_year)), lambda n: ymd(year, n - 1 + first, i % per_year - F.get(at, n - 1) + 13))

    common = whole(i, 165)
    return (F.when(c == 0, small(1, 9, 1, 9)).when(c == 1, small(10, 3, 1, 9)).when(c == 2, small(1, 9, 10, 3))
            .when(c == 3, small(10, 3, 10, 3)).when(c == 4, late(MONTH_STARTS[0], 10, 56, whole(i, 56)))
            .when(c == 5, late(MONTH_STARTS[1], 1, 165, F.greatest(common + whole(common - 1, 3), F.lit(0))))
            .otherwise(late(MONTH_STARTS[2], 1, 166, (whole(i, 166) + 1) * 4)))


def _date(m: Column, key: Column, inverse: bool) -> Column:
    """Another day of the same class in the same spelling, so it reads the same way;
    one day has one pseudonym whatever its spelling."""
    def spelled(t: Column, month_first: Column) -> Column:
        year = (t["y"] + FIRST_YEAR).cast("string")
        first, second = (F.when(month_first, t[a]).otherwise(t[b]).cast("string") for a, b in (("m", "d"), ("d", "m")))
        sep, at = F.regexp_extract(m, r"\D", 0), F.split(m, r"\D")
        def padded(part: Column, i: int) -> Column:
            return F.lpad(part, F.length(F.get(at, F.lit(i))), F.lit("0"))

        return F.when(m.rlike(r"^\d{4}"), F.concat(year, sep, padded(first, 1), sep, padded(second, 2))).otherwise(
            F.concat(padded(first, 0), sep, padded(second, 1), sep, year))

    radices = F.array(*[_list(r).cast("array<bigint>") for r in DATE_RADICES])

    def permuted(p: Column) -> Column:
        return let(F.get(radices, p["c"]), lambda r: let(
            _feistel(_numbers(F.floor(p["i"] / F.get(r, F.lit(1))), p["i"] % F.get(r, F.lit(1))), r, F.concat_ws("|", key, p["c"].cast("string")), inverse),
            lambda v: _placed(p["c"], (F.get(v, F.lit(0)) * F.get(r, F.lit(1)) + F.get(v, F.lit(1))).cast("int"))))

    return let(_day(m), lambda t: let(let(_place(t), permuted), lambda new: spelled(new, t["month_first"])))


def kind_of(m: Column) -> Column:
    """The kind of a candidate that is valid, else null."""
    whole = {k: "^(?:" + p + ")$" for k, p in PATTERNS.items()}
    n = F.length(F.regexp_replace(m, "[^0-9]", ""))
    iban = F.regexp_replace(m, " ", "")
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    valid_ssn = ~m.rlike(r"^(000|666|9\d\d)|-00-|-0000$")
    return (F.when(m.rlike(whole["email"]), F.lit("email"))
            .when(m.rlike(whole["iban"]), F.when((_mod97(iban) == 1) & F.substring(iban, 3, 2).between("02", "98"), F.lit("iban")))
            .when(m.rlike(whole["ip"]), F.when(F.array_max(octets) < 256, F.lit("ip")))
            .when(m.rlike(whole["date"]), F.when(_day(m).isNotNull(), F.lit("date")))
            .when(m.rlike(whole["ssn"]), F.when(valid_ssn, F.lit("ssn")))
            .when(m.rlike(whole["phone"]), F.when((n >= 8) & (n <= 15), F.lit("phone")))
            .when(m.rlike(whole["card"]), F.when((n >= 13) & (n <= 19) & (_luhn(_digits(m)) % 10 == 0), F.lit("card"))))


def _ssn(m: Column, key: Column, inverse: bool) -> Column:
    area, group, serial = (F.regexp_extract(m, r"^(\d+)-(\d+)-(\d+)$", i).cast("int") for i in (1, 2, 3))
    a = F.when(area > 666, area - 2).otherwise(area - 1) * 99 + group - 1
    return let(_feistel(_numbers(a, serial - 1), _numbers(*map(F.lit, SSN_RADICES)), key, inverse), lambda v: let(
        F.floor(F.get(v, F.lit(0)) / 99) + 1, lambda x: F.format_string(
            "%03d-%02d-%04d", F.when(x >= 666, x + 1).otherwise(x).cast("int"),
            (F.get(v, F.lit(0)) % 99 + 1).cast("int"), (F.get(v, F.lit(1)) + 1).cast("int"))))


def _respelled(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``: separators stay."""
    return let(F.split(digits, ""), lambda ds: F.aggregate(
        F.split(m, ""), F.struct(F.lit("").alias("t"), F.lit(0).alias("i")),
        lambda st, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(st["t"], F.get(ds, st["i"])).alias("t"), (st["i"] + 1).alias("i")))
        .otherwise(F.struct(F.concat(st["t"], c).alias("t"), st["i"].alias("i"))), lambda st: st["t"]))


def _card(m: Column, key: Column, inverse: bool) -> Column:
    """Only the digits count, so that any spelling of a card has one pseudonym."""
    def checked(digits: Column) -> Column:
        return F.concat(digits, F.pmod(-_luhn(F.split(F.concat(digits, F.lit("0")), "")), F.lit(10)).cast("string"))

    payload = F.regexp_replace(F.regexp_replace(m, "[^0-9]", ""), ".$", "")
    return let(_characters(payload, lambda i: F.lit(False), key, inverse), lambda d: _respelled(m, checked(d)))


def _iban(m: Column, key: Column, inverse: bool) -> Column:
    def grouped(new: Column) -> Column:
        whole = let(98 - _mod97(new), lambda c: F.concat(F.substring(new, 1, 2), F.lpad(c.cast("string"), 2, "0"), F.substring(new, 5, 64)))
        return F.when(m.contains(" "), F.rtrim(F.regexp_replace(whole, "(.{4})", "$1 "))).otherwise(whole)

    plain = F.regexp_replace(m, " ", "")
    blank = F.concat(F.substring(plain, 1, 2), F.lit("00"), F.substring(plain, 5, 64))
    return let(_characters(blank, lambda i: i < 4, key, inverse), grouped)


def _phone(m: Column, key: Column, inverse: bool) -> Column:
    """The country code and the first digit after it stay; only digits count."""
    lead = F.regexp_extract(m, r"^(\+\d{1,3}(?:[ .-]|(?=\())[^0-9]*|\+\d{2}|[^0-9]*)[0-9]", 0)
    new = let(F.length(F.regexp_replace(lead, "[^0-9]", "")), lambda n: _characters(
        F.regexp_replace(m, "[^0-9]", ""), lambda i: i < n, key, inverse))
    return let(new, lambda d: _respelled(m, d))


def _email(m: Column, key: Column, inverse: bool) -> Column:
    """The domain stays."""
    local = F.substring_index(m, "@", 1)
    return F.concat(_characters(local, lambda i: F.lit(False), key, inverse), F.substring(m, F.length(local) + 1, F.length(m)))


def pseudonym(m: Column, kind: Column, secret: str, inverse: bool = False) -> Column:
    """The pseudonym of a valid value of a kind; values without a kind stay."""
    def key(k: str) -> Column:
        return F.lit(f"{secret}|{k}")

    ip = let(_feistel(F.transform(F.split(m, r"\."), lambda x: x.cast("bigint")), F.array(*[F.lit(256).cast("bigint")] * 4), key("ip"), inverse),
             lambda v: F.array_join(v.cast("array<string>"), "."))
    return (F.when(kind == "email", _email(m, key("email"), inverse)).when(kind == "iban", _iban(m, key("iban"), inverse))
            .when(kind == "ip", ip).when(kind == "date", _date(m, key("date"), inverse)).when(kind == "ssn", _ssn(m, key("ssn"), inverse))
            .when(kind == "phone", _phone(m, key("phone"), inverse)).when(kind == "card", _card(m, key("card"), inverse)).otherwise(m))


def pseudonymise(docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text", inverse: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``text`` with pseudonyms, and
    ``n_<kind>``, how many values of each kind were replaced.

    Null texts stay null, texts without candidates as they are; repeated rows
    stay repeated.  Other columns are ignored.
    """
    pattern = "|".join(PATTERNS.values())
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    d = d.withColumn("__m", F.when(F.col("__t").rlike(_HINT), F.regexp_extract_all("__t", F.lit(pattern), F.lit(0))))
    d = d.withColumn("__v", F.transform("__m", lambda m: let(kind_of(m), lambda k: F.struct(
        k.alias("kind"), pseudonym(m, k, secret, inverse).alias("new")))))
    text = let(F.col("__v"), lambda v: F.array_join(F.transform(
        F.split("__t", pattern, -1), lambda p, i: F.concat(p, F.coalesce(F.get(v, i)["new"], F.lit("")))), ""))
    return d.select(F.col("__id").alias(id_col), F.when(F.size("__v") > 0, text).otherwise(F.col("__t")).alias("text"),
                    *[_count(k).alias(f"n_{k}") for k in KINDS])


def _count(kind: str) -> Column:
    return F.coalesce(F.size(F.filter("__v", lambda x: x["kind"].eqNullSafe(F.lit(kind)))), F.lit(0)).cast("bigint")
