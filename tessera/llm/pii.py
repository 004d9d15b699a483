"""Format-preserving Feistel pseudonyms for personal data, in built-in functions
only.

Values are found by one pattern, validated, and replaced by a keyed permutation
of their own format, so equal values get equal pseudonyms in every document and
different values of a kind never share one:

* payment cards: 13-19 digits (or four groups), Luhn check.  All digits but the
  last are permuted, the check digit is made anew: the pseudonym passes Luhn.
* phones ``+c (ddd) ddd-dddd``, ``+c`` and two to four groups of digits parted by
  spaces or hyphens, ``(ddd) ddd-dddd`` and ``ddd-ddd-dddd``: the national digits,
  six at least.  No country code counts as 1; for that, numbers whose area and
  exchange start with 2-9 are permuted among themselves, and so are the others.
* IPv4 addresses without leading zeros: the 32 bits.
* social security numbers ``ddd-dd-dddd``: areas 001-899 but 666, groups 01-99,
  serials 0001-9999.
* dates ``yyyy-mm-dd``, ``mm/dd/yyyy``, ``dd.mm.yyyy`` of existing days from year
  400 on: the day within its 400-year calendar cycle (146,097 days), so one day
  has one pseudonym in all three formats.  A time after ``T`` may follow; it stays.
* e-mail addresses: the local part, letters to letters and digits to digits; the
  domain stays.

A value that fails its check is left alone.  The permutation is a Feistel network
of ``ROUNDS`` rounds over Z_a x Z_b: in turn one half is added, modulo its size,
to a SHA-256 of the key, the kind, the round and the other half.  Every round can
be undone, so it is a permutation of all a * b values whatever the hash.

One map-only pass: no shuffle, nothing collected.  Texts without a digit or an at
sign are passed through untested.

Nulls: a null text stays null and has no finding; other columns are not read.
Empty and very long texts, repeated rows and ties need no special rule; an empty
table gives an empty result; extra columns are kept.  ``key`` is the caller's
secret.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let, require

ROUNDS = 8
KINDS = ("email", "phone", "date", "ssn", "card", "ip")

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": r"\b[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "phone": r"\+[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
             r"|\+1(?: [0-9]{3} [0-9]{3} [0-9]{4}|-[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9])"
             r"|\+[0-9]{1,3}(?:(?: [0-9]{1,4}){2,4}|(?:-[0-9]{1,4}){2,4})(?![0-9])"
             r"|(?<!\w)\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![\w-])|(?<![\w.-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![\w-])",
    "date": r"(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
            r"(?!(?!T[0-9])[\w-])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "card": r"(?<![\w-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![\w-])",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.[0-9])",
}
#: The other kinds start with a digit, a plus sign or a bracket, which is tested first.
NUMBERS = "(?=[0-9+(])(?:" + "|".join(f"(?:{PATTERNS[k]})" for k in KINDS if k != "email") + ")"
PATTERN = f"(?:{PATTERNS['email']})|{NUMBERS}"


def _hash(key: str, kind: str, i: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other.cast("string")), 256)


def feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """Struct (l, r): the permutation of Z_a x Z_b applied to (left, right), all
    bigint.  Sizes below 2^60."""
    def f(i, x, size):
        return F.conv(F.substring(_hash(key, kind, i, x), 1, 15), 16, 10).cast("bigint") % size

    def turn(s, i):
        even = i % 2 == 0
        return F.struct(F.when(even, (s["l"] + f(i, s["r"], a)) % a).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise((s["r"] + f(i, s["l"], b)) % b).alias("r"))

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def feistel_text(key: str, kind: str, s: Column) -> Column:
    """The same network over the characters of a text: lower-case letters,
    upper-case letters and digits move within their class, others stay."""
    def moved(half, other, i):
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.lower(other)), 512)

        def char(h, at):
            c = F.ascii(F.substr(half, at, F.lit(1)))
            step = F.conv(F.substr(h, (at - 1) % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")
            def within(lo, n):
                return F.char((c - lo + step) % n + lo)
            return (F.when(c.between(97, 122), within(97, 26)).when(c.between(65, 90), within(65, 26))
                    .when(c.between(48, 57), within(48, 10)).otherwise(F.char(c)))

        return F.when(F.length(half) == 0, half).otherwise(
            let(digest, lambda h: F.array_join(F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(half), F.lit(1))), lambda at: char(h, at)), "")))

    def turn(t, i):
        even = i % 2 == 0
        return F.struct(F.when(even, moved(t["l"], t["r"], i)).otherwise(t["l"]).alias("l"),
                        F.when(even, t["r"]).otherwise(moved(t["r"], t["l"], i)).alias("r"))

    cut = (F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), cut).alias("l"), F.substr(s, cut + 1, F.length(s)).alias("r"))
    out = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return let(out, lambda x: F.concat(x["l"], x["r"]))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _long(s: Column) -> Column:
    return F.when(F.length(s) == 0, F.lit(0)).otherwise(s.cast("bigint")).cast("bigint")


def _pad(x: Column, n) -> Column:
    return F.lpad(x.cast("string"), n, "0") if isinstance(n, int) else F.lpad(x.cast("string"), n, F.lit("0"))


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("bigint")


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum of a digit string; ``double_last``: the last digit is doubled
    (the string lacks its check digit)."""
    n = F.length(digits)

    def add(s, i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = (n - i) % 2 == (0 if double_last else 1)
        return s + F.when(~twice, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits``, in order."""
    def at(c, i):
        k = F.length(_digits(F.substr(shape, F.lit(1), i + 1)))
        return F.when(c.between("0", "9"), F.substr(digits, k, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(shape, ""), at), "")


def _card(m: Column, key: str) -> Column:
    def make(d):
        n = F.length(d) - 1
        u = (n / 2).cast("int")
        # the sizes follow the length: a longer number is another format
        halves = feistel(key, "card", _long(F.substr(d, F.lit(1), u)), _long(F.substr(d, u + 1, n - u)), _power(u),
                         _power(n - u))
        body = let(halves, lambda x: F.concat(_pad(x["l"], u), _pad(x["r"], n - u)))
        new = let(body, lambda s: F.concat(s, ((10 - luhn_sum(s, True) % 10) % 10).cast("string")))
        return F.when(luhn_sum(d, False) % 10 == 0, let(new, lambda s: _refill(m, s)))

    return let(_digits(m), make)


def _phone(m: Column, key: str) -> Column:
    cc = F.regexp_extract(m, r"^\+([0-9]{1,3})", 1)

    def make(d):
        n = F.length(d)
        area, rest = F.substr(d, F.lit(1), F.lit(3)).cast("bigint"), F.substr(d, F.lit(4), F.lit(7)).cast("bigint")
        near = feistel(key, "phone1", area - 200, rest - 2_000_000, F.lit(800), F.lit(8_000_000))
        far = feistel(key, "phone", area, rest, F.lit(1000), F.lit(10_000_000))
        # the 3.6e9 ten-digit numbers outside the rule: areas below 200, then low exchanges of the others
        at = F.when(area < 200, area * 10_000_000 + rest).otherwise((area - 200) * 2_000_000 + rest + 2_000_000_000)
        odd = let(at, lambda x: feistel(key, "phone1 other", (x / 60_000).cast("bigint"), x % 60_000, F.lit(60_000),
                                        F.lit(60_000)))

        def write_odd(x):
            low, high = x % 10_000_000, x - 2_000_000_000
            return F.when(x < 2_000_000_000, F.concat(_pad((x / 10_000_000).cast("bigint"), 3), _pad(low, 7))).otherwise(
                F.concat(_pad((high / 2_000_000).cast("bigint") + 200, 3), _pad(high % 2_000_000, 7)))

        u = (n / 2).cast("int")
        # the sizes follow the length: a longer number is another format
        other = feistel(key, "phone", _long(F.substr(d, F.lit(1), u)), _long(F.substr(d, u + 1, n - u)), _power(u),
                        _power(n - u))
        home = cc.isin("1", "") & (n == 10)
        new = (F.when(home & (area >= 200) & (rest >= 2_000_000),
                      let(near, lambda x: F.concat(_pad(x["l"] + 200, 3), _pad(x["r"] + 2_000_000, 7))))
               .when(home, let(odd, lambda x: let(x["l"] * 60_000 + x["r"], write_odd)))
               .when(n == 10, let(far, lambda x: F.concat(_pad(x["l"], 3), _pad(x["r"], 7))))
               .when(n.between(6, 16), let(other, lambda x: F.concat(_pad(x["l"], u), _pad(x["r"], n - u)))))
        return let(new, lambda s: F.when(s.isNotNull(), _refill(m, F.concat(cc, s))))

    return let(F.substr(_digits(m), F.length(cc) + 1), make)


def _ip(m: Column, key: str) -> Column:
    def make(o):
        x = feistel(key, "ip", F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)),
                    F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)), F.lit(65536), F.lit(65536))
        return let(x, lambda x: F.concat_ws(".", *[v.cast("string") for h in ("l", "r") for v in
                                                   (F.shiftright(x[h], 8), x[h].bitwiseAND(F.lit(255)))]))

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("bigint")), make)


def _ssn(m: Column, key: str) -> Column:
    def make(p):
        area, group, serial = (F.get(p, F.lit(i)) for i in range(3))
        index = area - 1 - (area > 666).cast("int")

        def write(x):
            new = (x["l"] / 99).cast("bigint")
            return F.concat_ws("-", _pad(new + 1 + (new >= 665).cast("int"), 3), _pad(x["l"] % 99 + 1, 2),
                               _pad(x["r"] + 1, 4))

        x = feistel(key, "ssn", index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))
        return F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), let(x, write))

    return let(F.transform(F.split(m, "-"), lambda x: x.cast("bigint")), make)


def _date(m: Column, key: str) -> Column:
    zero = F.lit("2000-01-01").cast("date")
    out = F.lit(None).cast("string")
    for fmt, mark in (("yyyy-MM-dd", "-"), ("MM/dd/yyyy", "/"), ("dd.MM.yyyy", ".")):
        def make(day, *, fmt=fmt):
            at = F.pmod(day, F.lit(146_097))
            x = feistel(key, "date", (at / 233).cast("bigint"), at % 233, F.lit(627), F.lit(233))
            new = let(x, lambda x: F.date_add(zero, (day - at + x["l"] * 233 + x["r"]).cast("int")))
            return F.when(day >= -584_388, F.date_format(new, fmt))  # 0400-01-01

        day = F.datediff(F.try_to_date(m, fmt), zero).cast("bigint")
        out = F.when(F.contains(m, F.lit(mark)), let(day, lambda d: make(d))).otherwise(out)
    return out


def _email(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    return F.concat(let(F.substr(m, F.lit(1), at - 1), lambda s: feistel_text(key, "email", s)),
                    F.substr(m, at, F.length(m)))


def kind_of(m: Column) -> Column:
    """The kind whose pattern a found value has."""
    out = F.when(F.contains(m, F.lit("@")), "email").when(
        F.startswith(m, F.lit("+")) | F.startswith(m, F.lit("(")) | m.rlike("^[0-9]{3}-[0-9]{3}-[0-9]{4}$"), "phone")
    for kind in ("date", "ssn", "card", "ip"):
        out = out.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a found value of that kind, null where its check fails."""
    make = {"email": _email, "phone": _phone, "date": _date, "ssn": _ssn, "card": _card, "ip": _ip}
    out = None
    for k in KINDS:
        out = (F if out is None else out).when(kind == k, make[k](m, key))
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "found") -> DataFrame:
    """``docs`` with the text replaced and ``found_col``: an array of (kind,
    pseudonym), one entry per replaced value, in text order (null for a null
    text).  An own column of that name gives way to it."""
    require(docs, text_col)
    t = F.col(text_col).cast("string")
    # without an at sign the e-mail pattern, the slower one, cannot match
    values = (F.when(F.contains(t, F.lit("@")), F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)))
              .when(functools.reduce(operator.or_, [F.contains(t, F.lit(str(d))) for d in range(10)]),
                    F.regexp_extract_all(t, F.lit(NUMBERS), F.lit(0)))
              .otherwise(F.array().cast("array<string>")))
    row = docs.select(F.struct(*docs.columns).alias("r"), t.alias("t"), F.when(t.isNotNull(), values).alias("m"))
    # a plan node of its own, so that the values and pseudonyms are computed once
    row = row.select("r", "t", F.transform("m", lambda m: let(kind_of(m), lambda k: F.struct(
        m.alias("raw"), k.alias("kind"), pseudonym(m, k, key).alias("new")))).alias("m"))
    pieces = F.when(F.contains("t", F.lit("@")), F.split("t", PATTERN, -1)).otherwise(F.split("t", NUMBERS, -1))
    new = F.array_join(F.transform(pieces, lambda p, i: F.concat(
        F.when(i == 0, "").otherwise(F.coalesce(F.get("m", i - 1)["new"], F.get("m", i - 1)["raw"])), p)), "")
    text = F.when(F.size("m") > 0, new).otherwise(F.col("t"))
    good = F.transform(F.filter("m", lambda x: x["new"].isNotNull()),
                       lambda x: F.struct(x["kind"].alias("kind"), x["new"].alias("pseudonym")))
    return row.select(*[(text if c == text_col else F.col("r")[c]).alias(c) for c in docs.columns
                        if c != found_col],
                      good.alias(found_col))
