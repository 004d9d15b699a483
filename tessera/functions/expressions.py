"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's results:
#   a word is a whole token made only of ASCII letters, case-sensitive;
#   temperature readings are tenths of a degree Celsius, converted in 32-bit
#   float arithmetic as value * 0.1 * (9 / 5) + 32.
ALPHA_WORD = r"\A[a-zA-Z]+\z"
TENTH = 0.1
NINE_FIFTHS = 9.0 / 5.0
FREEZING_F = 32.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_alpha_word(c) -> Column:
    """Whole-string match of ``[a-zA-Z]+`` (``\\A``/``\\z`` anchors, so a
    trailing newline is not accepted and the empty token is rejected)."""
    return _col(c).rlike(ALPHA_WORD)


def tenths_celsius_to_fahrenheit_f32(c) -> Column:
    """value * 0.1f * (9f/5f) + 32f evaluated in float, result type float."""
    f = lambda x: F.lit(x).cast("float")
    return (_col(c).cast("float") * f(TENTH) * f(NINE_FIFTHS) + f(FREEZING_F)).cast("float")


def int_mean(sum_col, count_col) -> Column:
    """Integer mean truncated toward zero (``sum div count``) as int."""
    return F.expr("cast(({s}) div ({n}) as int)".format(
        s=_expr_sql(sum_col), n=_expr_sql(count_col)))


def _expr_sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("int_mean takes column names")


def cosine_score(xy, xx, yy, zero_denominator: float | None = None) -> Column:
    """sum(xy) / (sqrt(sum(xx)) * sqrt(sum(yy))).

    A zero denominator gives null (the pair can never pass a ``score >``
    threshold, as NaN could not in the original unguarded job), or
    ``zero_denominator`` (0.0 in the guarded variant).  Spark orders NaN
    above every number, so NaN is never produced.
    """
    score = F.try_divide(_col(xy), F.sqrt(_col(xx)) * F.sqrt(_col(yy)))
    if zero_denominator is not None:
        score = F.coalesce(score, F.lit(float(zero_denominator)))
    return score


def other_item(i1, i2, item) -> Column:
    """The member of the pair (i1, i2) that is not ``item``."""
    return F.when(_col(i1) == F.lit(item), _col(i2)).otherwise(_col(i1))


def rstrip_ws(c) -> Column:
    """Remove trailing whitespace (``\\s``), as the JVM split does implicitly."""
    return F.regexp_replace(_col(c), r"\s+$", "")


def jvm_trim(c) -> Column:
    """JVM ``String.trim``: strip every character <= U+0020 at both ends
    (Spark's ``trim`` strips only the space character)."""
    return F.regexp_replace(_col(c), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def trimmed_split(c, pattern: str = r"\s+") -> Column:
    """JVM ``String.split`` drops trailing empty fields, Spark's ``split``
    keeps them; removing trailing whitespace first gives the same field
    list for whitespace separators (a leading blank still yields an empty
    first field, as on the JVM)."""
    return F.split(rstrip_ws(c), pattern)
