"""Small column expressions: text cleaning, safe parsing, bands, exact averages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import BANDS, SCORE_MAX

_SPACES = " \t\n\r\x0b\x0c"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_NUMBER_OR_NAME = _NUMBER + r"|(?i)^[+-]?(nan|inf|infinity)$"
_INTEGER = r"^[+-]?\d+$"
# The spelling Spark casts as it is, and every other ISO spelling.
_ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
_ISO_LOOSE = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?)?(?:(Z)|([+-]\d{2}):?(\d{2}))?)?$"
)


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of every kind, not only blanks."""
    return F.btrim(c, F.lit(_SPACES))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def to_double(c: Column) -> Column:
    """Text to double, null when the text is not a plain decimal number or a named float."""
    t = strip(c)
    return F.when(t.rlike(_NUMBER_OR_NAME), t.try_cast("double"))


def to_long(c: Column) -> Column:
    t = strip(c)
    return F.when(t.rlike(_INTEGER), t.try_cast("bigint"))


def _respelled(c: Column) -> Column:
    """Any ISO spelling as ``yyyy-mm-dd hh:mm:ss.f+hh:mm``, missing parts as zeros."""
    t = F.regexp_replace(c, _ISO_LOOSE, "$1-$3-$4 $5:$6:$7.$8$9$10:$11")
    t = F.regexp_replace(t, "(?<=[ :])(?=[:.])", "00")
    return F.regexp_replace(t, r"(?<=\.\d{0,9}Z?):$", "")


def iso_text(c: Column) -> Column:
    """ISO text in the one spelling that casts cleanly, null for anything else."""
    return F.when(c.rlike(_ISO), c).when(c.rlike(_ISO_LOOSE), _respelled(c))


def iso_instant(c: Column) -> Column:
    """ISO text to an instant; text without an offset is UTC (the session zone of every job)."""
    return iso_text(c).try_cast("timestamp")


def iso_wall_clock(c: Column) -> Column:
    """The clock reading as written, ignoring any offset."""
    return iso_text(c).try_cast("timestamp_ntz")


def float_text(c: Column) -> Column:
    """Double as the shortest plain text that reads back as it, without an exponent from 1e-4 to below 1e16."""
    text = c.cast("string")
    # The shortest digits are in the exponent form; a decimal only moves their point.
    plain = F.regexp_replace(text.cast("decimal(38,20)").cast("string"), "(?<=\\.\\d{1,20})0+$", "")
    moved = text.contains("E") & (F.abs(c) >= 1e-4) & (F.abs(c) < 1e16)
    return F.when(moved, plain).otherwise(text)


def quoted(c: Column) -> Column:
    """Text in quotes unless it reads as a number."""
    return F.when(strip(c).rlike(_NUMBER), c).otherwise(F.concat(F.lit("'"), c, F.lit("'")))


def map_values(c: Column, mapping: dict[str, str]) -> Column:
    """Literal lookup as one CASE, falling through to the value itself."""
    if not mapping:
        return c
    items = list(mapping.items())
    expr = F.when(c == items[0][0], items[0][1])
    for k, v in items[1:]:
        expr = expr.when(c == k, v)
    return expr.otherwise(c)


def band(score: Column, name: str) -> Column:
    """Label of the band a score falls in; cut points belong to the upper band."""
    cuts, labels = BANDS[name]
    expr = F.when(score < cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:-1]):
        expr = expr.when(score < cut, label)
    return expr.when(score.isNotNull(), labels[-1])


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def score_percent(score: Column) -> Column:
    """Share of the 0-999 scale, 0 for a missing score."""
    return clamp(F.coalesce(score, F.lit(0)).cast("double"), 0.0, float(SCORE_MAX)) / SCORE_MAX * 100


def share_percent(part: Column, total: Column) -> Column:
    """Whole percent, 0 when the total is 0."""
    return F.coalesce(F.round(part * F.lit(100.0) / F.nullif(total, F.lit(0))), F.lit(0.0)).cast("bigint")


def exact_avg(total: Column, n: Column, scale: int = 2) -> Column:
    """total / n rounded half up on decimals, so no binary rounding creeps in."""
    return F.round(total.cast("decimal(28,2)") / n.cast("decimal(18,0)"), scale)


def all_of(*conds: Column | None) -> Column | None:
    """Conjunction of the given conditions, skipping the ones not asked for."""
    present = [c for c in conds if c is not None]
    return reduce(lambda a, b: a & b, present) if present else None


def add_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, as an operator of their own.

    A plain projection is merged into its neighbours and its expressions are copied into every
    filter above it. Large copies are slow: a generated method over 8 KB is not compiled at run
    time. A generator over one row is a boundary for both.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*df.columns, F.inline(F.array(row)))
