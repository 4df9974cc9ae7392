"""Column expressions for raw text cells: trimming, missing tests, number guards.

Three notions of "missing" exist side by side on purpose and never share code
paths: a cell that is blank after trimming (quality, reconcile, drift), a cell
spelled as one of a list of literals (imputation), and a cell that coerces to
NULL (wrangling).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.fixed import FLOAT_CELL, INT_CELL, MISSING_LITERALS, STRAY_UNDERSCORE, WHITESPACE


def field(name: str) -> Column:
    """Reference a top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def cell(df: DataFrame, name: str) -> Column:
    """The column as text, or NULL text when the frame does not have it."""
    if name in df.columns:
        return field(name).cast("string")
    return F.lit(None).cast("string")


def strip_ws(c: Column) -> Column:
    """Trim Unicode whitespace from both ends (SQL trim removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def normalise(c: Column) -> Column:
    """Trimmed text with NULL folded into the empty string."""
    return F.coalesce(strip_ws(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return normalise(c) == ""


def is_missing_literal(c: Column) -> Column:
    """NULL or one of the listed spellings; case-sensitive and untrimmed."""
    return c.isNull() | c.isin(*MISSING_LITERALS)


def full_match(c: Column, pattern: str) -> Column:
    """True when the whole text matches; classes such as \\s are Unicode-aware."""
    return c.rlike(rf"(?U)\A(?:{pattern})\z")


def _spelled(s: Column, pattern: str) -> Column:
    return s.rlike(rf"\A{pattern}\z") & _tidy(s)


def _tidy(s: Column) -> Column:
    """No underscore but between digits."""
    return ~F.contains(s, F.lit("_")) | ~s.rlike(STRAY_UNDERSCORE)


def number(s: Column) -> Column:
    """Trimmed text to double, NULL when the text is not a number.

    The guard runs before the cast because the cast alone would accept type
    suffixes and hex floats and refuse digit separators.  Only a signed NaN
    passes the guard and fails the cast, hence the NaN fallback.
    """
    value = F.coalesce(F.replace(s, F.lit("_"), F.lit("")).try_cast("double"), F.lit(float("nan")))
    return F.when(_spelled(s, FLOAT_CELL), value)


def to_float(c: Column) -> Column:
    """Raw text to double, NULL when the text is not a number."""
    return number(strip_ws(c))


def to_int(c: Column) -> Column:
    """Text to bigint, NULL when it is not a whole number or does not fit."""
    s = strip_ws(c)
    return F.when(_spelled(s, INT_CELL), F.replace(s, F.lit("_"), F.lit("")).try_cast("bigint"))


def to_long_int(c: Column) -> Column:
    """Text to decimal(38,0), NULL when it is not a whole number or has more digits."""
    s = strip_ws(c)
    return F.when(_spelled(s, INT_CELL), F.replace(s, F.lit("_"), F.lit("")).try_cast("decimal(38,0)"))


def _is_whole(c: Column) -> Column:
    return _spelled(strip_ws(c), INT_CELL)


def is_finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) != float("inf"))


# Classes of a trimmed cell.
BLANK, TEXT, WHOLE, NUMBER = 0, 1, 2, 3


def cell_class(s: Column) -> Column:
    """The class of trimmed text, with one number pattern; everything after it asks for less."""
    number = _spelled(s, FLOAT_CELL)
    return (
        F.when(F.coalesce(s, F.lit("")) == "", BLANK)
        .when(~number, TEXT)
        .when(s.rlike("[^0-9_+-]"), NUMBER)
        .otherwise(WHOLE)
    )


def _number_parts(s: Column) -> tuple[Column, Column, Column]:
    """The values that a cell of digits or a number can take: bigint, decimal(38,0) and double."""
    bare = F.replace(s, F.lit("_"), F.lit(""))
    return bare.try_cast("bigint"), bare.try_cast("decimal(38,0)"), bare.try_cast("double")


def coerce_class(s: Column, kind: Column) -> Column:
    """Trimmed text of a known class as VARIANT (see :func:`coerce`)."""
    whole, long_whole, real = _number_parts(s)
    text = s.cast("variant")
    return (
        F.when(kind == WHOLE, F.coalesce(whole.cast("variant"), long_whole.cast("variant"), text))
        .when(kind == NUMBER, F.coalesce(F.when(is_finite(real), real).cast("variant"), text))
        .when(kind == TEXT, text)
    )


def coerce_kind(c: Column) -> Column:
    """Which type :func:`coerce` gives the cell: int, float, string or NULL."""
    s = strip_ws(c)
    kind = cell_class(s)
    _, long_whole, real = _number_parts(s)
    return (
        F.when(kind == BLANK, F.lit(None).cast("string"))
        .when((kind == WHOLE) & long_whole.isNotNull(), "int")
        .when((kind == NUMBER) & is_finite(real), "float")
        .otherwise("string")
    )


def coerce(c: Column) -> Column:
    """Best-effort typing of one cell as VARIANT: integer, double, text or NULL.

    Whole numbers keep all their digits: beyond bigint they become decimals, and
    with more than 38 digits they stay text.  NaN and infinities stay text, since
    they have no JSON form and would not survive a round trip.
    """
    s = strip_ws(c)
    return coerce_class(s, cell_class(s))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields 0.0 for an empty denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def melt(one_row: DataFrame, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """Turn a one-row wide aggregate into long rows.

    ``rows`` holds tuples of literals and Columns, one tuple per output row.
    """
    structs = [
        F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in zip(names, row)])
        for row in rows
    ]
    return one_row.select(F.inline(F.array(*structs)))
