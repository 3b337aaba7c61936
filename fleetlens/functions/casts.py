"""Cleaning and tolerant casts as Column expressions (JVM-side, codegen friendly).

Dirty text follows the same rules as the warehouse build of the reference:
trim spaces, blank -> null, unparseable -> null.  Spark's ``try_cast`` differs
from DuckDB's TRY_CAST for integer text with a fraction or exponent and for
date text; the helpers below close that gap explicitly (hazard H1).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted number and date text shapes.
DIGITS = r"[0-9]+(?:_[0-9]+)*"  # groups of digits may be set apart
NUMBER_TEXT = rf"^ *[+-]?({DIGITS}(?:[.](?:{DIGITS})?)?|[.]{DIGITS})([eE][+-]?{DIGITS})? *$"
HEX_TEXT = r"^0[xX]([0-9a-fA-F]+(?:_[0-9a-fA-F]+)*)$"
BINARY_TEXT = r"^0[bB]([01]+(?:_[01]+)*)$"
SPECIAL_DOUBLE_TEXT = r"^(?i) *[+-]?(inf|infinity|nan) *$"
DATE_TEXT = (r"^ *([0-9]{4})([-/])([0-9]{1,2})\2([0-9]{1,2})"
             r"([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)? *$")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """TRIM (spaces only) then blank -> null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def safe_double(c) -> Column:
    """Text (or number) -> double; unparseable -> null."""
    t = clean_text(_col(c).cast("string"))
    ok = t.rlike(NUMBER_TEXT) | t.rlike(SPECIAL_DOUBLE_TEXT)
    return F.when(ok, F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def _whole_by_base(t: Column, shape: str, base: int, most: int) -> Column:
    """An unsigned number in base 2 or 16 as decimal text; null if the text has another shape or over ``most`` digits."""
    digits = F.replace(F.regexp_extract(t, shape, 1), F.lit("_"), F.lit(""))
    digits = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.when(t.rlike(shape) & (F.length(digits) <= most), F.conv(digits, base, 10))


def safe_int(c, to: str = "bigint") -> Column:
    """Text -> integer the way TRY_CAST does it in the reference engine.

    Plain integers cast exactly (also above 2^53); decimals and exponents are
    rounded half away from zero; ``0x1F`` and ``0b11`` (no sign) and digit groups
    (``1_000``) are numbers.  Doubles are rounded half-to-even before narrowing.
    """
    src = _col(c)
    t = clean_text(src.cast("string"))
    plain = F.replace(t, F.lit("_"), F.lit(""))
    exact = plain.try_cast(to)
    rounded = F.round(plain.try_cast("double")).try_cast(to)
    other = F.coalesce(_whole_by_base(t, HEX_TEXT, 16, 16), _whole_by_base(t, BINARY_TEXT, 2, 64))
    return F.when(t.rlike(NUMBER_TEXT), F.coalesce(exact, rounded)).otherwise(other.try_cast(to))


def narrow_double(c, to: str = "bigint") -> Column:
    """Double -> integer with half-to-even rounding; out of range -> null."""
    return F.bround(_col(c).cast("double")).try_cast(to)


def safe_date(c) -> Column:
    """Text -> date: ``Y-M-D`` or ``Y/M/D`` (one separator) with an optional time of day; anything else -> null."""
    t = _col(c).cast("string")
    y = F.regexp_extract(t, DATE_TEXT, 1)
    m = F.regexp_extract(t, DATE_TEXT, 3)
    d = F.regexp_extract(t, DATE_TEXT, 4)
    return F.when(t.rlike(DATE_TEXT), F.concat_ws("-", y, m, d).try_cast("date"))


def safe_cast(c, to: str) -> Column:
    """Dispatch a tolerant cast by target type name (date/string/int/bigint/double)."""
    if to == "string":
        return clean_text(c)
    if to == "date":
        return safe_date(clean_text(c))
    if to in ("int", "bigint", "smallint", "tinyint"):
        return safe_int(c, to)
    if to in ("double", "float"):
        return safe_double(c).cast(to)
    raise ValueError(f"unsupported target type: {to}")


def failure_flag(c) -> Column:
    """Failure indicator -> boolean; anything but 1 (including null) is false."""
    return F.coalesce(safe_int(c, "int") == 1, F.lit(False))


def is_finite(c) -> Column:
    x = _col(c)
    return x.isNotNull() & ~F.isnan(x) & ~x.isin(float("inf"), float("-inf"))


def finite_or(c, default) -> Column:
    """NaN, +/-inf and null -> ``default`` (0 for training and stored vectors, null before scoring)."""
    x = _col(c)
    return F.when(is_finite(x), x).otherwise(F.lit(default).cast("double"))


def typed(df, name: str, to: str) -> Column:
    """Column ``name`` of ``df`` as type ``to``: tolerant text parsing for strings,
    a plain ``try_cast`` for other types, nothing when the type already matches."""
    dtype = df.schema[name].dataType.simpleString()
    if dtype == to:
        return F.col(name)
    if dtype == "string":
        return safe_cast(F.col(name), to)
    if to in ("int", "bigint") and dtype in ("double", "float"):
        return narrow_double(F.col(name), to)
    return F.col(name).try_cast(to)
