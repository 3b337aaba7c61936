"""Rounding of a double's exact value, half to even."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DIGITS = 6


def round_exact(x: Column, digits: int = DIGITS) -> Column:
    """The double nearest to ``x`` rounded half-to-even at ``digits`` (at most 6) decimals.

    What is rounded is the number that the double is, not its shortest decimal text:
    0.0078125 is a tie and gives 0.007812, 1.0000005 lies below one and gives 1.0.  Far from
    a tie double arithmetic decides; near one the fraction times a power of two, an integer,
    is compared in decimals.  Null, NaN, infinities and numbers without a fraction stay.
    """
    ten = 10 ** digits
    a = F.abs(x)
    whole = F.floor(a).cast("bigint")
    f = a - whole.cast("double")
    y = f * float(ten)
    down = F.floor(y).cast("bigint")
    near = F.abs(y - down.cast("double") - 0.5) < 1e-7  # y is below a million, so its error is far less
    shift = F.lit(54) - F.floor(F.log2(f)).cast("int")
    twice = (f * F.pow(F.lit(2.0), shift)).cast("bigint").cast("decimal(20,0)") * F.lit(2 * ten).cast("decimal(8,0)")
    power = (F.shiftleft(F.lit(1).cast("bigint"), 37).cast("decimal(12,0)")
             * F.call_function("shiftleft", F.lit(1).cast("bigint"), shift - 37).cast("decimal(15,0)"))
    half = power * (2 * down + 1).cast("decimal(8,0)")
    n = F.when(near, F.when(twice > half, down + 1).when(twice < half, down).otherwise(down + down % 2)).otherwise(F.rint(y).cast("bigint"))
    small = (whole * ten + n).cast("double") / float(ten)
    large = (whole.cast("decimal(18,0)") + n.cast("decimal(7,0)") * F.expr(f"1BD / {ten}").cast("decimal(7,6)")).cast("double")
    size = F.when(a >= 2.0 ** 52, a).when(a < 9e9, small).otherwise(large)
    return F.when(x < 0, -size).otherwise(size)
