"""Order statistics and cumulative counts from a refined histogram of a score's bits.

A double becomes the long that orders alike.  Its first 16 bits give at most 65,536 cells,
counted in one aggregate with map-side combine; only the cell that holds a wanted place
(or cells with very many rows) is counted again by its next bits.  No rank and no sort of
all rows is made, and what reaches the driver is bounded by the cells, not by the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

FIRST_BITS, NEXT_BITS = 16, 16

# fixed values: the layout of a double
FRACTION_BITS, BIAS = 52, 1023
LEAST_NORMAL, LEAST = 2.0 ** -1022, 2.0 ** -1074
NAN_BITS, NULL_BITS = (1 << 63) - 1, -(1 << 63)


def ordered_bits(score: Column) -> Column:
    """A long with the order of the double, by arithmetic alone: equal doubles (0.0 and -0.0) are equal,
    NaN is the greatest and null the least, as Spark sorts them in descending order."""
    x = score.cast("double")
    a = F.abs(x)
    guess = F.greatest(F.lit(-BIAS + 1), F.least(F.lit(BIAS), F.floor(F.log2(a)).cast("int")))
    ratio = a / F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(ratio >= 2, 1).when(ratio < 1, -1).otherwise(0)  # the logarithm may be off at a power of two
    fraction = ((a / F.pow(F.lit(2.0), exponent) - 1) * F.lit(2.0 ** FRACTION_BITS)).cast("long")
    normal = F.shiftleft((exponent + BIAS).cast("long"), FRACTION_BITS) + fraction
    size = (F.when(a == 0, F.lit(0).cast("long")).when(a == float("inf"), F.lit(2 * BIAS + 1).cast("long") * (1 << FRACTION_BITS))
            .when(a < LEAST_NORMAL, (a / LEAST).cast("long")).otherwise(normal))
    return (F.when(x.isNull(), F.lit(NULL_BITS)).when(F.isnan(x), F.lit(NAN_BITS))
            .when(x < 0, -size).otherwise(size))


@contextmanager
def slim(df: DataFrame, y: str, score: str, keep: list[str] | None = None):
    """``df`` as (bits, hit, *keep), held for the several small passes unless ``df`` is cached already."""
    rows = df.select(ordered_bits(F.col(score)).alias("_bits"), F.coalesce(F.col(y).cast("long"), F.lit(0)).alias("_hit"),
                     *[F.col(c) for c in keep or []])
    held = df.storageLevel.useMemory or df.storageLevel.useDisk
    rows = rows if held else rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        if not held:
            rows.unpersist()


def _cells(rows: DataFrame, bits: int, within: list[int] | None = None, of: int = 0) -> list:
    """(cell, n, hits, low, high) by the first ``bits`` bits, of the cells ``within`` of the first ``of`` bits; highest first."""
    if within is not None:
        rows = rows.where(F.shiftright("_bits", 64 - of).isin(within))
    cells = rows.groupBy(F.shiftright("_bits", 64 - bits).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_hit").alias("hits"), F.min("_bits").alias("low"), F.max("_bits").alias("high"))
    return sorted(cells.collect(), key=lambda r: -r["cell"])


@dataclass
class Cut:
    """Where the first ``k`` rows by descending score end: at the value ``bits``, which ``ties`` rows have."""
    k: int
    above: int = 0
    above_hits: int = 0
    bits: int | None = None
    ties: int = 0
    ties_hits: int = 0

    @property
    def rest(self) -> int:
        """How many of the ties are among the first k."""
        return min(self.k - self.above, self.ties)


def top_cuts(rows: DataFrame, ks: Callable[[int], list[int]]) -> tuple[int, int, list[Cut]]:
    """(rows, hits, a cut per wanted k) of a ``slim`` frame; ``ks`` maps the number of rows to the wanted places.

    One aggregate over all rows, then up to three over the cells that hold the cuts.
    """
    cells = _cells(rows, FIRST_BITS)
    n, hits = sum(r["n"] for r in cells), sum(r["hits"] for r in cells)
    cuts = [Cut(k) for k in ks(n)]
    if not n:
        return 0, 0, cuts

    def descend(cut: Cut, among: list) -> int | None:
        """Pass the cells above the cut; the cell it is in, if that holds several values."""
        for r in among:
            if cut.above + r["n"] >= cut.k or r is among[-1]:
                if r["low"] == r["high"]:
                    cut.bits, cut.ties, cut.ties_hits = r["low"], r["n"], r["hits"]
                    return None
                return r["cell"]
            cut.above, cut.above_hits = cut.above + r["n"], cut.above_hits + r["hits"]
        return None

    places = {id(c): descend(c, cells) for c in cuts}
    bits = FIRST_BITS
    while any(p is not None for p in places.values()):
        wanted = sorted({p for p in places.values() if p is not None})
        finer = _cells(rows, bits + NEXT_BITS, wanted, bits)
        for c in cuts:
            if places[id(c)] is not None:
                places[id(c)] = descend(c, [r for r in finer if r["cell"] >> NEXT_BITS == places[id(c)]])
        bits += NEXT_BITS
    return n, hits, cuts


@dataclass
class Leaves:
    """Ranges of scores with few enough rows each, and the rows and hits above each."""
    heavy: dict[int, list[int]]  # number of bits -> cells that were divided further
    above: list[tuple[int, int, int, int]]  # (number of bits, cell, rows above, hits above)
    hits: int  # of all rows

    def columns(self) -> tuple[Column, Column]:
        """(number of bits, cell) of a row's leaf."""
        sizes = sorted(self.heavy) + [max(self.heavy, default=FIRST_BITS - NEXT_BITS // 2) + NEXT_BITS // 2]
        bits, cell = F.lit(sizes[-1]), F.shiftright("_bits", 64 - sizes[-1])
        for size in reversed(sizes[:-1]):
            at = F.shiftright("_bits", 64 - size)
            inside = at.isin(self.heavy[size])
            bits, cell = F.when(inside, bits).otherwise(size), F.when(inside, cell).otherwise(at)
        return bits.cast("int"), cell


def leaves(rows: DataFrame, most: int) -> Leaves:
    """Divide the scores until no leaf of several values has more than ``most`` rows.

    A leaf is divided by 8 more bits at a time, so at most 256 cells come back for each of the
    at most ``rows / most`` that are too large.
    """
    step = NEXT_BITS // 2
    done: list[tuple[int, int, object]] = []
    heavy: dict[int, list[int]] = {}
    bits, cells = FIRST_BITS, _cells(rows, FIRST_BITS)
    while True:
        large = [r["cell"] for r in cells if r["n"] > most and r["low"] < r["high"] and bits < 64]
        split = set(large)
        done += [(r["low"], bits, r) for r in cells if r["cell"] not in split]
        if not large:
            break
        heavy[bits] = large
        cells = _cells(rows, bits + step, large, bits)
        bits += step
    above, n, hits = [], 0, 0
    for _, size, r in sorted(done, key=lambda d: -d[0]):
        above.append((size, r["cell"], n, hits))
        n, hits = n + r["n"], hits + r["hits"]
    return Leaves(heavy, above, hits)
