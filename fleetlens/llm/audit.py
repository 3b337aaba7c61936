"""Filter interaction audit: a Gray-code walk over the subsets of five filters.

Each document becomes a mask of the filters it fails.  Counts of equal masks are the 32
cells of a part.  A walk through the subsets in Gray-code order toggles one filter at a
time: each cell counts its failures among the active filters, and the running survivors
change only by cells whose counter leaves or reaches zero.  The 32 states are stored;
every step of every order is a difference of two of them.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.common import staged, utf8

# The filters in the order of their mask bits, what separates words, and their limits.
FILTERS = "ABCDE"
BLANKS = r"[\x20\x09-\x0D]+"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SIGNS = r"[#$%&*|]"

CELLS = 1 << len(FILTERS)
COUNTS = ("n", "good", "toxic")

OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column, words: Column) -> Column:
    """Mask of the filters A to D that a text fails (bit 0 is A)."""
    n = F.size(words)
    failed = (n < MIN_WORDS,
              100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n,
              100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITALS_PERCENT * F.length(text),
              text.rlike(SIGNS))
    mask = F.lit(0)
    for bit, condition in enumerate(failed):
        mask = mask + F.when(condition, 1 << bit).otherwise(0)
    return mask


def marked(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           part_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic) of every document.

    Texts are read once; what moves is an id, a SHA-256 of the text, the part and a mask.
    The least id of each text is an aggregate, combined before it moves, and comes back by
    digest and id, so a text that a third of all rows hold is not one group.  Null ids get
    a salt that no label has, so they spread over the label join too.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(f"`{part_col}`").alias("part"),
                       utf8(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", BLANKS), ""))
    slim = staged(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                              text_failures(F.col("text"), F.col("words")).alias("mask")), "audit-marks")
    firsts = slim.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = slim.join(firsts.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    repeated = F.col("doc_id").isNotNull() & F.col("first").isNull()
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.lit(0).cast("long").alias("salt"),
                           *[F.coalesce(F.col(c) == 1, F.lit(False)).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))])
             .where("(good OR toxic) AND id IS NOT NULL")
             .groupBy("id", "salt").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    full = first.select("part", (F.col("mask") + F.when(repeated, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"),
                        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
                        F.when(F.col("doc_id").isNull(), F.abs(F.xxhash64("digest") % 1_000_000) + 1).otherwise(0).cast("long").alias("salt"))
    return full.join(known, ["id", "salt"], "left").select(
        "part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of the filters: ``cells[..., mask]`` -> ``states[..., subset]``.

    One filter is toggled at a time; a cell survives while none of its failures is active.
    """
    n = cells.shape[-1]
    masks = np.arange(n)
    active = np.zeros(n, np.int64)  # each cell's failures among the active filters
    running = cells.sum(axis=-1)
    states = np.empty(cells.shape, np.int64)
    states[..., 0] = running
    for step in range(1, n):
        subset = step ^ (step >> 1)
        bit = (step & -step).bit_length() - 1
        touched = masks[(masks >> bit) & 1 == 1]
        if subset >> bit & 1:
            running = running - cells[..., touched[active[touched] == 0]].sum(axis=-1)
            active[touched] += 1
        else:
            active[touched] -= 1
            running = running + cells[..., touched[active[touched] == 0]].sum(axis=-1)
        states[..., subset] = running
    return states


def orders() -> tuple[list[str], np.ndarray, np.ndarray]:
    """All orders of the filters, the filter of each step, and the subset active after each step."""
    perms = np.array(list(itertools.permutations(range(len(FILTERS)))))
    return ["".join(FILTERS[i] for i in p) for p in perms], perms, np.cumsum(1 << perms, axis=1)


def _steps(batches):
    import pyarrow as pa

    names, filters, after = orders()
    before = after - (1 << filters)
    alone, full = 1 << np.arange(len(FILTERS)), CELLS - 1
    per_part = filters.size
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            cells = np.stack([batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, CELLS) for c in COUNTS], axis=1)
            states = gray_walk(cells)
            lost = states[:, :, before] - states[:, :, after]  # part, count, order, step
            removed = lost[:, 0]
            fails = states[:, 0, :1] - states[:, 0, alone]
            unique = states[:, 0, full - alone] - states[:, 0, full:]
            shapley = np.stack([(removed * (filters == f)).sum(axis=(1, 2)) for f in range(len(FILTERS))], axis=1)
            parts = batch.num_rows
            longs = [states[:, 0, after], removed, fails[:, filters] - removed, unique[:, filters], lost[:, 1], lost[:, 2],
                     shapley[:, filters]]
            order_at = np.tile(np.repeat(np.arange(len(names)), len(FILTERS)), parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("part").take(pa.array(np.repeat(np.arange(parts), per_part))),
                 pa.array(names, pa.string()).take(pa.array(order_at)),
                 pa.array(np.tile(np.arange(1, len(FILTERS) + 1), parts * len(names)), pa.int32()),
                 *[pa.array(v.reshape(-1), pa.int64()) for v in longs]],
                names=[f.strip().split(" ")[0] for f in OUT.split(",")])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, filter order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley (counts of documents, zeros included).

    A null text is empty, a null part the empty string.  Copies are equal texts with a
    lesser id anywhere in the table; a null id is nobody's copy and has no label, and rows
    equal in id and text are not each other's copies.  A document is good or toxic if any
    of its label rows says so.  Whole texts of any length are read; an empty table gives no
    rows.  Columns beyond those named are not read.
    """
    of = marked(docs, labels, id_col, text_col, part_col)
    cells = of.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good"),
                                           F.sum(F.col("toxic").cast("long")).alias("toxic"))
    wide = cells.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long") for m in range(CELLS)]).alias(c)
        for c in COUNTS])
    return wide.mapInArrow(_steps, OUT)
