"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments, and every segment value is a key of an index table.  Radius
by radius and segment by segment, the keys at that distance from a query's segment are
looked up and the codes found are verified; the pigeonhole principle says how near a code
must be to have been met, and a query is done when its k-th verified distance is within
that bound.  The queries are
searched against all codes in blocks of both, each block pair in one task with bounded
memory, and the blocks' answers are merged.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.llm.common import staged

#: Bits of a word in which codes are kept, and most bits of a segment.
SEGMENT_BITS = 16
TOP = 10
#: Most codes and most queries of a block, and the least number of blocks of each.
BLOCK_CODES, BLOCK_QUERIES, LEAST_BLOCKS = 1 << 17, 1 << 13, 4


def codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, dims, code): the signs of a vector, 1 where positive, as 16-bit segments.

    Rows with a null id, a null or an empty vector have no code; a null element counts as
    not positive.  Rows equal in id and code count once.
    """
    bits = (f"transform(sequence(0, CAST(ceil(size(v) / {SEGMENT_BITS}.0) AS INT) - 1), s -> "
            f"aggregate(sequence(0, {SEGMENT_BITS - 1}), 0, (a, i) -> "
            f"a + IF(coalesce(get(v, s * {SEGMENT_BITS} + i), 0) > 0, shiftleft(1, i), 0)))")
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
            .where("id IS NOT NULL AND size(v) > 0")
            .select("id", F.size("v").alias("dims"), F.expr(bits).alias("code")).distinct())


class MultiIndex:
    """Index tables of a block of codes (n rows of 16-bit words), one per segment.

    A segment has about as many bits as the number of codes has, so that a key holds about
    one code, and segments are of equal length but for one bit.
    """

    def __init__(self, codes: np.ndarray, dims: int):
        self.codes = codes
        self.n_bits = dims
        parts = max(1, round(dims / min(SEGMENT_BITS, max(4, round(math.log2(max(2, len(codes))))))))
        cuts = [dims * i // parts for i in range(parts + 1)]
        self.cuts = list(zip(cuts, cuts[1:]))
        self.tables = []
        for (a, b), segment in zip(self.cuts, self.segments(codes)):
            order = np.argsort(segment, kind="stable")
            self.tables.append((order, np.searchsorted(segment[order], np.arange((1 << (b - a)) + 1))))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def segments(self, codes: np.ndarray):
        for a, b in self.cuts:
            value = np.zeros(len(codes), np.int64)
            for i in range(a, b):
                value |= ((codes[:, i // SEGMENT_BITS].astype(np.int64) >> (i % SEGMENT_BITS)) & 1) << (i - a)
            yield value

    def mask(self, bits: int, distance: int) -> np.ndarray:
        if (bits, distance) not in self.masks:
            self.masks[bits, distance] = np.array([sum(1 << i for i in at) for at in combinations(range(bits), distance)], np.int64)
        return self.masks[bits, distance]

    def nearest(self, query: np.ndarray, need: int, first_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, distance) of the ``need`` nearest codes, ties by ``first_ids``.

        Radii grow one segment at a time.  With m segments searched to radius s and j of them to
        s + 1, a code that none of them met differs in m (s + 1) + j bits at least.
        """
        seen = np.zeros(len(self.codes), bool)
        rows, apart = np.zeros(0, np.int64), np.zeros(0, np.int64)
        values = [int(v[0]) for v in self.segments(query[None, :])]
        kth = None
        for s in range(1 + max(b - a for a, b in self.cuts)):
            for j, ((a, b), value, (order, offsets)) in enumerate(zip(self.cuts, values, self.tables), 1):
                keys = value ^ self.mask(b - a, s)
                start, count = offsets[keys], offsets[keys + 1] - offsets[keys]
                total = int(count.sum())
                if total:
                    found = order[np.repeat(start - np.cumsum(count) + count, count) + np.arange(total)]
                    found = found[~seen[found]]
                    seen[found] = True
                    rows = np.concatenate((rows, found))
                    apart = np.concatenate((apart, np.bitwise_count(self.codes[found] ^ query).sum(axis=1, dtype=np.int64)))
                    if len(rows) >= need:
                        kth = np.partition(apart, need - 1)[need - 1]
                if len(rows) == len(seen) or (kth is not None and kth < len(self.cuts) * s + j):
                    best = np.lexsort((first_ids[rows], apart))[:need]
                    return rows[best], apart[best]
        raise AssertionError("the last radius meets every code")


def _search_block(need):
    def run(key, index, asked):
        import pandas as pd

        out = []
        if len(index) and len(asked):
            tables = MultiIndex(np.array(index["code"].tolist(), np.uint16), int(key[0]))
            ids = index["ids"].tolist()
            first = np.array([i[0] for i in ids], np.int64)
        else:
            asked = asked[:0]
        for query, code in zip(asked["query"], asked["code"]):
            rows, apart = tables.nearest(np.array(code, np.uint16), need, first)
            out += [(query, d, ids[r]) for r, d in zip(rows.tolist(), apart.tolist())]
        return pd.DataFrame(out, columns=["query", "distance", "ids"]).astype({"query": "int64", "distance": "int64"})
    return run


def search(rows: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest other ids, ties by id.

    Both inputs are results of ``codes``; only codes of equal length are compared.  Equal
    codes are one entry of the index with the least k + 1 ids, of which no answer needs
    more, and equal query codes are searched once, so a code that a third of all rows have
    costs no more than another.  An empty table has no answers.
    """
    need = k + 1  # the query itself may be among the rows
    by_code = Window.partitionBy("dims", "code").orderBy("id")
    least = rows.withColumn("nth", F.row_number().over(by_code)).where(F.col("nth") <= need)
    index = staged(least.groupBy("dims", "code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "hamming-index")
    asked = staged(queries.select("dims", "code").distinct().withColumn("query", F.monotonically_increasing_id()), "hamming-queries")
    code_blocks = max(LEAST_BLOCKS, -(-index.count() // BLOCK_CODES))
    query_blocks = max(LEAST_BLOCKS, -(-asked.count() // BLOCK_QUERIES))

    def numbered(blocks):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    every_index = index.select("dims", "code", "ids", F.pmod(F.xxhash64("code"), F.lit(code_blocks)).cast("int").alias("p"),
                               numbered(query_blocks).alias("r"))
    every_query = asked.select("dims", "code", "query", numbered(code_blocks).alias("p"),
                               F.pmod(F.xxhash64("code", F.lit(1)), F.lit(query_blocks)).cast("int").alias("r"))
    found = (every_index.groupBy("dims", "p", "r").cogroup(every_query.groupBy("dims", "p", "r"))
             .applyInPandas(_search_block(need), "query long, distance long, ids array<long>"))
    answers = staged(found.select("query", "distance", F.explode("ids").alias("neighbor_id")), "hamming-found")
    nearest = Window.partitionBy("query").orderBy("distance", "neighbor_id")
    answers = answers.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= need).drop("nth")
    asking = queries.select(F.col("id").alias("query_id"), "dims", "code").join(asked, ["dims", "code"]).select("query_id", "query")
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (asking.join(answers.hint("shuffle_merge"), "query").where("neighbor_id <> query_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "neighbor_id", "distance"))
