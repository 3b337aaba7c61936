"""Resharding by minimum-cost flow.

From the bytes of the old shards and the capacities of the new ones, a flow decides how
many bytes go where so that the fewest leave their shard.  Rows are then dealt to meet
the flow: rows that are large against a shard one by one, all others by byte ranges of
their shard's order.  Only files of shards that lose or get rows are written.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import staged, utf8
from fleetlens.session import scratch_path

#: A row is large if it has more than this part of a new shard; at most shards * LARGE rows can be.
LARGE = 256
#: Bytes of a block, the unit that one task orders; every old shard has LEAST_BLOCKS blocks at least.
BLOCK_BYTES, LEAST_BLOCKS = 256 << 20, 32
#: Bytes that a row has besides its text.
ROW_BYTES = 8


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard at least total ``cost(old, new)`` per byte.

    Successive shortest paths with potentials; all of the supply is placed, for which the
    capacities must suffice.
    """
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    edges: list[list[int]] = []  # to, free, cost; the reverse of edge e is e ^ 1
    leaving: list[list[int]] = [[] for _ in range(n + m + 2)]

    def add(a, b, free, price):
        leaving[a].append(len(edges))
        leaving[b].append(len(edges) + 1)
        edges.extend(([b, free, price], [a, 0, -price]))

    for i, have in enumerate(supply):
        add(source, i, have, 0)
    between = len(edges)
    for i, have in enumerate(supply):
        for j in range(m):
            add(i, n + j, have, cost(i, j))
    for j, room in enumerate(capacity):
        add(n + j, sink, room, 0)
    potential, left = [0] * len(leaving), sum(supply)
    while left:
        far = [float("inf")] * len(leaving)
        far[source], via, heap = 0, [-1] * len(leaving), [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in leaving[a]:
                b, free, price = edges[e]
                if free and d + price + potential[a] - potential[b] < far[b]:
                    far[b], via[b] = d + price + potential[a] - potential[b], e
                    heapq.heappush(heap, (far[b], b))
        if via[sink] < 0:
            raise ValueError("the new shards have too little capacity")
        potential = [p + (f if f < float("inf") else 0) for p, f in zip(potential, far)]
        amount, b = left, sink
        while b != source:
            amount, b = min(amount, edges[via[b]][1]), edges[via[b] ^ 1][0]
        b = sink
        while b != source:
            edges[via[b]][1] -= amount
            edges[via[b] ^ 1][1] += amount
            b = edges[via[b] ^ 1][0]
        left -= amount
    return {(i, j): edges[between + 2 * (i * m + j) + 1][1] for i in range(n) for j in range(m)
            if edges[between + 2 * (i * m + j) + 1][1]}


@dataclass
class Plan:
    """``flow``: bytes by (old, new); ``large``: (id hash, old, new) of large rows; ``ranges``: (old, start, end, new)
    of the other rows' bytes; ``kept``: shards whose file stays as it is."""

    flow: dict[tuple[int, int], int]
    large: list[tuple[int, int, int]]
    ranges: list[tuple[int, int, int, int]]
    kept: list[int]
    moved: int


def _move(old: int, new: int) -> int:
    return int(old != new)


def make_plan(sizes: list[int], large: list[tuple[int, int, int]], capacity: list[int], cost=_move) -> Plan:
    """Plan from old shard sizes (bytes), large rows (hash, old, bytes) and new capacities."""
    flow = min_cost_flow(sizes, capacity, cost)
    quota, free = dict(flow), list(capacity)
    placed, left = [], list(sizes)
    for key, old, size in sorted(large, key=lambda x: (-x[2], x[1], x[0])):
        new = max((j for i, j in quota if i == old), key=lambda j: (quota[old, j], j == old, -j))
        quota[old, new] -= size
        free[new] -= size
        left[old] -= size
        placed.append((key, old, new, size))
    rest = min_cost_flow(left, [max(0, f) for f in free], cost)
    ranges = []
    for i in range(len(sizes)):
        at = 0
        for j in sorted((j for a, j in rest if a == i), key=lambda j: (j != i, j)):
            ranges.append((i, at, at + rest[i, j], j))
            at += rest[i, j]
    leave = [(i, j, size) for _, i, j, size in placed if i != j] + [(i, j, b - a) for i, a, b, j in ranges if i != j]
    changed = {x for i, j, _ in leave for x in (i, j)}
    kept = [i for i in range(min(len(sizes), len(capacity))) if i not in changed and sizes[i]]
    return Plan(flow, [p[:3] for p in placed], ranges, kept, sum(n for *_, n in leave))


def reshard(docs: DataFrame, old: Column, n_old: int, n_new: int, capacity: list[int] | None = None,
            id_col: str = "doc_id", text_col: str = "text", path: str | None = None, cost=_move) -> tuple[DataFrame, Plan]:
    """Put the rows of ``docs`` into ``n_new`` shards; returns (rows by shard, plan).

    ``old`` says each row's shard now, 0 to n_old - 1; the capacities are equal where none are
    given.  A row has the UTF-8 bytes of its text (null: none) plus 8.  The result has the
    columns c0, c1, ... of ``docs`` in their order, shard, old_shard, size and slot (gapless from 0
    in each shard); shards that change are read back from the files written under ``path``,
    the others from ``docs``.  Rows equal in id and text go to one shard; null ids are an id.
    A row larger than its share is a block of its own; an empty table gives no rows and a plan without moves.

    Texts are shuffled once, by block; the offsets of blocks join in that partitioning.  Only
    the large rows and the old shards' ranges are broadcast.  The driver gets the sizes of the old shards and the large rows,
    whose number the shard count bounds.
    """
    spark = docs.sparkSession
    names = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    key, text = names[id_col.lower()], names[text_col.lower()]
    size = (F.octet_length(utf8(text)) + ROW_BYTES).cast("long")
    rows = (docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], old.cast("int").alias("old_shard"))
            .withColumns({"size": size, "row_hash": F.xxhash64(key, text)}))
    light = staged(rows.select("old_shard", "row_hash", "size"), "shard-sizes")
    have = {r[0]: (r[1], r[2]) for r in light.groupBy("old_shard").agg(F.sum("size"), F.count(F.lit(1))).collect()}
    sizes = [have.get(i, (0, 0))[0] for i in range(n_old)]
    total = sum(sizes)
    capacity = capacity or [total // n_new + (j < total % n_new) for j in range(n_new)]
    least = total // (n_new * LARGE)
    equal = light.groupBy("old_shard", "row_hash").agg(F.sum("size").alias("size"))
    # the sums of the large rows add up to the total at most, so there are n_new * LARGE at most
    large = [(r[1], r[0], r[2]) for r in equal.where(F.col("size") > least).collect()]
    plan = make_plan(sizes, large, capacity, cost)

    blocks = max(LEAST_BLOCKS, -(-max(sizes) // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("row_hash"), F.lit(blocks)).cast("int")
    named = spark.createDataFrame(plan.large or [(0, -1, -1)], "row_hash long, old_shard int, large_to int")
    cuts: dict[int, list[tuple[int, int]]] = {}
    for i, _, end, j in plan.ranges:
        cuts.setdefault(i, []).append((end, j))
    ways = spark.createDataFrame([(i, x) for i, x in cuts.items()] or [(-1, [])], "old_shard int, ways array<struct<end:long,to:int>>")

    def marked(table):
        return table.withColumn("block", block).join(F.broadcast(named), ["old_shard", "row_hash"], "left")

    small = F.when(F.col("large_to").isNull(), F.col("size")).otherwise(0)
    in_order = Window.partitionBy("old_shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (marked(light).groupBy("old_shard", "block").agg(F.sum(small).alias("bytes"))
              .select("old_shard", "block", F.coalesce(F.sum("bytes").over(in_order), F.lit(0)).alias("before")))
    inside = Window.partitionBy("old_shard", "block").orderBy("row_hash", "size")
    up_to = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # equal rows get the place of the first of them
    group = Window.partitionBy("old_shard", "block", "row_hash")
    changed = rows.where(~F.col("old_shard").isin(plan.kept)) if plan.kept else rows
    placed = (marked(changed).withColumns({"pos": F.row_number().over(inside), "upto": F.sum(small).over(up_to)})
              .withColumn("at", F.min(F.col("upto") - small).over(group) + F.sum(small).over(group) / 2)
              .join(before.hint("shuffle_merge"), ["old_shard", "block"]).join(F.broadcast(ways), "old_shard", "left"))
    target = F.get(F.filter("ways", lambda w: F.col("before") + F.col("at") < w["end"]), 0)["to"]
    last = F.element_at("ways", -1)["to"]
    data = [f"c{i}" for i in range(len(docs.columns))]
    dealt = placed.select(*data, "size", "old_shard", "block", "pos",
                          F.coalesce("large_to", target, F.when(F.size("ways") > 0, last), "old_shard").alias("shard"))
    where = path or scratch_path(spark, "shards")
    dealt.write.partitionBy("shard").parquet(where)
    back = spark.read.schema(dealt.schema).parquet(where)
    if plan.kept:
        same = Window.partitionBy("old_shard", "block").orderBy("row_hash", "size")
        back = back.unionByName(rows.where(F.col("old_shard").isin(plan.kept)).withColumn("block", block)
                                .withColumn("pos", F.row_number().over(same)).withColumn("shard", F.col("old_shard"))
                                .select(back.columns))
    return back, plan


def with_slots(back: DataFrame, *columns: Column) -> DataFrame:
    """shard, old_shard, slot and the ``columns`` of the rows that ``reshard`` returns.

    Slots follow old shard, block and place in the block; blocks are counted before their
    offsets are summed, so no task orders a whole shard.
    """
    light = back.select("shard", "old_shard", "block", "pos", *columns)
    counts = back.groupBy("shard", "old_shard", "block").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("shard").orderBy("old_shard", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "old_shard", "block", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "old_shard", "block").orderBy("pos")
    return (light.withColumn("nth", F.row_number().over(inside) - 1)
            .join(offsets, ["shard", "old_shard", "block"])
            .withColumn("slot", (F.col("offset") + F.col("nth")).cast("long")).drop("block", "pos", "nth", "offset"))
