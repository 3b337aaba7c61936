"""Connected components of an edge table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edges (two long columns); one root per component.

    Each round every node hooks to its least neighbour, two pointer jumps shorten the
    chains, and edges inside a group vanish.  Nodes are compared by a one-to-one hash,
    so an unlucky numbering does not make long chains.  Work per round is joins and a
    partial minimum on keys; no neighbourhood is ever gathered, and each round is a
    written table, so a lost executor repeats at most one round.  Self-loops, repeated
    edges and edges with a null end are ignored; an empty table has no components.
    """
    hi, lo = F.xxhash64(F.col(a)), F.xxhash64(F.col(b))
    nodes = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")))
    work = staged(nodes.select(F.greatest(F.xxhash64("a"), F.xxhash64("b")).alias("hi"),
                               F.least(F.xxhash64("a"), F.xxhash64("b")).alias("lo")).distinct(), "cc-edges")
    labels = (edges.select(F.col(a).alias("node"), hi.alias("root")).union(edges.select(F.col(b), lo))
              .where("node IS NOT NULL").distinct())
    while not work.isEmpty():
        hook = work.groupBy("hi").agg(F.min("lo").alias("to"))
        for _ in range(2):
            further = hook.select(F.col("hi").alias("to"), F.col("to").alias("next"))
            hook = hook.join(further, "to", "left").select("hi", F.coalesce("next", "to").alias("to"))
        hook = staged(hook, "cc-hooks")
        by_hi = hook.select("hi", F.col("to").alias("new_hi"))
        by_lo = hook.select(F.col("hi").alias("lo"), F.col("to").alias("new_lo"))
        moved = (work.join(by_hi, "hi").join(by_lo, "lo", "left")
                 .select(F.col("new_hi").alias("x"), F.coalesce("new_lo", "lo").alias("y")).where("x <> y"))
        work = staged(moved.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct(), "cc-edges")
        labels = staged(labels.join(hook.select(F.col("hi").alias("root"), "to"), "root", "left")
                        .select("node", F.coalesce("to", "root").alias("root")), "cc-labels")
    return labels
