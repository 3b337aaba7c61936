"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a covering code: the product of two perfect binary Golay
codes [23,12,7], each with covering radius 3, over the low 46 of 64 bits.  A fingerprint
owns the anchor nearest to it, and is replicated to every anchor whose distance in the
two blocks exceeds the covering radius by at most the threshold in total.  For any two
fingerprints within the threshold, the second is among the replicas at the first one's
own anchor, so comparing per anchor loses no link.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import chunks, staged, utf8
from fleetlens.llm.components import connected_components

# The Golay code's generator polynomial, length, dimension and covering radius; the shingle hash seed.
GOLAY, LENGTH, DIMENSION, RADIUS = 0b110001110101, 23, 12, 3
SEED = 42

SHINGLE, MAX_BITS = 3, 2


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles, repeats included; 0 without words."""
    import xxhash

    # bytes.lower and bytes.split know ASCII alone: A-Z, and the spaces 9 to 13 and 32
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(words) - k
    for at in range(0, n, 1 << 15):
        part = slice(at, min(n, at + (1 << 15)))
        values = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[part].tolist(), (ends[k:][part] - 1).tolist())], dtype="<u8")
        total += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle, column, keep):
    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches, column):
            values = np.array([fingerprint(t, shingle) for t in batch.column(column).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(values)],
                                             names=[*(batch.schema.names[i] for i in keep), "simhash"])
    return run


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` plus ``simhash`` (signed long); a null text is empty and gets 0.  No shuffle.

    A column of ``docs`` that is itself called simhash is left out.
    """
    kept = [c for c in docs.columns if c.lower() != "simhash"]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], utf8(f"`{text_col}`").alias("simhash"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_fingerprints(shingle, "simhash", list(range(len(kept)))), f"{fields}, simhash long")


class Covering:
    """Anchors of one block: for each syndrome the error patterns that lead to a code word."""

    def __init__(self, threshold: int):
        self.bits = np.array([self._remainder(1 << i) for i in range(LENGTH)], np.int64)
        rows: list[tuple[int, int, int]] = []
        for weight in range(RADIUS + threshold + 1):
            for at in combinations(range(LENGTH), weight):
                syndrome = pattern = 0
                for i in at:
                    syndrome ^= int(self.bits[i])
                    pattern |= 1 << i
                rows.append((max(0, weight - RADIUS), syndrome, pattern))
        table = np.array(sorted(rows), np.int64)
        self.by_excess = []
        for e in range(threshold + 1):
            part = table[table[:, 0] == e]
            cuts = np.searchsorted(part[:, 1], np.arange((1 << (LENGTH - DIMENSION)) + 1))
            self.by_excess.append((cuts[:-1], np.diff(cuts), part[:, 2]))

    @staticmethod
    def _remainder(word: int) -> int:
        for i in range(LENGTH - 1, LENGTH - DIMENSION - 1, -1):
            if word >> i & 1:
                word ^= GOLAY << (i - (LENGTH - DIMENSION))
        return word

    def syndromes(self, blocks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(blocks), np.int64)
        for i in range(LENGTH):
            out ^= ((blocks >> i) & 1) * self.bits[i]
        return out


def anchors(values: np.ndarray, covering: Covering, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor) for every anchor within radius plus ``threshold``."""
    blocks = [((values >> np.uint64(s)) & np.uint64((1 << LENGTH) - 1)).astype(np.int64) for s in (0, LENGTH)]
    syndromes = [covering.syndromes(b) for b in blocks]
    keep = LENGTH - DIMENSION  # a code word is known by its upper DIMENSION bits
    indexes, found = [], []
    for e0 in range(threshold + 1):
        for e1 in range(threshold + 1 - e0):
            (f0, n0, p0), (f1, n1, p1) = covering.by_excess[e0], covering.by_excess[e1]
            c0, c1 = n0[syndromes[0]], n1[syndromes[1]]
            count = c0 * c1
            index = np.repeat(np.arange(len(values)), count)
            inner = np.arange(len(index)) - np.repeat(np.cumsum(count) - count, count)
            width = c1[index]
            a0 = (blocks[0][index] ^ p0[f0[syndromes[0][index]] + inner // width]) >> keep
            a1 = (blocks[1][index] ^ p1[f1[syndromes[1][index]] + inner % width]) >> keep
            indexes.append(index)
            found.append(a0 << DIMENSION | a1)
    return np.concatenate(indexes), np.concatenate(found)


def _anchors(threshold):
    def run(batches):
        import pyarrow as pa

        covering = Covering(threshold)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                values = batch.column("simhash").slice(at, 2048).to_numpy(zero_copy_only=False).view(np.uint64)
                index, anchor = anchors(values, covering, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(values[index].view(np.int64))],
                                                 names=["anchor", "simhash"])
    return run


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct longs in ``simhash`` that differ in at most ``max_bits`` bits.

    Equal fingerprints must have been collapsed before, so a pair links two different
    ones, and a fingerprint has a bounded number of partners.  The join on the anchor is
    one that AQE can split where many fingerprints crowd around one anchor.
    """
    def within(threshold):
        return fingerprints.select("simhash").mapInArrow(_anchors(threshold), "anchor int, simhash long")

    own = within(0).select("anchor", F.col("simhash").alias("a"))
    replicas = within(max_bits).select("anchor", F.col("simhash").alias("b"))
    return (own.join(replicas.hint("shuffle_merge"), "anchor")
            .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b"))


def groups(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(simhash, component_id, kept_hash) of rows (doc_id, simhash).

    ``component_id`` is the least id reachable over links and ``kept_hash`` the least
    fingerprint of that id there.  A null id names a component only if all its ids are null.
    """
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("simhash").alias("kept_hash"))
    firsts = staged(rows.groupBy("simhash").agg(F.min(first).alias("first")), "simhash-values")
    labels = connected_components(staged(links(firsts, max_bits), "simhash-links"))
    rooted = (firsts.join(labels, firsts["simhash"] == labels["node"], "left")
              .select("simhash", "first", F.coalesce("root", F.xxhash64("simhash")).alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return (rooted.select("simhash", "root").join(least, "root")
            .select("simhash", F.col("first.doc_id").alias("component_id"), F.col("first.kept_hash").alias("kept_hash")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, a row for each input row.

    Null and empty texts have fingerprint zero, which links like any other.  Repeated rows
    and ids stay as they are; columns beyond the two named are not read.  Very long texts are
    read whole; an empty table gives no rows.  Near copies that differ in more than ``max_bits``
    bits are not linked: with 2 bits about half of the copies with a few edited words are.
    """
    rows = staged(with_fingerprint(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                                   shingle=shingle).select("doc_id", "simhash"), "simhash-rows")
    return (rows.join(groups(rows, max_bits).hint("shuffle_merge"), "simhash")
            .select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component stays.

    It is the row with the least id (null ids last), then the least fingerprint; of rows
    equal in both, one.  Columns are those of ``docs``.
    """
    rows = staged(with_fingerprint(docs, text_col, shingle), "simhash-docs")
    of = groups(rows.select(F.col(id_col).cast("long").alias("doc_id"), "simhash"), max_bits)
    kept = of.select("component_id", "kept_hash").distinct()
    same = rows[id_col].cast("long").eqNullSafe(kept["component_id"]) & (rows["simhash"] == kept["kept_hash"])
    return (rows.join(kept, same, "left_semi").dropDuplicates([id_col, "simhash"])
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
