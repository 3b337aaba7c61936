"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

An alignment of similarity 0.8 or more has at most half as many unmatched words as matched
ones, so by pigeonhole three matched words in a row have at most one unmatched word among
them, and M / 2 - 2 such triples are in it.  Seeds are all those triples of every item, common
ones too; a document with enough of an item's seeds is aligned with it as a whole, which
scores copies that were edited or paraphrased.  Short items have pairs or words as seeds.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import chunks, staged, utf8

#: The least similarity of an alignment that counts as a copy.
SIMILARITY = 0.8
#: Items of fewer words may have no three matched words in a row with at most one unmatched among them.
TRIPLES_FROM = 7
#: Bits of the filter that lets a document's n-grams through to the exact join: its size is fixed.
FILTER_BITS = 1 << 24
#: Cells of the largest table of an alignment.
TABLE_CELLS = 1 << 22
MATCH, MISMATCH, GAP = 2, -1, -1
MULTIPLIER = 0x9E3779B97F4A7C15
#: Marks seeds that leave out a word of the item; they are for words in a row of the document.
LEFT_OUT = np.uint64(0x5851F42D4C957F2D)

WORD = re.compile(r"[^\W_]+")


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, number of words per text)."""
    import pyarrow as pa
    import xxhash

    found = [WORD.findall(t.lower()) for t in texts]
    counts = np.array([len(w) for w in found], np.int64)
    coded = pa.array([w for words in found for w in words], pa.string()).dictionary_encode()
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(w.encode()) for w in coded.dictionary.to_pylist()], np.uint64)
    return (values[coded.indices.to_numpy()] if len(values) else np.zeros(0, np.uint64)), counts


def gram_hashes(words: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """Hash of the words ``steps`` on from each position; the last positions have none."""
    n = max(0, len(words) - steps[-1])
    total = np.full(n, len(steps), np.uint64)
    for k in steps:
        total = total * np.uint64(MULTIPLIER) + words[k:k + n]
    return total ^ (total >> np.uint64(29))


def item_seeds(words: np.ndarray) -> np.ndarray:
    if len(words) < 2:
        return words
    row, gapped = ((0, 1, 2), ((0, 1, 3), (0, 2, 3))) if len(words) >= TRIPLES_FROM else ((0, 1), ((0, 2),) if len(words) < 4 else ())
    return np.unique(np.concatenate([gram_hashes(words, row), *(gram_hashes(words, g) ^ LEFT_OUT for g in gapped)]))


def least_hits(n: int, similarity: float = SIMILARITY) -> int:
    """Positions of a document with a seed that any alignment with an item of n words has, so many at least."""
    if n < TRIPLES_FROM:
        return 1
    matched = np.ceil(n * similarity / (2 - similarity) - 1e-9)
    return max(1, int(np.ceil(matched * (1 - 2 * (1 - similarity) / similarity) - 1e-9)) - 2)


def doc_seeds(words: np.ndarray, short: bool):
    """Hashes by position, one array for each kind of seed."""
    for row, gapped in [((0, 1, 2), ((0, 1, 3), (0, 2, 3)))] + [((0, 1), ((0, 2),))] * short:
        grams = gram_hashes(words, row)
        yield grams
        yield grams ^ LEFT_OUT
        for g in gapped:
            yield gram_hashes(words, g)
    if short:
        yield words


def slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(20)).astype(np.int64) & (FILTER_BITS - 1)


def local_alignment(item: np.ndarray, doc: np.ndarray) -> tuple[int, int, int, int]:
    """(score, matched words, start, end) of the best local alignment of an item in a document.

    A short item's alignment is read back from a table; a long one carries where it starts and
    how many words it matched from row to row, so memory is that of the document's words.  Both
    give the same.
    """
    best, stop = _rows(item, doc)
    if not best:
        return 0, 0, 0, 0
    # gaps cost a point each, so the alignment reaches back at most three times the item
    first = max(0, stop - 3 * len(item))
    part = doc[first:stop]
    if (len(item) + 1) * (len(part) + 1) > TABLE_CELLS:
        matched, start = _traced(item, part)
        return best, matched, first + start, stop
    table = np.zeros((len(item) + 1, len(part) + 1), np.int32)
    _rows(item, part, table)
    j = len(part)
    i = int(np.argmax(table[:, j]))
    matched = 0
    while table[i, j] > 0:
        here, same = table[i, j], item[i - 1] == part[j - 1]
        if here == table[i - 1, j - 1] + (MATCH if same else MISMATCH):
            matched, i, j = matched + int(same), i - 1, j - 1
        elif here == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, matched, first + j, stop


def _rows(item, doc, table=None) -> tuple[int, int]:
    """Best score and the document position after it; fills ``table`` if given."""
    steps = np.arange(len(doc), dtype=np.int32) * -GAP
    above = np.zeros(len(doc) + 1, np.int32)
    best, stop = 0, 0
    for i, word in enumerate(item, 1):
        row = np.maximum(above[:-1] + np.where(doc == word, MATCH, MISMATCH), above[1:] + GAP)
        row = np.maximum.accumulate(np.maximum(row, 0) + steps) - steps
        above = np.concatenate((np.zeros(1, np.int32), row.astype(np.int32)))
        if table is not None:
            table[i] = above
        top = int(above.max())
        if top > best:
            best, stop = top, int(np.argmax(above))
    return best, stop


def _traced(item: np.ndarray, doc: np.ndarray) -> tuple[int, int]:
    """(matched words, start) of the best alignment that ends with the document; pairs of words before gaps, gaps in it before its own."""
    n = len(doc)
    at = np.arange(n + 1, dtype=np.int32)
    steps = at[:n] * -GAP
    above, start, matched = np.zeros(n + 1, np.int32), at.copy(), np.zeros(n + 1, np.int32)
    top, found = 0, (0, n)
    for word in item:
        same = doc == word
        paired, skipped = above[:-1] + np.where(same, MATCH, MISMATCH), above[1:] + GAP
        pair = paired >= skipped
        own = np.where(pair, paired, skipped)
        fresh = own <= 0
        own_start = np.where(fresh, at[1:], np.where(pair, start[:-1], start[1:]))
        own_matched = np.where(fresh, 0, np.where(pair, matched[:-1] + same, matched[1:]))
        lifted = np.where(fresh, 0, own) + steps
        reach = np.maximum.accumulate(lifted)
        origin = np.maximum.accumulate(np.where(lifted == reach, at[:n], 0))  # where a gap of the document's words began
        above[1:], start[1:], matched[1:] = reach - steps, own_start[origin], own_matched[origin]
        if above[n] > top:
            top, found = int(above[n]), (int(matched[n]), int(start[n]))
    return found


def _item_rows(similarity):
    def run(batches):
        import pyarrow as pa

        longs = pa.list_(pa.int64())
        for batch in chunks(batches):
            words, counts = word_hashes(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            rows = [words[a:b] for a, b in zip(ends - counts, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([r.view(np.int64).tolist() for r in rows], longs),
                 pa.array([item_seeds(r).view(np.int64).tolist() for r in rows], longs),
                 pa.array([least_hits(len(r), similarity) for r in rows], pa.int64())], names=["item_id", "item", "seeds", "least"])
    return run


def _hits(passed, least, short):
    """Seeds that pass the filter, with their positions, of documents that have enough."""
    def run(batches):
        import pyarrow as pa

        bits = np.unpackbits(passed.value, bitorder="little")
        for batch in chunks(batches):
            words, counts = word_hashes(batch.column("text").to_pylist())
            at, seeds = [], []
            for grams in doc_seeds(words, short):
                inside = np.flatnonzero(bits[slot(grams)])
                at.append(inside)
                seeds.append(grams[inside])
            # a gram that runs into the next text only adds a candidate
            at, seeds = np.concatenate(at), np.concatenate(seeds)
            rows = np.searchsorted(np.cumsum(counts), at, "right")
            places = np.unique(at)
            enough = np.bincount(np.searchsorted(np.cumsum(counts), places, "right"), minlength=len(counts)) >= least
            kept = enough[rows] if len(rows) else np.zeros(0, bool)
            if kept.any():
                take = pa.array(rows[kept])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(take) for c in ("doc_id", "text_hash")]
                    + [pa.array(at[kept], pa.int64()), pa.array(seeds[kept].view(np.int64))], names=["doc_id", "text_hash", "at", "seed"])
    return run


def _words(passed):
    """Words of the documents whose text hash passes the filter."""
    def run(batches):
        import pyarrow as pa

        bits = np.unpackbits(passed.value, bitorder="little")
        for batch in chunks(batches):
            inside = np.flatnonzero(bits[slot(batch.column("text_hash").to_numpy().view(np.uint64))])
            if len(inside):
                part = batch.take(pa.array(inside))
                words, counts = word_hashes(part.column("text").to_pylist())
                ends = np.cumsum(counts)
                own = [words[a:b].view(np.int64).tolist() for a, b in zip(ends - counts, ends)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(own, pa.list_(pa.int64()))],
                                                 names=["doc_id", "text_hash", "words"])
    return run


def _aligned(batches):
    import pyarrow as pa

    for batch in batches:
        found = []
        for item, doc in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist()):
            score, matched, start, end = local_alignment(np.array(item, np.int64), np.array(doc, np.int64))
            found.append((score, 2 * matched / (len(item) + end - start) if matched else 0.0, start, end))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "text_hash", "item_id")]
            + [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
            names=["doc_id", "text_hash", "item_id", "score", "similarity", "start_word", "end_word"])


def _filter(seeds: DataFrame) -> np.ndarray:
    """The slots of all seeds as packed bits; at most FILTER_BITS / 32 numbers reach the driver."""
    words = (seeds.selectExpr(f"shiftright(seed, 20) & {FILTER_BITS - 1} AS at")
             .selectExpr("CAST(at DIV 32 AS INT) AS w", "shiftleft(1L, CAST(at % 32 AS INT)) AS b"))
    out = np.zeros(FILTER_BITS // 32, "<u4")
    for w, bits in words.groupBy("w").agg(F.bit_or("b").alias("bits")).collect():
        out[w] = bits
    return out.view(np.uint8)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text",
                 similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, item_id, score, similarity, start_word, end_word) of the copies found.

    A document is a distinct pair of id and text, so repeated rows count once; null ids
    stay null.  Similarity is twice the matched words over the words of the item and of
    the passage aligned with it.  Null and empty texts match nothing; of items with one id and
    several texts, each is aligned and the best counts.  Without documents or without items
    nothing is found.  Very long documents and items are aligned whole, a row of the document's
    words in memory at a time; other columns are not read.

    One pass over the texts keeps only the seeds that pass a filter of fixed size, with no text; the
    exact join on seeds and a count per document and item follow.  A second pass takes the words
    of the documents found, then joins on the two ids, all of which AQE can split where one
    item sits in a third of all documents.
    """
    context = docs.sparkSession.sparkContext
    tests = staged(items.select(F.col(item_col).cast("long").alias("item_id"), utf8(item_text_col).alias("text"))
                   .mapInArrow(_item_rows(similarity), "item_id long, item array<long>, seeds array<long>, least long")
                   .where(F.size("item") > 0).withColumn("nth", F.monotonically_increasing_id()), "decontam-items")
    seeds = staged(tests.select("nth", "least", F.explode("seeds").alias("seed")), "decontam-seeds")
    least, shortest = tests.agg(F.min("least"), F.min(F.size("item"))).first()
    passed = context.broadcast(_filter(seeds))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(utf8(text_col)).alias("text_hash"),
                       utf8(text_col).alias("text"))
    hits = rows.mapInArrow(_hits(passed, least or 1, (shortest or 0) < TRIPLES_FROM), "doc_id long, text_hash long, at long, seed long")
    counted = (hits.join(seeds.hint("shuffle_merge"), "seed").select("doc_id", "text_hash", "nth", "least", "at"))
    pairs = staged(counted.groupBy("doc_id", "text_hash", "nth").agg(F.max("least").alias("least"), F.collect_set("at").alias("places"))
                   .where("size(places) >= least").select("doc_id", "text_hash", "nth"), "decontam-pairs")
    found = context.broadcast(_filter(pairs.select(F.col("text_hash").alias("seed"))))
    texts = staged(rows.mapInArrow(_words(found), "doc_id long, text_hash long, words array<long>")
                   .groupBy("doc_id", "text_hash").agg(F.max("words").alias("words")), "decontam-words")
    same = pairs["doc_id"].eqNullSafe(texts["doc_id"]) & (pairs["text_hash"] == texts["text_hash"])
    both = (pairs.join(texts.hint("shuffle_merge"), same).select(pairs["doc_id"], pairs["text_hash"], "nth", "words")
            .join(tests.select("nth", "item_id", "item"), "nth"))
    found = (both.select("doc_id", "text_hash", "item_id", "item", "words")
             .mapInArrow(_aligned, "doc_id long, text_hash long, item_id long, score long, similarity double, start_word long, end_word long")
             .where(F.col("similarity") >= similarity))
    best = F.max(F.struct("similarity", "score", -F.col("start_word"), "start_word", "end_word"))
    return (found.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best"))
            .select("doc_id", "text_hash", "item_id", "best.score", "best.similarity", "best.start_word", "best.end_word"))


def without_copies(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no copy of an item is found, with the columns of ``docs``."""
    bad = staged(contaminated(docs, items, id_col, text_col, **options).select("doc_id", "text_hash").distinct(), "decontam-bad")
    inner = docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    same = (F.col(at[id_col.lower()]).cast("long").eqNullSafe(F.col("doc_id"))
            & (F.xxhash64(utf8(at[text_col.lower()])) == F.col("text_hash")))
    return inner.join(bad, same, "left_anti").select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
