"""Line dedup by pairwise alignment of documents that share a block of lines.

A line is a line of text, cut further where a sentence ends or starts, so a passage is
found inside longer lines too.  The least runs of adjacent lines that make a block are
seeds: a document is paired with the first document that has one of its runs.  That
document holds the whole run, so no block is missed, whatever its lines' frequency, and
the pairs are linear in the runs.  Each pair is aligned by patience diff, and aligned
blocks of enough words are deleted from the later document.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import chunks, free_name, staged, utf8

#: Least words of an aligned block that is deleted.
BLOCK_WORDS = 25

#: A line ends at a line feed, at blanks after a sentence end, and at blanks before a capital.
CUT = re.compile(r"[\n \t](?:(?<=\n)|(?<=[.!?][ \t])[ \t]*|[ \t]*(?=[A-ZÀ-ÖØ-Þ]))")

MULTIPLIER = 0x9E3779B97F4A7C15

KEY = "doc_id long, text_hash long"


def cut_lines(text: str) -> list[tuple[int, int]]:
    """(start, end) of the lines; each runs up to the next one's start."""
    starts = [0, *(m.end() for m in CUT.finditer(text))]
    return list(zip(starts, [*starts[1:], len(text)], strict=True))


def line_keys(text: str) -> tuple[list[int], list[int]]:
    """Hash and word count (blanks between words, plus one) of each line; case and outer white space don't count."""
    import xxhash

    digest, hashes, words = xxhash.xxh64_intdigest, [], []
    low = text.lower()
    whole = len(low) == len(text)  # a few letters grow in lower case
    for a, b in cut_lines(text):
        line = (low[a:b] if whole else text[a:b].lower()).strip()
        hashes.append(digest(line) - (1 << 63))
        words.append(line.count(" ") + 1 if line else 0)
    return hashes, words


def least_runs(words: list[int], least: int = BLOCK_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the least runs of ``least`` words from each line on, and up to each line.

    Any run of so many words is a union of least runs inside it.
    """
    counts = np.asarray(words, np.int64)
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
    full = np.flatnonzero(counts)  # no run needs a blank line at its edge
    after = np.searchsorted(total, total[full] + least)
    before = np.searchsorted(total, total[full + 1] - least, "right") - 1
    on, back = after <= len(counts), before >= 0
    runs = np.concatenate((full[on] * (len(total)) + after[on], before[back] * len(total) + full[back] + 1))
    return np.divmod(np.unique(runs), len(total))


def seeds(hashes: list[int], words: list[int], least: int = BLOCK_WORDS) -> np.ndarray:
    """Hashes of the least runs of adjacent lines that make a block (differences of a prefix polynomial)."""
    starts, ends = least_runs(words, least)
    if not len(starts):
        return np.zeros(0, np.int64)
    power = np.full((2, len(hashes) + 1), [[MULTIPLIER], [pow(MULTIPLIER, -1, 1 << 64)]], np.uint64)
    power[:, 0] = 1
    power = np.multiply.accumulate(power, axis=1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(np.asarray(hashes, np.int64).view(np.uint64) * power[0, :-1])))
    found = (prefix[ends] - prefix[starts]) * power[1, starts]
    return np.unique(found ^ (found >> np.uint64(29))).view(np.int64)


def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, sorted by the first, that rises in the second."""
    tails: list[int] = []
    tops: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        tails[k:k + 1], tops[k:k + 1] = [b], [i]
        back[i] = tops[k - 1] if k else -1
    out, i = [], tops[-1] if tops else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences: matching ends, then lines unique in both, then the gaps between.

    Gaps are cut no deeper than twice the logarithm of the lines, so the work is linear but for
    that factor; what is left of a gap, or has no line unique in both, is not aligned.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b), 2 * len(b).bit_length())]
    while todo:
        a0, a1, b0, b1, depth = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1 or not depth:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        chosen = {h for h in in_a.keys() & in_b.keys() if in_a[h] == 1 and in_b[h] == 1}
        if not chosen:
            continue
        at_b = {b[i]: i for i in range(b0, b1) if b[i] in chosen}
        chain = _longest_rising([(i, at_b[a[i]]) for i in range(a0, a1) if a[i] in chosen])
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *chain], [*chain, (a1, b1)]):
            todo.append((i + 1, k, j + 1, m, depth - 1))
        out += chain
    return sorted(out)


class Runs:
    """All runs of lines of a document, as a suffix automaton: linear to build and to follow."""

    def __init__(self, lines: list[int]):
        self.after: list[dict[int, int]] = [{}]
        self.back, self.size = [-1], [0]
        last = 0
        for line in lines:
            new = self._state(self.size[last] + 1, {})
            at = last
            while at >= 0 and line not in self.after[at]:
                self.after[at][line] = new
                at = self.back[at]
            if at < 0:
                self.back[new] = 0
            else:
                to = self.after[at][line]
                if self.size[to] == self.size[at] + 1:
                    self.back[new] = to
                else:
                    copy = self._state(self.size[at] + 1, dict(self.after[to]))
                    self.back[copy] = self.back[to]
                    while at >= 0 and self.after[at].get(line) == to:
                        self.after[at][line] = copy
                        at = self.back[at]
                    self.back[to] = self.back[new] = copy
            last = new

    def _state(self, size: int, after: dict[int, int]) -> int:
        self.after.append(after)
        self.back.append(0)
        self.size.append(size)
        return len(self.size) - 1

    def longest(self, lines: list[int]):
        """Length of the longest run that ends at each of the lines."""
        at = length = 0
        for line in lines:
            while at and line not in self.after[at]:
                at = self.back[at]
                length = self.size[at]
            if line in self.after[at]:
                at, length = self.after[at][line], length + 1
            yield length


def _common_runs(a: list[int], b: list[int], words: list[int], least: int, gone: set[int]) -> set[int]:
    """Positions in ``b`` of all runs of ``least`` words that ``a`` has too, if ``gone`` lacks some of them."""
    common, open_words, size, unseen = set(a), False, 0, False
    for i in range(len(b) + 1):  # is there a stretch of common lines of enough words that is not gone as a whole?
        if i < len(b) and b[i] in common:
            size, unseen = size + words[i], unseen or (words[i] > 0 and i not in gone)
            continue
        open_words |= size >= least and unseen
        size, unseen = 0, False
    if not open_words:
        return set()
    before = [0]
    for n in words:
        before.append(before[-1] + n)
    out: set[int] = set()
    covered = 0
    for i, length in enumerate(Runs(a).longest(b)):
        first = i + 1 - length
        if length and before[i + 1] - before[first] >= least:
            out.update(range(max(first, covered), i + 1))  # ``first`` never falls
            covered = i + 1
    return out


def repeated_lines(a: list[int], b: list[int], words: list[int], least: int = BLOCK_WORDS) -> set[int]:
    """Positions in ``b`` (word counts ``words``) of blocks with at least ``least`` words that ``a`` has.

    The aligned blocks go first.  A block that the alignment went across (it was moved or
    repeated, or scattered lines made the longest chain) is found by its runs, so no common run
    of ``least`` words is left.  The work grows with the lines, however often they repeat.
    """
    common = set(a) & set(b)
    if sum(n for h, n in zip(b, words) if h in common) < least:
        return set()
    blocks: list[list[int]] = []
    last = (-2, -2)
    for i, j in patience(a, b):
        if blocks and (i, j) == (last[0] + 1, last[1] + 1):
            blocks[-1].append(j)
        else:
            blocks.append([j])
        last = (i, j)
    gone = {k for block in blocks if sum(words[k] for k in block) >= least for k in block}
    return gone | _common_runs(a, b, words, least, gone)


def without(text: str, gone: set[int]) -> str:
    """The text without some of its lines; what is left stays as it is but for blanks where its end went."""
    if not gone:
        return text
    lines = cut_lines(text)
    kept = "".join(text[a:b] for i, (a, b) in enumerate(lines) if i not in gone)
    return kept.rstrip() if len(lines) - 1 in gone else kept


def _lines(least):
    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches):
            rows = [line_keys(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([seeds(h, w, least) for h, w in rows], pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "hashes", "words", "seeds"])
    return run


def _align(least):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("earlier", "hashes", "words")]
            found = [sorted(repeated_lines(a, b, w, least)) for a, b, w in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(found, pa.list_(pa.int32()))],
                                             names=["doc_id", "text_hash", "gone"])
    return run


def _delete(text_at):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t if not g else without(t, set(g))
                     for t, g in zip(batch.column(text_at).to_pylist(), batch.column("gone").to_pylist())]
            names = [n for n in batch.schema.names if n != "gone"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == text_at else batch.column(n) for n in names], names=names)
    return run


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text_hash, gone): positions of the lines to delete, for documents that have some.

    A document is a distinct pair of id and text; the earlier of two has the less id,
    then the less text hash.  Null ids take no part, null and empty texts have no lines.
    """
    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    rows = source.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").where("text <> ''")
    lines = staged(rows.mapInArrow(_lines(block_words), f"{KEY}, hashes array<long>, words array<int>, seeds array<long>"), "lines")
    held = lines.select(F.explode("seeds").alias("seed"), "doc_id", "text_hash")
    lines = lines.drop("seeds")
    # most runs are in one document: bare hashes are counted first, and only shared ones go on
    shared = held.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed")
    hits = staged(held.join(shared.hint("shuffle_merge"), "seed"), "line-hits")
    doc = F.struct("doc_id", "text_hash")
    first = hits.groupBy("seed").agg(F.min(doc).alias("first"), F.max(doc).alias("last")).where("first <> last").select("seed", "first")
    later = hits.join(first.hint("shuffle_merge"), "seed").where(F.col("first") != doc)
    pairs = staged(later.select(F.col("first.doc_id").alias("a_id"), F.col("first.text_hash").alias("a_hash"), "doc_id", "text_hash")
                   .distinct(), "line-pairs")
    # only lines of paired documents go on; a repeated row gives its lines once; written tables leave the joins to AQE's skew splitting
    keys = pairs.select("doc_id", "text_hash").unionByName(pairs.select(F.col("a_id").alias("doc_id"), F.col("a_hash").alias("text_hash"))).distinct()
    paired = staged(lines.join(keys.hint("shuffle_merge"), ["doc_id", "text_hash"], "left_semi"), "line-paired")
    one = staged(paired.groupBy("doc_id", "text_hash").agg(F.max("hashes").alias("hashes"), F.max("words").alias("words")), "line-sets")
    earlier = one.select(F.col("doc_id").alias("a_id"), F.col("text_hash").alias("a_hash"), F.col("hashes").alias("earlier"))
    both = (pairs.join(earlier.hint("shuffle_merge"), ["a_id", "a_hash"]).select("doc_id", "text_hash", "earlier")
            .join(one.hint("shuffle_merge"), ["doc_id", "text_hash"]))
    gone = both.select("doc_id", "text_hash", "earlier", "hashes", "words").mapInArrow(_align(block_words), f"{KEY}, gone array<int>")
    return (gone.where(F.size("gone") > 0).groupBy("doc_id", "text_hash")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("gone")))).alias("gone")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS,
          with_digest: bool = False) -> DataFrame:
    """``docs`` with repeated blocks deleted from the later documents; every row stays.

    Columns are those of ``docs``; ``with_digest`` adds ``lines_gone``.  Rows with a null
    id, null text or nothing to delete are unchanged; repeated rows change alike.  An empty
    table stays empty.  Very long texts are read whole; their pairs are aligned in time that
    grows with their lines.  Other columns are carried, whatever their names.
    """
    found = staged(repeated(docs, id_col, text_col, block_words), "line-gone")
    inner = docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    key, text = at[id_col.lower()], at[text_col.lower()]
    joined = inner.join(found.hint("shuffle_merge"), (F.col(key).cast("long") == F.col("doc_id"))
                        & (F.xxhash64(utf8(text)) == F.col("text_hash")), "left")
    joined = joined.select(*inner.columns, F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
                           F.size(F.coalesce("gone", F.array().cast("array<int>"))).alias("lines_gone"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields if f.name != "gone")
    cleaned = joined.mapInArrow(_delete(text), schema)
    out = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return cleaned.select(*out, *([F.col("lines_gone").alias(free_name(docs, "lines_gone"))] if with_digest else []))
