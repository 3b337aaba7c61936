"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut at the special tokens and into pre-tokens.  The distinct pre-tokens of a
chunk lie one after the other in one array of symbols.  A round applies the lowest-rank
pair of every pre-token at all its places at once; pre-tokens that have no pair left drop
out, and the symbols that survive are counted.  No ids are made.

Merging all places of a pair at once is the same as merging one by one from the left, as
long as a merge ranks below the merges that use its result; ``Merges`` checks that.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.llm.common import chunks, free_name, utf8

#: Characters held as arrays at a time in a task; a longer text is cut where a pre-token surely starts.
CHUNK = 1 << 21
#: Pre-tokens of more bytes go by one queue of ranks instead of by rounds of their own.
LONG = 64
#: Counts that a worker remembers; beyond it the memory starts anew.
MEMO = 400_000

LIMIT = 512

SPACE, LETTER, NUMBER, OTHER = range(4)

# The contractions that the pre-token pattern takes whole.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

NO_RANK = np.int64(1 << 40)

#: A blank after something else always starts a pre-token.
SURE = re.compile(r"(?<=\S) ")


def byte_signs() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def library_classes() -> np.ndarray:
    """Class of every code point as the library's own patterns see it, so that both know the same Unicode."""
    from tokenizers import Regex, pre_tokenizers

    points = np.array([*range(0xD800), *range(0xE000, 0x110000)])
    text = "".join(map(chr, points.tolist()))
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        inside = np.ones(len(points), bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern + "+"), "removed").pre_tokenize_str(text):
            inside[a:b] = False
        classes[points[inside]] = kind
    return classes


def read_tokenizer(path: str) -> dict:
    """What counting needs of a tokenizer file: symbol of each byte, pairs with rank and result, special tokens, classes.

    All of fixed size.  A file that does more than byte-level pair merging raises ``ValueError``.
    """
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, before = told["model"], told["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
             and before.get("use_regex", True) and not told["normalizer"]
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
    special = [t["content"] for t in told["added_tokens"]]
    if not plain or any(t.get(k) for t in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("only byte-level pair merging without prefixes, suffixes and dropout is counted")
    vocab = model["vocab"]
    pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    return {"bytes": np.array([vocab[s] for s in byte_signs()], np.int64),
            "left": np.array([vocab[a] for a, _ in pairs], np.int64), "right": np.array([vocab[b] for _, b in pairs], np.int64),
            "made": np.array([vocab[a + b] for a, b in pairs], np.int64), "special": special, "classes": library_classes()}


class Merges:
    """Ranks of the pairs, and the merging of many byte strings at a time."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray, byte_symbols: np.ndarray):
        self.made, self.byte_symbols = made, byte_symbols
        ranks = np.arange(len(made))
        latest = np.full(int(max(made.max(initial=0), left.max(initial=0), right.max(initial=0), byte_symbols.max())) + 1, -1)
        np.maximum.at(latest, made, ranks)
        if (latest[left] >= ranks).any() or (latest[right] >= ranks).any():
            raise ValueError("a merge ranks above the merge that makes one of its parts")
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], ranks[order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbours; ``NO_RANK`` if they don't merge."""
        keys = left << 32 | right
        if not len(self.keys):
            return np.full(len(keys), NO_RANK)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_of[at], NO_RANK)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Number of symbols that each of the strings is merged to."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        out = np.empty(len(pieces), np.int64)
        for chosen, merge in ((sizes <= LONG, self._by_rounds), (sizes > LONG, self._by_queue)):
            at = np.flatnonzero(chosen)
            if len(at):
                symbols = self.byte_symbols[np.frombuffer(b"".join([pieces[i] for i in at.tolist()]), np.uint8)]
                out[at] = merge(symbols, sizes[at])
        return out

    def _pair_ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        rank = np.full(len(symbols), NO_RANK)
        inner = owner[1:] == owner[:-1]
        rank[:-1][inner] = self.ranks(symbols[:-1][inner], symbols[1:][inner])
        return rank

    def _by_rounds(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rounds in which every string applies its own lowest-rank pair."""
        counts = sizes.copy()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rank = self._pair_ranks(symbols, owner)
        while len(symbols):
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            length = np.diff(np.concatenate((first, [len(symbols)])))
            low = np.repeat(np.minimum.reduceat(rank, first), length)
            live = low < NO_RANK
            if not live.all():  # strings without a pair are done
                symbols, owner, rank, low = symbols[live], owner[live], rank[live], low[live]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == low)
            at = at[every_second(np.diff(at) == 1)]
            symbols[at] = self.made[rank[at]]
            counts -= np.bincount(owner[at], minlength=len(counts))
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            now = place[at]
            before = now[now > 0] - 1
            changed = np.concatenate((now, before[owner[before] == owner[before + 1]]))
            ends = (changed + 1 >= len(symbols))
            rank[changed[ends]] = NO_RANK
            changed = changed[~ends]
            same = owner[changed] == owner[changed + 1]
            rank[changed[~same]] = NO_RANK
            changed = changed[same]
            rank[changed] = self.ranks(symbols[changed], symbols[changed + 1])
        return counts

    def _by_queue(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same for long strings: ranks in rising order, each applied in all strings at all its places.

        The work is in the places a rank has, not in rounds over whole strings.
        """
        n = len(symbols)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.append(self._pair_ranks(symbols, owner), NO_RANK)
        symbols, owner = np.append(symbols, -1), np.append(owner, -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        alive = np.ones(n + 1, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def add(places: np.ndarray) -> None:
            places = places[rank[places] < NO_RANK]
            places = places[np.argsort(rank[places], kind="stable")]
            values, starts = np.unique(rank[places], return_index=True)
            for r, group in zip(values.tolist(), np.split(places, starts[1:])):
                if r not in waiting:
                    heapq.heappush(queue, r)
                waiting.setdefault(r, []).append(group)

        add(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            at = at[every_second(after[at[:-1]] == at[1:])]
            gone = after[at]
            symbols[at] = self.made[r]
            alive[gone], rank[gone] = False, NO_RANK
            after[at] = after[gone]
            before[after[at]] = at
            left = before[at]
            left = left[left >= 0]
            left = left[owner[left] == owner[after[left]]]
            changed = np.unique(np.concatenate((at, left)))
            right = after[changed]
            rank[changed] = np.where(owner[right] == owner[changed], self.ranks(symbols[changed], np.maximum(symbols[right], 0)), NO_RANK)
            add(changed)
        return np.bincount(owner[:-1][alive[:-1]], minlength=len(sizes))


def every_second(touches: np.ndarray) -> np.ndarray:
    """Which places to take when each may touch the next (equal symbols in a row): every second of a run, from the left."""
    run = np.cumsum(np.concatenate(([0], ~touches)))
    return (np.arange(len(run)) - np.searchsorted(run, run)) % 2 == 0


class Counter:
    """Counts tokens of texts; lives in a task and remembers the counts of short pre-tokens."""

    def __init__(self, told: dict):
        self.merges = Merges(told["left"], told["right"], told["made"], told["bytes"])
        self.classes = told["classes"]
        special = sorted(told["special"], key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.memo: dict[bytes, int] = {}

    def starts(self, points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Where the pre-tokens of joined stretches start; ``firsts`` are the stretches' own starts."""
        n = len(points)
        kind = self.classes[points]
        edge = np.zeros(n + 1, bool)  # a stretch starts here
        edge[firsts], edge[n] = True, True
        start = edge[:-1].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # of white space before something else, the last sign stands apart; a blank joins what follows
        follows = np.flatnonzero(start & ~edge[:-1] & (kind != SPACE))
        follows = follows[kind[follows - 1] == SPACE]
        start[follows - 1] = True
        start[follows[points[follows - 1] == 0x20]] = False
        quotes = np.flatnonzero(start & (points == 0x27))
        for letters in CONTRACTIONS:
            at = quotes
            for k, letter in enumerate(letters, 1):
                at = at[at + k < n]
                at = at[~edge[at + k]]
                at = at[points[at + k] == ord(letter)]
            start[at + 1] = False
            rest = at + 1 + len(letters)
            start[rest[rest < n]] = True
        return start

    def stretches(self, text: str) -> tuple[list[str], int]:
        """The text between special tokens, long stretches in parts, and the number of special tokens."""
        special = 0
        if self.special:
            parts, last = [], 0
            for m in self.special.finditer(text):
                parts.append(text[last:m.start()])
                last, special = m.end(), special + 1
            parts.append(text[last:])
        else:
            parts = [text]
        out = []
        for part in parts:
            at = 0
            while len(part) - at > CHUNK:
                cut = SURE.search(part, at + CHUNK)
                if not cut:
                    break
                out.append(part[at:cut.start()])
                at = cut.start()
            out.append(part[at:])
        return [p for p in out if p], special

    def piece_counts(self, pieces: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        found = np.array([memo.get(p, 0) for p in pieces], np.int64)
        new = np.flatnonzero(found == 0)
        if len(new):
            fresh = [pieces[i] for i in new.tolist()]
            found[new] = self.merges.counts(fresh)
            memo.update((p, c) for p, c in zip(fresh, found[new].tolist()) if len(p) <= LONG)
        return found

    def joined_counts(self, parts: list[str]) -> np.ndarray:
        """Number of tokens of each non-empty stretch."""
        import pyarrow as pa

        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(p) for p in parts])
        at = np.flatnonzero(self.starts(points, ends - [len(p) for p in parts]))
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
        offsets = np.concatenate((byte_at[at], byte_at[-1:]))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())])
        coded = pieces.dictionary_encode()
        total = np.concatenate(([0], np.cumsum(self.piece_counts(coded.dictionary.to_pylist())[coded.indices.to_numpy()])))
        return np.diff(total[np.concatenate(([0], np.searchsorted(at, ends)))])

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts: list[str] = []
        owner: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            found, out[i] = self.stretches(text)
            for part in found:
                if held and held + len(part) > CHUNK:
                    np.add.at(out, owner, self.joined_counts(parts))
                    parts, owner, held = [], [], 0
                parts.append(part)
                owner.append(i)
                held += len(part)
        if parts:
            np.add.at(out, owner, self.joined_counts(parts))
        return out


def shared_tokenizer(spark: SparkSession, path: str):
    """The tables of a tokenizer file as a broadcast; their size is that of the vocabulary and of Unicode."""
    return spark.sparkContext.broadcast(read_tokenizer(path))


def _count(shared, column):
    def run(batches):
        import pyarrow as pa

        counter = None
        for batch in chunks(batches, column, CHUNK):
            counter = counter or Counter(shared.value)
            found = counter.count(batch.column(column).to_pylist())
            names = [n for n in batch.schema.names if n != column]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(found, pa.int64())],
                                             names=[*names, "n_tokens"])
    return run


def count(docs: DataFrame, tokenizer, text_col: str = "text", keep: tuple[str, ...] | None = None, limit: int = LIMIT) -> DataFrame:
    """``keep`` (default: all columns) plus ``n_bytes``, ``n_tokens`` and ``over_limit`` of each whole text.

    One pass, no shuffle, so no key is hot.  A special token's string in a text is one token;
    none is added.  A null text is empty and has no tokens; repeated rows are counted each; an
    empty table gives no rows.  A very long text is held as arrays a part at a time.  Kept
    columns called like the new ones are left out.
    """
    new = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    source = free_name(docs, "count_text")
    text = utf8(f"`{text_col}`")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.octet_length(text).cast("long").alias("n_bytes"), text.alias(source))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    counted = rows.mapInArrow(_count(tokenizer, source), f"{fields}, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
