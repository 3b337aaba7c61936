"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest.

Encoding splits a text into pre-tokens, resolves each distinct pre-token of a batch once,
and gathers the ids back by position.  A pre-token that is a vocabulary entry is found by
one probe of a minimal perfect hash; any other starts as a doubly linked list of bytes
whose adjacent pairs wait in a heap by rank, and the lowest rank merges first.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.llm.common import chunks, free_name, utf8

#: Characters encoded at a time in a task.
CHUNK = 1 << 21
#: Results of the heap that a worker keeps; beyond it the memory starts anew.
MEMO = 200_000

# The contractions that the pre-token pattern takes whole, and the characters of \s.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
          0x205F, 0x3000]

SPACE, LETTER, NUMBER, OTHER = range(4)


class PerfectHash:
    """Minimal perfect hash of byte strings by hash and displace: n keys, n slots, one probe."""

    def __init__(self, keys: list[bytes]):
        self.n, self.m = max(1, len(keys)), len(keys) // 3 + 1
        self.moves = np.zeros(self.m, np.int64)
        self.owner = np.full(self.n, -1, np.int64)
        h = self.hashes(keys)
        bucket = (h % np.uint64(self.m)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.m + 1))
        sizes = np.diff(cuts)
        for b in np.argsort(-sizes, kind="stable").tolist():
            members = order[cuts[b]:cuts[b + 1]]
            if len(members) < 2:
                break
            tried, block = 0, 16
            while True:
                moves = np.arange(tried, tried + block, dtype=np.uint64)
                slots = self._slots(h[members][:, None], moves[None, :])
                ranked = np.sort(slots, axis=0)
                fits = (self.owner[slots] < 0).all(axis=0) & (ranked[1:] != ranked[:-1]).all(axis=0)
                if fits.any():
                    break
                tried, block = tried + block, min(4 * block, 1 << 14)
            move = int(np.argmax(fits))
            self.moves[b] = tried + move
            self.owner[slots[:, move]] = members
        free = np.flatnonzero(self.owner < 0)
        lone = np.flatnonzero(sizes == 1)
        self.owner[free[:len(lone)]] = order[cuts[lone]]
        self.moves[lone] = -free[:len(lone)] - 1  # a lone key's bucket names its slot

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        import xxhash
        digest = xxhash.xxh64_intdigest
        return np.array([digest(k) for k in keys], np.uint64)

    def _slots(self, h: np.ndarray, moves: np.ndarray) -> np.ndarray:
        x = h + moves * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(self.n)).astype(np.int64)

    def slots_of(self, keys: list[bytes]) -> np.ndarray:
        """The index of the only key that each string can be; the caller compares."""
        h = self.hashes(keys)
        move = self.moves[(h % np.uint64(self.m)).astype(np.int64)]
        return self.owner[np.where(move < 0, -move - 1, self._slots(h, np.maximum(move, 0).astype(np.uint64)))]


class Codec:
    """Vocabulary by rank with its perfect hash, pair table and character classes (fixed size: no text in it)."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.hash = PerfectHash(tokens)
        rank = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = [rank[bytes([b])] for b in range(256)]
        #: (left id, right id) as one number -> rank of the two joined
        self.pairs = {(rank[t[:k]] << 20) | rank[t[k:]]: i for i, t in enumerate(tokens)
                      for k in range(1, len(t)) if t[:k] in rank and t[k:] in rank}
        classes = np.full(0x110000, OTHER, np.uint8)
        kinds = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
        classes[kinds == "L"], classes[kinds == "N"] = LETTER, NUMBER
        classes[SPACES] = SPACE
        self.classes = classes

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "token_array")}

    @classmethod
    def from_file(cls, path: str) -> Codec:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        return cls([t for t, _ in sorted(ranks.items(), key=lambda x: x[1])])

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no vocabulary entry."""
        n = len(piece)
        ids = [self.byte_ids[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs.get
        heap = []
        for i in range(n - 1):
            r = pairs((ids[i] << 20) | ids[i + 1])
            if r is not None:
                heap.append((r << 32) | i)
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            r, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n or pairs((ids[i] << 20) | ids[j]) != r:
                continue  # one of the two has merged since
            ids[i], ids[j] = r, -1
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                x = pairs((r << 20) | ids[k])
                if x is not None:
                    heapq.heappush(heap, (x << 32) | i)
            if h >= 0:
                x = pairs((ids[h] << 20) | r)
                if x is not None:
                    heapq.heappush(heap, (x << 32) | h)
        return [i for i in ids if i >= 0]

    def resolve(self, pieces: list[bytes]) -> list:
        """Ids (a number or a list) of distinct pre-tokens."""
        memo = self.__dict__.setdefault("memo", {})
        if len(memo) > MEMO:
            memo.clear()
        tokens, out = self.tokens, []
        for piece, slot in zip(pieces, self.hash.slots_of(pieces).tolist()):
            if tokens[slot] == piece:
                out.append([slot])
            else:
                ids = memo.get(piece)
                if ids is None:
                    ids = memo[piece] = self.merged(piece)
                out.append(ids)
        return out

    def starts(self, points: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where pre-tokens start in joined texts; firsts and ends bound the non-empty texts."""
        kind = self.classes[points]
        start = np.empty(len(points), bool)
        start[0] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        start[firsts] = True
        # the last of several spaces goes with what follows: as its prefix if it is a blank, else alone
        follows = np.flatnonzero(start[1:] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
        inside = np.ones(len(points), bool)
        inside[firsts] = False
        follows = follows[inside[follows]]
        start[follows - 1] = True
        start[follows[points[follows - 1] == 0x20]] = False
        quotes = np.flatnonzero((points == 0x27) & start)
        if len(quotes):
            limit = ends[np.searchsorted(ends, quotes, side="right")]
            for letters in CONTRACTIONS:
                hit = quotes[quotes + len(letters) < limit]
                for k, c in enumerate(letters, 1):
                    hit = hit[points[hit + k] == ord(c)]
                start[hit + 1] = False
                after = hit + 1 + len(letters)
                text_end = ends[np.searchsorted(ends, hit, side="right")]
                after = after[after < text_end]
                blank = (points[after] == 0x20)
                # a blank before a word already starts that word's pre-token; anything else starts here too
                start[after[~blank]] = True
        return start

    def encode(self, texts: list[str]):
        """(ids of all texts, number of ids per text) as arrays."""
        import pyarrow as pa

        sizes = np.array([len(t) for t in texts], np.int64)
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(sizes)
        firsts = (ends - sizes)[sizes > 0]
        start = self.starts(points, firsts, ends[sizes > 0])
        at = np.flatnonzero(start)
        width = np.ones(len(points), np.int64)
        for least in (0x80, 0x800, 0x10000):
            width += points >= least
        byte_at = np.concatenate(([0], np.cumsum(width)))
        offsets = np.concatenate((byte_at[at], byte_at[-1:])).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())])
        coded = pieces.dictionary_encode()
        found = self.resolve(coded.dictionary.to_pylist())
        length = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.int32, int(length.sum()))
        codes = coded.indices.to_numpy()
        per_piece = length[codes]
        ids = flat[np.repeat((np.cumsum(length) - length)[codes] - (np.cumsum(per_piece) - per_piece), per_piece)
                   + np.arange(per_piece.sum())]
        counts = np.concatenate(([0], np.cumsum(per_piece)))[np.searchsorted(at, ends)]
        return ids, np.diff(np.concatenate(([0], counts)))

    def decode(self, ids, lengths) -> list[bytes]:
        """The bytes of each run of ids."""
        import pyarrow as pa

        if "token_array" not in self.__dict__:
            self.token_array = pa.array(self.tokens, pa.large_binary())
        taken = self.token_array.take(pa.array(ids, pa.int32()))
        at = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
        data = taken.buffers()[2]
        whole = memoryview(data) if data is not None else memoryview(b"")
        ends = np.cumsum(lengths)
        return [bytes(whole[a:b]) for a, b in zip(at[ends - lengths].tolist(), at[ends].tolist())]


def shared_codec(spark: SparkSession, path: str):
    """The codec of a rank file as a broadcast; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(Codec.from_file(path))


def _encode(codec, column):
    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches, column, CHUNK):
            ids, counts = codec.value.encode(batch.column(column).to_pylist())
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
            arrays = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != column]
            names = [n for n in batch.schema.names if n != column]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.array(counts, pa.int64())],
                names=[*names, "token_ids", "n_tokens"])
    return run


def encode(docs: DataFrame, codec, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``token_ids`` and ``n_tokens`` of each whole text.

    No shuffle: one pass over the rows.  A null text is empty and has no ids; repeated rows
    are encoded each; very long texts are encoded whole; an empty table gives no rows.  Kept columns called like the two new ones are left out.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("token_ids", "n_tokens")]
    source = free_name(docs, "bpe_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], utf8(f"`{text_col}`").alias(source))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = f"{fields}, token_ids array<int>, n_tokens long" if fields else "token_ids array<int>, n_tokens long"
    return rows.mapInArrow(_encode(codec, source), schema)


def _decode(codec):
    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            lists = batch.column("token_ids")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            texts = codec.value.decode(ids, lengths)
            packed = ids.astype("<u4").tobytes()
            ends = np.cumsum(lengths) * 4
            digests = [hashlib.sha256(packed[a:b]).hexdigest() for a, b in zip((ends - lengths * 4).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), pa.array(digests, pa.string()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def decoded_digests(encoded: DataFrame, codec) -> DataFrame:
    """Per row of ``encode``: digest of the ids (little-endian 32 bits) and of the bytes they decode to."""
    return encoded.select("doc_id", "token_ids", "n_tokens").mapInArrow(
        _decode(codec), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
