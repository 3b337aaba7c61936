"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds
cut its score into grades: P(grade <= k) = sigmoid(threshold_k - score).  The model gives
the expected grade and the tail probability of the best grade, by which rows are selected.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.llm.common import chunks, free_name, staged, utf8

#: Size of the hashed feature space.
SPACE = 1 << 18
#: Most labelled rows that the model is fitted on, those with the least hash of their id.
FIT_ROWS = 16_384
#: Screening: pseudo-count of the log-odds and its least size for a feature that is used.
PSEUDO, LEAST_ODDS = 10.0, 1.0
RIDGE = 3.0
#: Least probability of the best grade for a row that is kept.
KEEP = 0.85
MEMO = 400_000
GRADES = 3  # 0 poor, 1 sound but toxic, 2 good


def _hashed(feature: str) -> int:
    return zlib.crc32(feature.encode()) % SPACE


def shape(word: str) -> str:
    """Case class of a word between its runs of other signs: ``Abc.%%`` is ``T.%``."""
    head, core, tail = re.match(r"(\W*)(.*?)(\W*)$", word, re.S).groups()
    case = ("" if not core else "A" if core.isupper() and len(core) > 1 else "a" if core.islower()
            else "T" if core.istitle() else "m")
    return re.sub(r"(.)\1+", r"\1", head) + case + re.sub(r"(.)\1+", r"\1", tail)


def word_features(word: str) -> set[int]:
    """Hashed features of one word: itself, its character 4-grams, its shape."""
    core = word.strip(".,;:!?\"'()").lower()
    marked = f"<{core}>"
    found = {_hashed(marked[i:i + 4]) for i in range(max(1, len(marked) - 3))}
    return found | {_hashed("w" + core), _hashed("s" + shape(word))}


def features(text: str, memo: dict, used=None) -> set[int]:
    """Hashed features that occur in a text; with ``used`` only those it marks."""
    words = text.split()
    found: set[int] = set()
    for word in set(words):
        ids = memo.get(word)
        if ids is None:
            ids = word_features(word)
            ids = memo[word] = tuple(ids) if used is None else tuple(i for i in ids if used[i])
        if ids:
            found.update(ids)
    again = sum(a == b for a, b in zip(words, words[1:]))
    found.add(_hashed(f"r{10 * again // max(1, len(words))}"))
    if len(memo) > MEMO:
        memo.clear()
    return found


@dataclass
class Ordinal:
    """Feature weights and ordered thresholds; without thresholds every row has the best grade."""

    weights: np.ndarray
    thresholds: np.ndarray

    def grades(self, score: float) -> tuple[float, float]:
        """(expected grade, probability of the best grade)."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds - score, -500, 500)))
        return (float(above.sum()), float(above[-1])) if len(above) else (GRADES - 1.0, 1.0)


def _loss(p, index, column, value, grade, n, width):
    """Mean negative log-likelihood with ridge and its gradient; p: weights, first threshold, log gaps."""
    w, cuts = p[:width], p[width] + np.concatenate(([0], np.cumsum(np.exp(p[width + 1:]))))
    score = np.bincount(index, value * w[column], n)
    below = 1 / (1 + np.exp(np.clip(score[:, None] - cuts[None, :], -500, 500)))
    slope = below * (1 - below)
    zero, one = np.zeros((n, 1)), np.ones((n, 1))
    cdf, pdf = np.hstack((zero, below, one)), np.hstack((zero, slope, zero))
    at = np.arange(n)
    chance = np.maximum(cdf[at, grade + 1] - cdf[at, grade], 1e-12)
    loss = -np.log(chance).sum() / n + RIDGE * (w @ w) / (2 * n)
    by_score = (pdf[at, grade + 1] - pdf[at, grade]) / chance / n
    by_cut = np.zeros((n, len(cuts) + 2))
    by_cut[at, grade + 1] -= pdf[at, grade + 1] / chance / n
    by_cut[at, grade] += pdf[at, grade] / chance / n
    cut_sum = by_cut.sum(axis=0)[1:-1]
    tails = np.cumsum(cut_sum[::-1])[::-1]
    return loss, np.concatenate((np.bincount(column, value * by_score[index], width) + RIDGE * w / n,
                                 tails[:1], tails[1:] * np.exp(p[width + 1:])))


def minimise(of, p, steps: int = 60, memory: int = 8):
    """Limited-memory quasi-Newton descent with backtracking."""
    loss, slope = of(p)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, scales = slope.copy(), []
        for s, y in reversed(moves):
            scales.append((s @ q) / (s @ y))
            q -= scales[-1] * y
        q *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1, np.linalg.norm(q))
        for (s, y), a in zip(moves, reversed(scales)):
            q += s * (a - (y @ q) / (s @ y))
        step = 1.0
        while True:
            new_loss, new_slope = of(p - step * q)
            if new_loss <= loss - 1e-4 * step * (slope @ q) or step < 1e-8:
                break
            step /= 2
        move, change = -step * q, new_slope - slope
        done = loss - new_loss < 1e-7
        p, loss, slope = p + move, new_loss, new_slope
        if done:
            break
        if move @ change > 1e-12:
            moves = [*moves[-memory + 1:], (move, change)]
    return p


def fit_rows(grades: np.ndarray, rows: list[np.ndarray], odds: np.ndarray) -> Ordinal:
    """The model of labelled rows given as the used features that each has."""
    if len(np.unique(grades)) < 2:
        return Ordinal(np.zeros(SPACE), np.zeros(0))
    used = np.flatnonzero(odds)
    place = np.zeros(SPACE, np.int64)
    place[used] = np.arange(len(used))
    index = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = place[np.concatenate(rows)] if len(index) else np.zeros(0, np.int64)
    value = odds[used][column]
    start = np.concatenate((np.zeros(len(used)), [-1.0], np.zeros(GRADES - 2)))
    p = minimise(lambda x: _loss(x, index, column, value, grades, len(rows), len(used)), start)
    weights = np.zeros(SPACE)
    weights[used] = p[:len(used)] * odds[used]
    return Ordinal(weights, p[len(used)] + np.concatenate(([0], np.cumsum(np.exp(p[len(used) + 1:])))))


def _featurise(batches):
    import pyarrow as pa

    memo: dict = {}
    for batch in chunks(batches):
        found = [sorted(features(t, memo)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("grade"), pa.array(found, pa.list_(pa.int32()))],
                                         names=["key", "grade", "features"])


def _tally(batches):
    """Per task: rows with each feature, all and of the best grade; feature -1 counts the rows."""
    import pyarrow as pa

    every, best = np.zeros(SPACE + 1, np.int64), np.zeros(SPACE + 1, np.int64)
    for batch in batches:
        lists = batch.column("features")
        top = batch.column("grade").to_numpy(zero_copy_only=False) == GRADES - 1
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        of_top = np.repeat(top, lists.value_lengths().to_numpy(zero_copy_only=False))
        every[:-1] += np.bincount(ids, minlength=SPACE)
        best[:-1] += np.bincount(ids[of_top], minlength=SPACE)
        every[-1] += len(top)
        best[-1] += top.sum()
    at = np.flatnonzero(every)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(at == SPACE, -1, at), pa.int32()), pa.array(every[at]), pa.array(best[at])],
                                     names=["feature", "n", "best"])


def _screen(used):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [[i for i in ids if used.value[i]] for ids in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("grade"), pa.array(rows, pa.list_(pa.int32()))],
                                             names=["key", "grade", "features"])
    return run


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, grade): 0 for poor quality, 1 for toxic, 2 for neither; the least of repeated labels.

    Labels with a null id, quality or toxicity are left out.
    """
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
            .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(grade).alias("grade")))


def fit(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = FIT_ROWS) -> Ordinal:
    """Fit on at most ``max_rows`` labelled rows, the ones with the least hash of their id.

    Features are counted by Spark tasks; the driver gets the counts (fixed space) and the
    screened features of the sample, which ``max_rows`` bounds.  Of repeated ids one row,
    the one with the least text hash, is used.
    """
    spark = docs.sparkSession
    sample = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    once = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    labelled = (rows.join(F.broadcast(sample), "doc_id").withColumn("nth", F.row_number().over(once)).where("nth = 1")
                .select(F.col("doc_id").alias("key"), "text", "grade"))
    found = staged(labelled.mapInArrow(_featurise, "key long, grade int, features array<int>"), "quality-features")
    counts = (found.mapInArrow(_tally, "feature int, n long, best long")
              .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("best").alias("best")).collect())
    every, best = np.zeros(SPACE + 1), np.zeros(SPACE + 1)
    for feature, n, top in counts:
        every[feature], best[feature] = n, top  # -1 is the last place
    odds = np.zeros(SPACE)
    if 0 < best[-1] < every[-1]:
        share = best[-1] / every[-1]
        odds = np.log((best[:-1] + PSEUDO * share) / (every[:-1] - best[:-1] + PSEUDO * (1 - share)) * (1 - share) / share)
        odds[np.abs(odds) < LEAST_ODDS] = 0
    used = spark.sparkContext.broadcast((odds != 0).tolist())
    sampled = sorted(found.mapInArrow(_screen(used), "key long, grade int, features array<int>").collect())
    return fit_rows(np.array([r[1] for r in sampled], np.int64), [np.array(r[2], np.int64) for r in sampled], odds)


def _score(model, column):
    def run(batches):
        import pyarrow as pa

        own = model.value
        used = (own.weights != 0).tolist()
        weights = own.weights.tolist()
        memo: dict = {}
        for batch in chunks(batches, column):
            scored = [own.grades(sum(weights[i] for i in sorted(features(t, memo, used))))
                      for t in batch.column(column).to_pylist()]
            keep = [i for i, n in enumerate(batch.schema.names) if n != column]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array([s[0] for s in scored], pa.float64()),
                 pa.array([s[1] for s in scored], pa.float64())],
                names=[*(batch.schema.names[i] for i in keep), "expected_grade", "tail_probability"])
    return run


def score(docs: DataFrame, model: Ordinal, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``expected_grade`` and ``tail_probability`` of each whole text.

    No shuffle.  A null text is empty and is scored as such; repeated rows get equal scores;
    an empty table gives no rows; very long texts are read whole, one at a time.  Kept columns
    called like the two new ones are left out.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("expected_grade", "tail_probability")]
    source = free_name(docs, "quality_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], utf8(f"`{text_col}`").alias(source))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(shared, source), ", ".join([*fields, "expected_grade double", "tail_probability double"]))


def select_good(docs: DataFrame, model: Ordinal, text_col: str = "text", least: float = KEEP) -> DataFrame:
    """The rows whose probability of the best grade is at least ``least``, with the columns of ``docs``."""
    inner = docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    good = score(inner, model, f"c{[c.lower() for c in docs.columns].index(text_col.lower())}").where(F.col("tail_probability") >= least)
    return good.select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
