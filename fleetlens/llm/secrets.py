"""Secret scan with corpus-wide ownership frequency.

Every text is searched for credential shapes.  The hash of each candidate value is
then aggregated over the whole corpus by distinct repositories and owners: a value
that many owners carry is a copied example, a value that few owners carry looks
live.  Live-looking generic tokens become extra spans; spans of the fixed patterns
always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import chunks, staged, utf8

# The patterns, their least lengths and the order of kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
KINDS = ["assign", "access", "hex", "live"]

#: A generic token: a whole run of at least this many credential characters with letters, digits and this entropy.
TOKEN_MIN, TOKEN_BITS = 20, 3.0
#: A value that more owners than this carry is a copied example.
MAX_OWNERS = 2

SCANNED = ("doc_id long, owner string, repo string, n_assign long, n_access long, n_hex long, base_sha256 string, "
           "base array<struct<start:long,kind:int,stop:long,value:long>>, "
           "more array<struct<start:long,kind:int,stop:long,value:long>>")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the fixed patterns, sorted; offsets are code points."""
    spans = []
    low = text.lower()
    if any(k in low for k in ("password", "passwd", "secret", "token", "api")):
        for m in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII):
            if len(m[2]) >= ASSIGN_MIN:
                spans.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m[0]) for m in re.finditer(ACCESS, text) if len(m[0]) >= ACCESS_MIN]
    # a leftmost match of HEX is a maximal run, so the least length may stand in the pattern
    spans += [(m.start(), 2, m.end(), m[0]) for m in re.finditer(r"[0-9a-f]{%d,}" % HEX_MIN, text)]
    return sorted(spans)


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def generic_spans(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """High-entropy tokens that overlap none of the sorted spans in ``taken``."""
    found = []
    at = reach = 0  # the spans that start before the token's end, and how far they reach
    for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % TOKEN_MIN, text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][2])
            at += 1
        value = m[0]
        if reach <= m.start() and re.search("[0-9]", value) and re.search("[A-Za-z]", value) and entropy(value) >= TOKEN_BITS:
            found.append((m.start(), 3, m.end(), value))
    return found


def written(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{stop}" for start, kind, stop, *_ in spans)


def _scan(batches):
    import pyarrow as pa
    import xxhash

    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64()), ("value", pa.int64())]))

    def keyed(spans):
        return [{"start": s, "kind": k, "stop": e, "value": xxhash.xxh64_intdigest(v.encode()) - (1 << 63)}
                for s, k, e, v in spans]

    for batch in chunks(batches):
        rows = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "base", "more")}
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            for i, n in enumerate(("n_assign", "n_access", "n_hex")):
                rows[n].append(sum(s[1] == i for s in base))
            rows["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
            rows["base"].append(keyed(base))
            rows["more"].append(keyed(generic_spans(text, base)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "owner", "repo")]
            + [pa.array(rows[n], pa.int64()) for n in ("n_assign", "n_access", "n_hex")]
            + [pa.array(rows["base_sha256"], pa.string()), pa.array(rows["base"], kind), pa.array(rows["more"], kind)],
            names=["doc_id", "owner", "repo", *rows])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_cols: tuple[str, ...] = ("source", "lang"), max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per input row: counts and digest of the fixed patterns, and all spans.

    A repository is a distinct combination of ``repo_cols``; a null owner or part of a
    repository counts as one value of its own.  Null texts are empty and have no spans;
    repeated rows are scanned and returned each; null ids are kept; an empty table gives no
    rows.  Columns beyond those named are not read, so clashing names do no harm.  A very
    long text takes time in proportion: spans and tokens are merged in one pass.

    Two shuffles carry candidates only (hash, owner, repository), combined before they
    move; texts never move.  The join of candidates with their frequencies leaves a
    value that a third of all rows hold to AQE's skew splitting.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"),
                       F.col(owner_col).cast("string").alias("owner"),
                       F.to_json(F.array(*[F.col(c).cast("string") for c in repo_cols])).alias("repo"))
    found = staged(rows.mapInArrow(_scan, SCANNED).withColumn("uid", F.monotonically_increasing_id()), "secrets")
    cands = (found.where((F.size("base") > 0) | (F.size("more") > 0))
             .select("uid", "owner", "repo", F.explode(F.concat("base", "more")).alias("s"))
             .select("uid", "owner", "repo", "s", F.col("s.value").alias("value")))
    frequency = (cands.select("value", "owner", "repo").distinct()
                 .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"))
                 .groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos")))
    judged = (cands.select("uid", "s", "value").join(frequency, "value")
              .select("uid", "s", (F.col("owners") <= max_owners).alias("live"), "owners", "repos"))
    span = F.struct("s.start", "s.kind", "s.stop")
    per_row = (judged.groupBy("uid")
               .agg(F.collect_list(F.when((F.col("s.kind") < 3) | F.col("live"), span)).alias("spans"),
                    F.sum(F.col("live").cast("long")).alias("n_live"),
                    F.sum((~F.col("live")).cast("long")).alias("n_example"),
                    F.max("repos").alias("max_repos")))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.array_join(F.transform(F.array_sort("spans"), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return (found.drop("base", "more", "owner", "repo").join(per_row, "uid", "left")
            .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                    F.coalesce(text, F.lit("")).alias("spans"),
                    *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_live", "n_example", "max_repos")]))
