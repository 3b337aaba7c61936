"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes an empty table, texts of any length, nulls in any column and columns of any
names beside those of ``documents``; all but the last give the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import bpe, decontam, linededup, quality, simhash
from fleetlens.llm.catalog import byte_bpe_ranks
from fleetlens.llm.common import staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, holds to be good.

    A null text is judged as an empty one; repeated rows are judged alike.
    """
    model = quality.fit(docs, quality.graded(table(spark, sf_dir, "labels")))
    return quality.select_good(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; blocks that an earlier one has are deleted from the text of the later one.

    The earlier one has the less id, then the less text hash.  Rows with a null id or text stay as they are.
    """
    return linededup.dedup(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the least id, null ids last.

    Null and empty texts are one group.  Repeated rows are one document.
    """
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item; null and empty texts have none."""
    return decontam.without_copies(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the number of them; a null text has none."""
    return bpe.encode(docs, bpe.shared_codec(spark, byte_bpe_ranks()))


STAGES = [("quality", quality_stage), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage),
          ("decontamination", decontamination_stage), ("encode", encode_stage)]

#: The stages fit a classifier and align texts, which SQL does not express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in their order to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
