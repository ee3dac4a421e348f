"""The corpus pipeline: quality, exact duplicates, near duplicates, contamination, packing.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor kept and returns a
DataFrame; ``run`` writes it as Parquet to the shared folder and hands the next stage what it reads
back. All stages but the last return the columns of ``documents``; the last returns where each piece of a document lies
(id, piece, word offset, bin), and the texts stay in the stage before.

Defined results: null text counts as empty in each stage; rows are told apart by id and text, so rows that repeat an id are kept or
dropped each by the stage's rule (of equal ones the smallest id stays, ties by text hash); texts of any length are read whole; an empty
table passes through; further columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorium.llm.common import table, written
from sensorium.llm.decontaminate import remove_contaminated
from sensorium.llm.exact_dedup import drop_exact
from sensorium.llm.packing import pack
from sensorium.llm.quality import keep_quality
from sensorium.llm.simhash import drop_near


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return drop_near(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of packed sequences."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: No SQL expresses the classifier; the pipeline is tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
