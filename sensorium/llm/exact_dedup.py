"""Exact deduplication: a 128-bit content hash, the smallest id stays, bytes compared in each group.

Only DataFrame functions run. Groups are aggregated by (hash, normalised text), so Spark
compares the bytes: texts that merely share a hash stay apart. Its map-side partial aggregation
sends one row per distinct text and task, however many copies there are. Rows then find their
group by hash and SHA-256 (which tells apart what the hash alone might not) without moving text,
in a join whose skewed keys Spark splits.

Defined results: null text counts as empty; a null id counts as larger than any other
(``keep_id`` is null only where a group has no id); rows that repeat an id and a text are
each returned, and all of them are ``kept`` if the id is the smallest; texts of any length are compared whole; an empty table gives
no rows; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, unpacked, whole_row


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    rows = docs.select(*more, quoted(id_col).alias("id"), normalised(quoted(text_col)).alias("norm"))
    return rows.withColumns({"h128": F.md5("norm"), "sha": F.sha2("norm", 256)})


def _groups(rows: DataFrame) -> DataFrame:
    groups = rows.groupBy("h128", "norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    return groups.select("h128", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, content_hash."""
    rows = _keyed(docs, id_col, text_col)
    out = rows.select("id", "h128", "sha").join(_groups(rows), ["h128", "sha"])
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"), F.col("h128").alias("content_hash"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged.

    Of rows that repeat the smallest id of a group (or have none), one stays.
    """
    names = docs.columns
    id_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = _keyed(docs, id_col, text_col, whole_row(docs).alias("row"))
    best = _groups(rows.select("id", "norm", "h128")).select("h128", "sha", id_key("keep_id").alias("key"))
    keys = ["h128", "sha", "key"]
    kept = rows.withColumn("key", id_key("id")).select("row", *keys).join(best, keys, "left_semi")
    return unpacked(kept.dropDuplicates(keys), names)
