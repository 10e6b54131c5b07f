"""Blocks, glossaries, manifests and logs as JSON files with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "doc_id BIGINT, block_id STRING, type STRING, section STRING, source STRING, translated STRING, repaired STRING, meta STRUCT<line_start: BIGINT, line_end: BIGINT>"
ENTRY = "term STRING, policy STRING, source STRING, translation_zh_tw STRING"
REQUIRED = ("block_id", "type", "source")


def write_blocks(df: DataFrame, path: str, by: str | None = None) -> str:
    """One JSON object a line; by: a column whose values become folders, such as the paper."""
    (df.write.partitionBy(by) if by else df.write).json(path)
    return path


def read_blocks(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """strict: a broken line or a missing required key fails the job; else such lines come back as `broken` with their text."""
    if strict:
        df = spark.read.schema(BLOCK).option("mode", "FAILFAST").json(path)
        ok = F.lit(True)
        for k in REQUIRED:
            ok = ok & F.col(k).isNotNull()
        return df.where(F.assert_true(ok, "a block lacks a required key").isNull())
    df = spark.read.schema(BLOCK + ", broken STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken").json(path)
    return df


def write_glossaries(entries: DataFrame, path: str) -> str:
    """entries: doc_id, term, policy, source, translation -> one object {doc_id, entries} a document."""
    item = F.struct("term", "policy", "source", F.col("translation").alias("translation_zh_tw"))
    entries.groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("entries")).write.json(path)
    return path


def read_glossaries(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(f"doc_id BIGINT, entries ARRAY<STRUCT<{ENTRY.replace(' STRING', ': STRING')}>>").json(path)
    return df.select("doc_id", F.explode("entries").alias("e")).select("doc_id", "e.term", "e.policy", "e.source", F.col("e.translation_zh_tw").alias("translation"))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(paper_id, text): each file whole; the paper is named by the file's stem."""
    df = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"), F.input_file_name().alias("file"))
    return df.select(F.regexp_extract("file", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("paper_id"), "text")


def write_markdown(df: DataFrame, path: str, text_col: str = "text") -> str:
    df.select(F.col(text_col).alias("value")).write.text(path)
    return path
