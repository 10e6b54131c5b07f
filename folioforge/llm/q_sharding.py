"""op8: all documents into eight shards of equal counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .sharding import shard_by_rows


def op8_shard_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_rows(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op8_shard_ring": op8_shard_ring}
ORACLES: dict[str, str] = {}
