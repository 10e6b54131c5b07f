"""op4: near-duplicate classes of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, unsigned_hex
from .simhash_dedup import near_duplicates


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), unsigned_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


QUERIES = {"op4_simhash_dedup": op4_simhash_dedup}
ORACLES: dict[str, str] = {}
