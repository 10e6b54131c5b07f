"""op3: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .pii import detect


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


QUERIES = {"op3_pii_spans": op3_pii_spans}
ORACLES: dict[str, str] = {}
