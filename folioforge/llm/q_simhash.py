"""op6: fingerprints of all documents and of their edited texts, and how many documents lie near every hundredth one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table, unsigned_hex
from .simhash import edited, likeness, near_counts

#: A document whose id is divisible by this is a query of the table search.
EVERY = 100


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_near: documents whose fingerprint differs in at most 3 bits, itself included; for the queries, else null."""
    rows = edited(table(spark, sf_dir, "documents")).withColumn("edited", F.sha2("edited", 256))
    rows = near_counts(saved(rows, "rows"), F.col("id") % EVERY == 0)
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.col("edited").alias("edited_sha256"),
        unsigned_hex(F.col("fp")).alias("fingerprint"),
        unsigned_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_near",
    )


QUERIES = {"op6_document_fingerprints": op6_document_fingerprints}
ORACLES: dict[str, str] = {}
