"""op1: encode every document, decode the ids, return digests of both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encode, vocabulary
from .common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe_encode(table(spark, sf_dir, "documents", "doc_id", "text"), *vocabulary(), decode=True)
    return done.select(
        F.col("id").alias("doc_id"),
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op1_byte_bpe": op1_byte_bpe}
ORACLES: dict[str, str] = {}
