"""op7: quality of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .quality import fit_from, fold, score


def op7_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    model = fit_from(documents, table(spark, sf_dir, "labels"))
    return score(documents, model).select(
        F.col("id").alias("doc_id"), (fold(F.col("id")) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


QUERIES = {"op7_quality_score": op7_quality_score}
ORACLES: dict[str, str] = {}
