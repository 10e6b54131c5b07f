"""op10: the five nearest of every fiftieth vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .ann import nearest
from .common import table


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


QUERIES = {"op10_nearest_vectors": op10_nearest_vectors}
ORACLES: dict[str, str] = {}
