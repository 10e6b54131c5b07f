"""op2: main text of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .htmltext import main_text


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


QUERIES = {"op2_html_text": op2_html_text}
ORACLES: dict[str, str] = {}
