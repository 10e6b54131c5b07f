"""op9: mix all documents to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .mixing import mix


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, text,
         ('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS k
  FROM documents),
sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
a AS (
  SELECT *, CAST(SUM(source_size) OVER () AS DOUBLE) * 1.5
            - 2 * COALESCE(SUM(source_size) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         SUM(weight) OVER () - COALESCE(SUM(weight) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM sources),
b AS (
  SELECT *, MAX(CASE WHEN remaining * weight < 2 * source_size * open THEN 1 ELSE 0 END)
              OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS free FROM a),
c AS (
  SELECT source, source_size,
         CASE WHEN free = 1 THEN (SELECT arg_max(remaining / open, open) FROM b WHERE free = 1) * weight ELSE CAST(2 * source_size AS DOUBLE) END AS target
  FROM b),
d AS (
  SELECT s.doc_id, s.size, c.source_size, c.target, CAST(round(c.target) AS BIGINT) AS budget,
         CAST(SUM(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id ROWS UNBOUNDED PRECEDING) - s.size AS BIGINT) AS prior
  FROM sized s JOIN c ON s.source IS NOT DISTINCT FROM c.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM d)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - prior)) AS BIGINT) AS taken
FROM e
"""

QUERIES = {"op9_mix_sources": op9_mix_sources}
ORACLES = {"op9_mix_sources": SQL}
