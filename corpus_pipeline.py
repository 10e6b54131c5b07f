"""A training corpus from documents: good ones, one of each group of near copies, without personal data, mixed, as token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. run() writes each stage as Parquet in
the shared folder and reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.bpe import bpe_encode, vocabulary
from folioforge.llm.common import saved, table
from folioforge.llm.mixing import mixed
from folioforge.llm.pii import redact
from folioforge.llm.quality import fit_from, keep_good
from folioforge.llm.simhash_dedup import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier scores under 0.3 go.

    Null and empty texts are scored as texts without a word; long ones whole; repeated rows alike, so all stay or go. Without
    labels of both kinds the score is their share, and an empty table stays empty."""
    return keep_good(docs, fit_from(docs, table(spark, sf_dir, "labels")), 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies stays: five-word shingles, Jaccard similarity of 0.8 or more, taken over all links.

    The row with the least id stays, rows with a null id only where no other is in the class. Texts without a word, null and
    empty ones among them, are one class. Of rows equal in id and text one stays, of rows equal in id alone the one with the
    least hash of its text. An empty table stays empty."""
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become marks of their kind; n_chars follows.

    Null texts stay null (and so does their n_chars), empty ones empty; long texts are read whole; repeated rows give repeated
    results; of overlapping spans the first gives the mark. No row goes."""
    return redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of each source as often as its target asks for.

    A null source is a source, the last one. Texts without a word, null and empty ones among them, have size 0 and are not
    taken. Rows stay whole, the one on the edge of a budget is in if at least half of it is; rows equal in id and text are on
    the same side of it. An empty table stays empty."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_chars, n_tokens, ids, round_trip): ids as little-endian unsigned 32 bits; round_trip: they decode to the text.

    Null and empty texts have no ids; long texts are encoded whole; repeated rows give repeated results; further columns of docs
    are not read."""
    done = bpe_encode(docs.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256)), *vocabulary(), decode=True, keep=("lang", "source", "n_chars", "sha"))
    return done.select(
        F.col("id").alias("doc_id"), "lang", "source", "n_chars", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip")
    )


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources", mixture),
    ("byte-level BPE", tokens),
]

#: Classifier, fingerprints and token ids have no SQL; tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"stage-{k + 1}")
    return docs
