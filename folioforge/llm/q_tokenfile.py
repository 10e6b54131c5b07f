"""op5: write every document's ids to flat files and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokenfile import library_codec, read_tokens, token_folder, write_tokens

END_ID = 2


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = token_folder(spark)
    manifest = write_tokens(table(spark, sf_dir, "documents"), folder, path, END_ID)
    back = read_tokens(spark, folder, manifest, library_codec(path).width.str)
    return back.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op5_token_files": op5_token_files}
ORACLES: dict[str, str] = {}
