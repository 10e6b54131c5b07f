"""The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode where that is unset, as in tests."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_path(spark: SparkSession, name: str) -> str:
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        sc = spark.sparkContext
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = getattr(sc, "_folioforge_folder", None)
        if top is None:
            top = sc._folioforge_folder = "file://" + tempfile.mkdtemp(prefix="folioforge-")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
