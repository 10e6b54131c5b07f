"""Let executors import this package where their path does not hold it already."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Once a session: the package as a zip through Spark's own file service, unless PYTHONPATH or the working folder have it."""
    on_path = {os.path.abspath(p) for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()] if p}
    sc = spark.sparkContext
    if str(ROOT) in on_path or getattr(sc, "_folioforge_shipped", False):
        return
    target = Path(tempfile.mkdtemp()) / "folioforge.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((ROOT / "folioforge").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    sc.addPyFile(str(target))
    sc._folioforge_shipped = True
