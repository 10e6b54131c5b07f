"""What the operators of this subpackage share: the shared folder, written tables, loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import fresh_path
from ..sources.shipping import ship


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: lineage ends here and a lost executor costs nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folioforge_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the table behind a saved() frame that nothing reads any more."""
    path = getattr(df, "_folioforge_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def spread_join(left: DataFrame, right: DataFrame, on: list[str], by: str, how: str = "inner", parts: int = 64) -> DataFrame:
    """left joined with right, which holds one row for each value of `on`, where a value may stand in very many rows of left.

    Rows of left are dealt to `parts` parts of each value by a hash of the column `by`, and the row of right is given to the
    parts that occur; so no task holds all rows of a value. left is computed twice: give it as a table."""
    (salt,) = free_names([*left.columns, *right.columns], "part")
    left = left.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(parts)))
    given = left.select(*on, salt).distinct().join(right, on)
    return left.join(given, [*on, salt], how).drop(salt)


def free_names(taken: list[str], *names: str) -> list[str]:
    """Names for columns of our own that none of the columns of a caller's table has, in any case."""
    held = {c.lower() for c in taken}
    out = []
    for n in names:
        k = f"__{n}"
        while k in held:
            k += "_"
        held.add(k)
        out.append(k)
    return out


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str, spread: bool = True) -> DataFrame:
    """A table; with columns only these. spread: rows of a table whose files split into fewer parts than there are cores are dealt out evenly (one file of one row group, say); it moves the texts once and changes no result."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if not columns:
        return df
    df, cores = df.select(*columns), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def unsigned_hex(col):
    """A signed long as 16 lowercase hex digits of its bits."""
    return F.lpad(F.lower(F.hex(col)), 16, "0")


__all__ = ["forget", "free_names", "fresh_path", "saved", "ship", "spread_join", "table", "unsigned_hex"]
