"""Mixing sources to target weights.

Every row gets a hash-random key from its id. Keys are dealt into `ranges`
equal ranges of the key space within each source (a range-sort by a key that
is uniform by construction needs no sampling), token counts are summed by
range, and prefix sums over these sums give each range its start: so the
running count inside a source is known row by row although no task ever holds
a source. The mix takes whole epochs of a source and then its rows in key
order up to the exact budget; the row on the edge is cut inside.

Targets: the share of all sizes is split by weight; a source stops at
`most` times its size and the excess is split again by weight among the
others, until none is above, round by round over a table of the sources.

Null text has size 0. A null source is a source, the last one. Equal ids are
ordered by a hash of their text; equal rows are interchangeable. Sizes of 0
take 0. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_names, saved

WEIGHTS = (5, 2, 1)
#: Words between white space U+0020, U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"


def key(col):
    """60 hash-random bits of an id, the same in any engine that has md5."""
    return F.conv(F.substring(F.md5(F.coalesce(col.cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")


def _weighed(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, weight): weights repeat in code point order, null last. Sources are dealt to ranges of names and numbered inside them; of a range only its count comes to the driver."""
    ranged = saved(sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    before, total = [], 0
    for r in sorted(ranged.groupBy("part").count().collect()):
        before += [F.lit(r[0]), F.lit(total)]
        total += r[1]
    start = F.element_at(F.create_map(*before), F.col("part")) if before else F.lit(0)
    nth = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + start
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int")).cast("long")
    return saved(ranged.select("source", "source_size", weight.alias("weight")), "weights")


def targets(sizes: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> also target double. A row for each source; weights repeat in code point order, null last.

    Each round splits what is left by weight among the sources that are not full; those it fills are taken out. Sums of a
    round are all that reaches the driver, and the rounds end when none is filled any more."""
    w = _weighed(sizes, weights)
    sums = lambda rows: [int(x or 0) for x in rows.agg(F.sum("source_size"), F.sum("weight")).first()]
    size, open_ = every = sums(w)
    total = float(size) * float(share)
    left, seen = total, None
    while True:
        full = F.lit(left) * F.col("weight") >= F.lit(most) * F.col("source_size") * F.lit(open_)
        held = sums(w.where(full))
        if held == seen or open_ == 0:
            break
        seen = held
        left, open_ = total - float(held[0] * most), every[1] - held[1]
    share_of = F.lit(left / open_ if open_ else 0.0) * F.col("weight")
    return w.select("source", "source_size", F.when(full, (F.col("source_size") * most).cast("double")).otherwise(share_of).alias("target"))


def _ordered(df: DataFrame, share: float, most: int, weights: tuple[int, ...], ranges: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, key, tie, source_size, target, prior): prior counts what comes before a row in its source, in key order."""
    size = F.coalesce(F.regexp_count(df[text_col], F.lit(WORD)), F.lit(0)).cast("long")
    rows = df.select(df[id_col].alias("id"), df[source_col].alias("source"), size.alias("size"), F.xxhash64(df[text_col]).alias("tie"))
    rows = rows.withColumn("key", key(F.col("id"))).withColumn("range", (F.col("key") / F.lit(float((1 << 60) // ranges))).cast("int"))
    rows = saved(rows, "sized")  # a few numbers a row: words are counted once, for the sums, the starts and the mix
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("n"))
    sizes = targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), share, most, weights)
    starts = sums.select("source", "range", (F.sum("n").over(Window.partitionBy("source").orderBy("range")) - F.col("n")).alias("start"))
    starts = starts.alias("a").join(sizes.alias("b"), F.expr("a.source <=> b.source")).select("a.*", "source_size", "target")
    in_range = Window.partitionBy("source", "range").orderBy("key", "id", "tie", "size")
    rows = rows.withColumn("prior", F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = rows.alias("r").join(starts.alias("s"), F.expr("r.source <=> s.source AND r.range = s.range"))
    return rows.select("r.id", "r.source", "r.size", "r.key", "r.tie", "s.source_size", "s.target", (F.col("r.prior") + F.col("s.start")).alias("prior"))


def _budget() -> tuple:
    """(whole epochs of a source, what its budget leaves after them)."""
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    return epochs, budget - epochs * F.col("source_size")


def mix(df: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, ranges: int = 1024, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, taken) of every row."""
    rows = _ordered(df, share, most, weights, ranges, id_col, text_col, source_col)
    epochs, rest = _budget()
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("prior")))
    return rows.select("id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(df: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, ranges: int = 1024, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """df as the mix takes it: each row as often as it is taken, with all its columns.

    Rows stay whole: the one on the edge of a budget is in if at least half of it is. The texts do not move:
    a source needs only its epochs and the key up to which it is taken once more, a small table."""
    own, epochs_, edge_, times_, copy_ = free_names(df.columns, "source", "epochs", "edge", "times", "copy")
    rows = _ordered(df, share, most, weights, ranges, id_col, text_col, source_col)
    epochs, rest = _budget()
    edge = F.max(F.when((F.col("size") > 0) & (2 * (rest - F.col("prior")) >= F.col("size")), F.struct("key", "tie")))
    cuts = rows.withColumn("whole", epochs).groupBy("source").agg(F.max("whole").cast("int").alias(epochs_), edge.alias(edge_)).withColumnRenamed("source", own)
    cuts = saved(cuts, "cuts")  # a row for each source; as a table its size is known, so the planner broadcasts it where it is small
    here = F.struct(key(df[id_col]).alias("key"), F.xxhash64(df[text_col]).alias("tie"))
    out = df.join(cuts, df[source_col].eqNullSafe(F.col(own)))
    times = F.col(epochs_) + F.coalesce(here <= F.col(edge_), F.lit(False)).cast("int")
    times = F.when(df[text_col].rlike(WORD.rstrip("+")), times).otherwise(0)  # texts without a word take nothing
    out = out.withColumn(times_, times).where(F.col(times_) > 0).withColumn(copy_, F.explode(F.sequence(F.lit(1), F.col(times_))))
    return out.select(*[out[c] for c in df.columns])
