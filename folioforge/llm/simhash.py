"""Document fingerprints in DataFrame functions only: SimHash and permuted block tables.

Every word (lower case, between blanks, tabs and line ends) is a term; its
64-bit hash votes on every bit, for it where the bit is set and against it
where not, with the term's weight: 1 for up to three letters, 3 for up to six,
5 for longer ones, so that function words count little; repeated terms vote
again. A bit is set if the votes for it outweigh those against it.

The votes of a text are counted inside its row, four 16-bit counters to a
long, in chunks of 6,553 terms. Their counters stay under 2^15, whatever the
terms are: the topmost ends at the sign of the long, and Spark's additions fail
where they would change it. So there is no shuffle and no row per term. Texts
without a term have fingerprint 0.

within() finds all fingerprints in a Hamming radius r: the bits are cut into
m ranges, of which a difference in the radius leaves m - r untouched at least. For each
choice of m - r ranges a table holds the fingerprints with those bits in front
(the others masked off), so two fingerprints in the radius agree in the leading
bits of one table at least. Tables join by them, a value that many fingerprints
share is dealt to many parts, and the distance is checked. m comes from the
number of fingerprints: the longer the leading bits, the fewer meet by chance.

Null text counts as empty. Rows with a null id come last in descending order.
Rows with equal ids are ordered by a hash of their text. Further columns are
not read; repeated rows give repeated results.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, spread_join

_ONES = 0x0001000100010001
#: Terms of weight 5 whose votes for one bit stay under 2^15.
_CHUNK = (2**15 - 1) // 5


def _terms(text: str) -> str:
    weight = "CASE WHEN t = '' THEN 0L WHEN char_length(t) <= 3 THEN 1L WHEN char_length(t) <= 6 THEN 3L ELSE 5L END"
    return f"transform(split(lower({text}), '[ \\\\t\\\\n\\\\r]+'), t -> named_struct('h', xxhash64(t), 'w', {weight}))"


def _votes(terms: str) -> str:
    """64 sums of weights of terms whose bit is set, then the sum of all weights."""
    zero = "named_struct(" + ", ".join([f"'c{j}', 0L" for j in range(16)] + ["'w', 0L"]) + ")"
    add = "named_struct(" + ", ".join([f"'c{j}', a.c{j} + (shiftrightunsigned(x.h, {j}) & {_ONES}L) * x.w" for j in range(16)] + ["'w', a.w + x.w"]) + ")"
    lanes = "array(" + ", ".join(f"s.c{j}" for j in range(16)) + ")"
    spread = f"concat(transform(sequence(0, 63), b -> shiftrightunsigned(get({lanes}, b % 16), CAST(16 * (b DIV 16) AS INT)) & 65535L), array(s.w))"
    chunk = f"aggregate(slice({terms}, k * {_CHUNK} + 1, {_CHUNK}), {zero}, (a, x) -> {add}, s -> {spread})"
    return f"aggregate(sequence(0, (size({terms}) - 1) DIV {_CHUNK}), array_repeat(0L, 65), (v, k) -> zip_with(v, {chunk}, (p, q) -> p + q))"


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with the fingerprint of a text column (not null) as a long."""
    df = df.withColumn("__terms", F.expr(_terms(text))).withColumn("__votes", F.expr(_votes("__terms"))).drop("__terms")
    bits = "aggregate(sequence(0, 63), 0L, (f, b) -> f | CASE WHEN 2 * get(__votes, b) > get(__votes, 64) THEN shiftleft(1L, b) ELSE 0L END)"
    return df.withColumn(name, F.expr(bits)).drop("__votes")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) of every row."""
    rows = df.select(df[id_col].alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
    return with_fingerprint(rows, "text", "fp").select("id", "fp")


def with_next(df: DataFrame, parts: int, columns: tuple[str, ...]) -> DataFrame:
    """df (id, tie, ...) with next_<column>: that of the next row in descending order, and of the first row after the last.

    Rows are dealt to ranges of ids (their limits are approximate quantiles) and
    sorted there; the first row of a range also goes, as a carried copy, to the
    range before it. Only range limits come to the driver: at most `parts`."""
    spark = df.sparkSession
    found = df.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)] or [0.5], 10_000)).first()[0] if parts > 1 else None
    limits = F.array(*[F.lit(int(x)) for x in sorted(set(found or []))]).cast("array<long>")
    df = df.withColumn("range", F.coalesce(F.size(F.filter(limits, lambda m: m <= F.col("id"))), F.lit(0)).cast("int"))
    df = df.withColumn("range", F.greatest("range", F.lit(0)))
    tops = sorted((r["range"], r.top) for r in df.groupBy("range").agg(F.max("id").alias("top")).select("range", "top").collect())
    carried = [(b, top, tops[(k + 1) % len(tops)][0]) for k, (b, top) in enumerate(tops)]
    carried = spark.createDataFrame(carried, "range int, top long, to int")
    df = df.alias("d").join(F.broadcast(carried).alias("c"), F.expr("d.range = c.range AND d.id <=> c.top"), "left").select("d.*", "to")
    own = F.struct(F.col("range").alias("at"), F.lit(False).alias("carry"))
    df = df.withColumn("__to", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("to").alias("at"), F.lit(True).alias("carry"))))))
    df = df.withColumns({"at": F.col("__to.at"), "carry": F.col("__to.carry")}).drop("__to", "to", "range")
    order = Window.partitionBy("at").orderBy("carry", F.desc_nulls_last("id"), F.desc("tie"))
    df = df.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return df.where(~F.col("carry")).drop("at", "carry")


def edited(df: DataFrame, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fp, edited_fp, next_fp) of every row; edited: the last half of the text replaced by as much of the start of the next one."""
    # ranges hold equal numbers of rows, not of bytes: with more of them than tasks the largest is less of the whole
    n = parts or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(df[id_col].cast("long").alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
    rows = with_fingerprint(rows.withColumn("tie", F.xxhash64("text")), "text", "fp")
    rows = with_next(rows, n, ("text", "fp"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("half", F.expr("CAST(n_chars DIV 2 AS INT)"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, CAST(n_chars AS INT) - half), substring(next_text, 1, half))"))
    rows = with_fingerprint(rows.select("id", "n_chars", "edited", "fp", "next_fp"), "edited", "edited_fp")
    return rows.select("id", "n_chars", "edited", "fp", "edited_fp", "next_fp")


def ranges(n: int, radius: int, row: int = 1000) -> int:
    """The number of bit ranges that costs least for n fingerprints: a table costs each row as much as `row` comparisons, and the comparisons that agreeing by chance brings."""
    return min(range(radius + 1, radius + 5), key=lambda m: math.comb(m, radius) * (row + n / 2 ** (64 / m * (m - radius))))


def masks(m: int, radius: int) -> list[int]:
    """Bits that lead in each table, as signed longs."""
    edges = [round(64 * k / m) for k in range(m + 1)]
    bits = [sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen) for chosen in combinations(range(m), m - radius)]
    return [x - (1 << 64) if x >> 63 else x for x in bits]


def within(queries: DataFrame, corpus: DataFrame, radius: int = 3, parts: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(query_fp, fp, distance, columns of corpus to keep): for each distinct fingerprint of queries all distinct ones of corpus in the radius, itself included.

    corpus holds a fingerprint once if there are columns to keep. parts: the number of bit ranges, by default from the number of rows of corpus."""
    lead = masks(parts or ranges(corpus.count(), radius), radius)

    def tables(df: DataFrame, name: str, *more: str) -> DataFrame:
        rows = [F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(x).cast("long")).alias("lead")) for k, x in enumerate(lead)]
        return df.select(F.col("fp").alias(name), *more, F.explode(F.array(*rows)).alias("t")).select(name, *more, "t.k", "t.lead")

    own = corpus if keep else corpus.select("fp").distinct()
    pairs = spread_join(tables(own, "fp", *keep), tables(queries.select("fp").distinct(), "query_fp"), ["k", "lead"], "fp")
    apart = F.col("query_fp").bitwiseXOR(F.col("fp"))
    # a pair meets in several tables; the first one in which it meets stands for it, so no distinct is needed
    first = F.expr("CASE " + " ".join(f"WHEN ((query_fp ^ fp) & {x}L) = 0 THEN {k}" if x > -(1 << 63) else f"WHEN ((query_fp ^ fp) & (-9223372036854775807L - 1L)) = 0 THEN {k}" for k, x in enumerate(lead)) + " END")
    return pairs.where((F.bit_count(apart) <= radius) & (F.col("k") == first)).select("query_fp", "fp", F.bit_count(apart).alias("distance"), *keep)


def near_counts(rows: DataFrame, asked: Column, radius: int = 3) -> DataFrame:
    """rows (id, fp, ...), a table -> also n_near: how many rows have a fingerprint in the radius, the row itself included; null where `asked` does not hold."""
    counts = saved(rows.groupBy("fp").agg(F.count("*").alias("n")), "counts")
    asked = F.coalesce(asked, F.lit(False))
    found = within(rows.where(asked), counts, radius, keep=("n",)).groupBy(F.col("query_fp").alias("fp")).agg(F.sum("n").alias("n_near"))
    told = spread_join(rows.where(asked), saved(found, "near"), ["fp"], "id")
    return told.select(*rows.columns, "n_near").unionByName(rows.where(~asked).withColumn("n_near", F.lit(None).cast("long")))
