"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors by three rounds of random signs and a fast
Hadamard transform and files each under the signed axis it is nearest to. A
query looks under its `probes` nearest signed axes in each of `tables` tables
(more for over 64 dimensions, see probed()); what it meets there is ranked anew by the exact measure, the cosine in double
precision on the vectors as given.

Every row is indexed and nothing is capped. Equal vectors have equal scores and
ties go to smaller ids, so of a group of equal vectors the k+1 rows with
the least ids are filed and no answer changes. A bucket over `most` rows is cut
into chunks, candidates and queries alike, and each pair of chunks is a task
of its own; a task hands on its k best for each query. A query that finds
fewer than k rows, or whose length of vector at most `few` rows have, is
compared to all rows, in blocks.

Rows with a null id or vector, with null, NaN or infinite components, or with
norm 0 take no part. Only vectors of equal length are compared. Rows equal in
id and vector count once; a query skips every row with its own id. Further
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, ship

ROWS = "task long, query boolean, id long, vector array<float>"
FOUND = "query_id long, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Walsh-Hadamard matrix, scaled to a rotation; the width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def axes(x: np.ndarray, table: int, seed: int = 0) -> np.ndarray:
    """Nearness of each row to the 2 * width signed axes of a table."""
    d = 1 << max(1, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    for signs in np.random.default_rng([seed, table, d]).choice([-1.0, 1.0], (3, d)):
        x = hadamard(x * signs)
    return np.concatenate([x, -x], 1)


def _best(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int):
    """The k best of the candidates for each query; ties to smaller ids."""
    c_norm = np.sqrt((c * c).sum(1))
    for i, v in zip(q_id.tolist(), q, strict=True):
        s = (c * v).sum(1) / (c_norm * np.sqrt((v * v).sum()))
        s[c_id == i] = -np.inf
        at = np.flatnonzero(s >= (np.partition(s, -k)[-k] if len(s) > k else -2.0))
        at = at[np.isfinite(s[at])]
        at = at[np.lexsort((c_id[at], -s[at]))][:k]
        if len(at):
            yield i, c_id[at], s[at]


def _compare(rows: DataFrame, k: int) -> DataFrame:
    """rows: task, query, id, vector. Within a task all queries against all candidates."""
    dealt = rows.repartition("task").sortWithinPartitions("task", "query", "id")

    def run(batches):
        task, c_id, c = None, [], []
        ready = None
        for b in batches:
            tasks, query, ids = (b.column(j).to_numpy(zero_copy_only=False) for j in range(3))
            vectors = b.column(3)
            cuts = [0, *(np.flatnonzero((np.diff(tasks) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1).tolist(), b.num_rows]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if a == z:
                    continue
                if tasks[a] != task:
                    task, c_id, c, ready = tasks[a], [], [], None
                part = vectors.slice(a, z - a)
                x = part.flatten().to_numpy(zero_copy_only=False).reshape(z - a, -1).astype(np.float64)
                if not query[a]:
                    c_id.append(ids[a:z])
                    c.append(x)
                elif c:
                    ready = ready or (np.concatenate(c_id), np.concatenate(c))
                    out = list(_best(ids[a:z], x, *ready, k))
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out])), pa.array(np.concatenate([o[1] for o in out])), pa.array(np.concatenate([o[2] for o in out]))],
                            ["query_id", "vec_id", "score"],
                        )

    return dealt.mapInArrow(run, FOUND)


def _in_chunks(rows: DataFrame, most: int) -> DataFrame:
    """Cut the candidates and queries of large buckets; every pair of chunks becomes a task."""
    count = rows.groupBy("task").agg(F.count_if(~F.col("query")).alias("c"), F.count_if("query").alias("q"))
    # buckets over the bound: at most tables * signed axes * vector lengths rows
    large = count.where(F.greatest("c", "q") > most).select("task", F.ceil(F.col("c") / most).cast("int").alias("cs"), F.ceil(F.col("q") / most).cast("int").alias("qs"))
    rows = rows.join(F.broadcast(large), "task", "left")
    own = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.when(F.col("query"), F.col("qs")).otherwise(F.col("cs")))).cast("int")
    other = F.greatest(F.lit(1), F.when(F.col("query"), F.col("cs")).otherwise(F.col("qs"))).cast("int")
    rows = rows.withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
    task = F.xxhash64("task", F.when(F.col("query"), F.col("other")).otherwise(F.col("own")), F.when(F.col("query"), F.col("own")).otherwise(F.col("other")))
    return rows.select(task.alias("task"), "query", "id", "vector")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return one.withColumn("rank", rank).where(F.col("rank") <= k)


def probed(axes: int, probes: int) -> int:
    """Buckets a query asks of each table: `probes` up to 128 signed axes (64 dimensions), beyond them more than in proportion, as the nearest axes say less there."""
    return min(axes, max(probes, math.ceil(probes * (axes / 128) ** 1.2)))


def nearest(df: DataFrame, is_query, k: int = 5, tables: int = 8, probes: int = 10, most: int = 20_000, seed: int = 0, few: int = 1_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which is_query (a column of its id) holds. Vectors of a length that at most `few` rows have are all compared."""
    ship(df.sparkSession)
    src = df.select(df[id_col].cast("long").alias("id"), df[vector_col].cast("array<float>").alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    src = src.where("forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < float('infinity')) AND exists(vector, x -> x <> 0)")
    src = src.dropDuplicates(["id", "vector"]).withColumn("query", is_query(F.col("id")))
    first = F.row_number().over(Window.partitionBy(F.xxhash64("vector"), "vector").orderBy("id"))
    src = saved(src.withColumn("nth", first).where(F.col("query") | (F.col("nth") <= k + 1)).select("id", "query", (F.col("nth") <= k + 1).alias("filed"), "vector"), "vectors")

    def run(batches):
        for b in batches:
            ids, query, filed = (b.column(j).to_numpy(zero_copy_only=False) for j in range(3))
            length = np.diff(b.column(3).offsets.to_numpy())
            flat, starts = b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(length)])
            for d in np.unique(length).tolist():
                at = np.flatnonzero(length == d)
                x = flat[(starts[at][:, None] + np.arange(d))]
                x = x / np.sqrt((x * x).sum(1, keepdims=True))
                for t in range(tables):
                    near = axes(x, t, seed)
                    home = near.argmax(1)
                    some = probed(near.shape[1], probes)
                    asked = np.flatnonzero(query[at])
                    seen = np.argpartition(-near[asked], some - 1, axis=1)[:, :some] if some < near.shape[1] else np.tile(np.arange(some), (len(asked), 1))
                    put = np.flatnonzero(filed[at])
                    rows = np.concatenate([at[put], np.repeat(at[asked], some)])
                    bucket = np.concatenate([home[put], seen.ravel()]).astype(np.int64)
                    kind = np.concatenate([np.zeros(len(put), bool), np.ones(len(asked) * some, bool)])
                    for a in range(0, len(rows), 8192):
                        s = slice(a, a + 8192)
                        yield pa.RecordBatch.from_arrays([pa.array(bucket[s] + (t << 32) + (d << 40)), pa.array(kind[s]), pa.array(ids[rows[s]]), b.column(3).take(pa.array(rows[s]))], ["task", "query", "id", "vector"])

    filed = src.mapInArrow(run, ROWS)
    found = saved(_ranked(_compare(_in_chunks(filed, most), k), k), "found")
    short = src.where("query").select("id").join(found.groupBy("query_id").agg(F.count("*").alias("n")), F.col("id") == F.col("query_id"), "left").where(F.coalesce("n", F.lit(0)) < k).select("id")
    # one row for each length of vectors that is rare
    rare = src.where("filed").groupBy(F.size("vector").alias("d")).count().where(F.col("count") <= few).select("d")
    short = short.unionByName(src.where("query").join(F.broadcast(rare), F.size("vector") == F.col("d"), "left_semi").select("id")).distinct()
    short = saved(short, "short")
    if not short.isEmpty():
        every = src.where("filed").select(F.size("vector").cast("long").alias("task"), F.lit(False).alias("query"), "id", "vector")
        asked = src.where("query").join(short, "id").select(F.size("vector").cast("long").alias("task"), F.lit(True).alias("query"), "id", "vector")
        more = _compare(_in_chunks(every.unionByName(asked), most), k)
        found = _ranked(found.select("query_id", "vec_id", "score").unionByName(more), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
