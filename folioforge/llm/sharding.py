"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `virtual` points of a ring; a row starts at the first point
clockwise of its hash. A shard takes no more than its bound, and what
overflows continues clockwise to the next shard with room. With bounds of
ceil or floor(rows / shards) that sum to the number of rows, counts end at
most one apart, whatever the hashes are.

Distributed: rows that start on the same arc are exchangeable up to their hash
order, so only the number of rows on each arc is needed to run the ring: at
most shards * virtual numbers, bounded by parameters, come to the driver. The
plan says, arc by arc, from which rank on rows go to which shard and slot, and
goes back as a broadcast of bounded size. Ranks inside an arc come from
prefix sums over equal parts of the arc's rows plus a row number in each part.

Null text has size 1 (no bytes plus 1) and checksum 0. Null ids hash like the
text "null". Equal ids are ordered by a hash of their text; equal rows are
interchangeable. Further columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPACE = 1 << 60


def ring(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(point, shard) in clockwise order; the points of a shard do not depend on how many shards there are."""
    points = {}
    for s in range(shards):
        for v in range(virtual):
            points[int(hashlib.md5(f"{s}:{v}".encode()).hexdigest()[:15], 16)] = s
    return sorted(points.items())


def plan(counts: list[int], owners: list[int], bounds: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, first rank, shard, first slot): arcs in clockwise order, each with so many rows.

    Rows take their own arc's shard first. What overflows there moves on to the next arc, in order, until all have a place."""
    room, out, n = list(bounds), [], len(counts)
    slots = [0] * len(bounds)
    waiting: list[list[int]] = [[a, 0, c] for a, c in enumerate(counts) if c]  # arc, first rank, rows
    shift = 0
    while waiting:
        rest = []
        for arc, first, rows in waiting:
            s = owners[(arc + shift) % n]
            fit = min(rows, room[s])
            if fit:
                out.append((arc, first, s, slots[s]))
                room[s] -= fit
                slots[s] += fit
            if rows > fit:
                rest.append([arc, first + fit, rows - fit])
        waiting, shift = rest, shift + 1
    return sorted(out)


def bounds(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shard_by_rows(df: DataFrame, shards: int = 8, virtual: int = 128, parts: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; counts of shards are at most one apart."""
    spark = df.sparkSession
    points = ring(shards, virtual)
    text = F.encode(df[text_col].cast("string"), "utf-8")
    rows = df.select(
        df[id_col].alias("id"),
        (F.coalesce(F.octet_length(df[text_col]), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(df[text_col]).alias("tie"),
    )
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")
    # the first point at or after the hash, round the ring: the space is cut into equal cells, each with its few points
    cells = 4 * len(points)
    at = [p for p, _ in points]
    lows = [bisect.bisect_left(at, -(-c * SPACE // cells)) for c in range(cells + 1)]
    known = spark.createDataFrame([(c, lows[c], at[lows[c] : lows[c + 1]]) for c in range(cells)], "cell int, low int, inside array<long>")
    rows = rows.withColumn("hash", hashed).withColumn("cell", F.expr(f"CAST((CAST(hash AS DECIMAL(30, 0)) * {cells}) DIV {SPACE} AS INT)"))
    rows = rows.join(F.broadcast(known), "cell")
    rows = rows.withColumn("arc", F.expr("CAST((low + size(filter(inside, p -> p < hash))) AS INT)") % len(points)).drop("cell", "low", "inside")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "tie"), F.lit(parts)).cast("int"))
    return _place(spark, rows, points, shards, parts)


def _place(spark, rows: DataFrame, points: list[tuple[int, int]], shards: int, parts: int) -> DataFrame:
    got = {(r.arc, r.part): r.n for r in rows.groupBy("arc", "part").agg(F.count("*").alias("n")).collect()}  # at most shards * virtual * parts numbers
    counts = [sum(got.get((a, p), 0) for p in range(parts)) for a in range(len(points))]
    steps: dict[int, list[tuple[int, int, int]]] = {}
    for arc, first, shard, slot in plan(counts, [s for _, s in points], bounds(sum(counts), shards)):
        steps.setdefault(arc, []).append((first, shard, slot))
    table = []
    for a, s in steps.items():
        start = 0
        firsts = [x[0] for x in s]
        for p in range(parts):
            if n := got.get((a, p), 0):
                low = bisect.bisect_right(firsts, start) - 1
                high = bisect.bisect_left(firsts, start + n)
                table.append((a, p, start, [tuple(x) for x in s[low:high]]))
                start += n
    schema = "arc int, part int, start long, steps array<struct<first: long, shard: int, slot: long>>"
    placed = spark.createDataFrame(table, schema)
    rank = F.row_number().over(Window.partitionBy("arc", "part").orderBy("hash", "id", "tie", "size")) - 1
    rows = rows.withColumn("rank", rank).join(F.broadcast(placed), ["arc", "part"]).withColumn("rank", F.col("rank") + F.col("start"))
    here = F.expr("element_at(filter(steps, s -> s.first <= rank), -1)")
    rows = rows.withColumn("here", here)
    return rows.select("id", "size", "text_crc32", F.col("here.shard").alias("shard"), (F.col("here.slot") + F.col("rank") - F.col("here.first")).alias("slot"))
