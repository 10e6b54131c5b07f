import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from folioforge.llm import simhash
from folioforge.llm.q_simhash import op6_document_fingerprints


def plain(text):
    votes, total = [0] * 64, 0
    for t in re.split("[ \t\n\r]+", (text or "").lower()):
        w = 0 if not t else 1 if len(t) <= 3 else 3 if len(t) <= 6 else 5
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        total += w
        for b in range(64):
            votes[b] += w * (h >> b & 1)
    return sum((2 * votes[b] > total) << b for b in range(64))


def want(rows):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    tie = lambda t: signed(xxhash.xxh64_intdigest(t.encode(), 42))
    rows = [(k, t or "") for k, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])), reverse=True)
    out = []
    for i, (k, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        like = lambda a, b: 1 - (a ^ b).bit_count() / 64
        out.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), f"{plain(t):016x}", f"{plain(e):016x}", like(plain(t), plain(e)), like(plain(t), plain(nxt))))
    prints = [int(o[3], 16) for o in out]
    near = lambda f: sum((f ^ g).bit_count() <= 3 for g in prints)
    return sorted(((*o, near(f) if o[0] is not None and o[0] % 100 == 0 else None) for o, f in zip(out, prints, strict=True)), key=str)


def test_edge_rows(spark, tmp_path):
    r = random.Random(8)
    text = lambda n: " ".join("".join(r.choice("abcdefé😀") for _ in range(r.randrange(1, 9))) for _ in range(n))
    rows = [(i * 7 - 40, text(r.randrange(0, 40))) for i in range(60)]
    rows += [(None, "no id"), (1000, None), (1001, ""), (1002, text(20_000)), (5, "twin"), (5, "twin"), (5, "other text of five"), (1003, " \n\t "), (200, "twin"), (300, "twin")]
    spark.createDataFrame([(k, t, "x", 1.0) for k, t in rows], "doc_id long, text string, fingerprint string, range double").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    df = op6_document_fingerprints(spark, str(tmp_path))
    assert sorted((tuple(x) for x in df.collect()), key=str) == want(rows)
    assert len({x.n_near for x in df.collect()}) > 1
    for made in (df, simhash.edited(spark.read.parquet(f"{tmp_path}/documents.parquet"))):
        plan = made._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_one_word_thousands_of_times(spark, tmp_path):
    words = [(w, n) for w in ("repetition", "another", "seventh", "thones", "of") for n in (6553, 6554, 8192, 13_107, 20_000)]
    rows = [(k, f"{w} " * n) for k, (w, n) in enumerate(words)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((tuple(x) for x in op6_document_fingerprints(spark, str(tmp_path)).collect()), key=str) == want(rows)


def test_one_row_and_none(spark, tmp_path):
    spark.createDataFrame([(3, "alone here")], "doc_id long, text string").write.parquet(f"{tmp_path}/a/documents.parquet")
    assert [tuple(r) for r in op6_document_fingerprints(spark, f"{tmp_path}/a").collect()] == want([(3, "alone here")])
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/b/documents.parquet")
    assert op6_document_fingerprints(spark, f"{tmp_path}/b").collect() == []


def test_real_rows(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op6_document_fingerprints(spark, d).collect()), key=str)
    assert got == want(rows)
    assert sum(g[5] > g[6] for g in got) > 0.6 * len(got)


def test_tables_find_all_in_the_radius(spark):
    r = random.Random(2)
    fps = [r.getrandbits(64) for _ in range(40)]
    for f in list(fps):
        for k in range(5):
            x = f
            for b in r.sample(range(64), k):
                x ^= 1 << b
            fps.append(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for radius, parts in ((0, None), (2, 4), (3, None), (3, 6), (4, 6)):
        got = sorted(tuple(x) for x in simhash.within(df.where(F.col("fp") % 3 == 0), df, radius, parts).collect())
        brute = sorted({(a, b, (a ^ b).bit_count() if (a ^ b) >= 0 else ((a ^ b) + (1 << 64)).bit_count()) for a in signed if abs(a) % 3 == 0 for b in signed if bin((a ^ b) & (2**64 - 1)).count("1") <= radius})
        assert got == brute
