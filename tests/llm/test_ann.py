import numpy as np
from pyspark.sql import functions as F

from folioforge.llm import ann
from folioforge.llm.q_ann import op10_nearest_vectors


def brute(rows, k=5, every=50):
    """(id, vector) -> query id -> [(id, score)]"""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in ok:
        if i % every:
            continue
        v = np.array(v, np.float32).astype(np.float64)
        got = out.setdefault(i, [])
        for j, w in ok:
            if j != i and len(w) == len(v):
                w = np.array(w, np.float32).astype(np.float64)
                got.append((-(v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum())), j))
    return {i: [(j, -s) for s, j in sorted(set(g))[:k]] for i, g in out.items()}


def shown(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose((ann.hadamard(x) ** 2).sum(1), (x**2).sum(1))
    assert np.allclose(ann.hadamard(ann.hadamard(x)), x)


def test_recall(spark):
    for sf in ("sf0.1",):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
        want, got = brute(rows), shown(op10_nearest_vectors(spark, f"/root/testdata/{sf}"))
        assert got.keys() == want.keys() and all(len(g) == 5 for g in got.values())
        recall = np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 5 for q in want])
        print("recall", recall)
        assert recall >= 0.95
        scores = {q: dict(g) for q, g in want.items()}
        for q, g in got.items():
            for j, s in g:
                assert j not in scores[q] or abs(scores[q][j] - s) < 1e-14


def test_edge_rows(spark, tmp_path):
    r = np.random.default_rng(1)
    same = [float(x) for x in r.normal(size=8)]
    rows = [(i, same) for i in range(0, 120)]  # ties: smaller ids first
    rows += [(200, None), (250, [0.0] * 8), (300, [1.0, None] + [0.0] * 6), (350, [float("nan")] * 8), (400, [float("inf")] + [0.0] * 7), (None, same), (450, []), (0, same)]
    rows += [(500, [1.0, 2.0, 3.0]), (501, [1.0, 2.0, 3.5]), (550, [float(x) for x in r.normal(size=8)])]
    spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, rank int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got, want = shown(op10_nearest_vectors(spark, str(tmp_path))), brute(rows)
    assert {q: [j for j, _ in g] for q, g in got.items()} == {q: [j for j, _ in g] for q, g in want.items()}
    assert got[0][0][0] == 1 and got[50][0][0] == 0 and [j for j, _ in got[500]] == [501]


def test_large_buckets_are_cut(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=16)
    rows = [(i, [float(x) for x in base + 0.05 * r.normal(size=16)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    one = shown(ann.nearest(df, lambda i: i % 10 == 0))
    cut = shown(ann.nearest(df, lambda i: i % 10 == 0, most=7))
    assert one == cut and len(one) == 30


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op10_nearest_vectors(spark, str(tmp_path)).collect() == []


def recall_of(rows, df, every):
    want, got = brute(rows, every=every), shown(ann.nearest(df, lambda i: i % every == 0))
    return np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / len(want[q]) for q in want])


def test_recall_of_small_tables(spark):
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        recall = recall_of([(r.vec_id, r.embedding) for r in df.collect()], df, 50)
        print(sf, df.count(), "recall", recall)
        assert recall >= 0.9, sf


def test_recall_of_long_vectors(spark):
    x = np.random.default_rng(1).normal(size=(3000, 384)).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    recall = recall_of(rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4), 100)
    print("384", recall)
    assert recall >= 0.9
