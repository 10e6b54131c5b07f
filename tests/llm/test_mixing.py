import random

from folioforge.llm import mixing
from folioforge.llm.q_mixing import SQL, op9_mix_sources

from .oracle import both


def filled(sizes, share=1.5, most=2, weights=(5, 2, 1)):
    """Reshare the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {n: weights[i % 3] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(w[n] for n in open_)
        over = {n for n in open_ if left * w[n] / total > most * sizes[n]}
        if not over:
            target |= {n: left * w[n] / total for n in open_}
            break
        target |= {n: float(most * sizes[n]) for n in over}
        left -= sum(most * sizes[n] for n in over)
        open_ -= over
    return target


def test_targets_equal_resharing(spark):
    r = random.Random(2)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{i}": r.choice([0, 1, 10, 500, r.randrange(1, 10**6)]) for i in range(n)}
        if n > 2:
            sizes[None] = 77
        got = {x.source: x.target for x in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = filled(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) <= 1e-6 * max(1, want[k]) for k in want), (got, want)


def test_query_equals_its_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        mine, other = both(spark, op9_mix_sources, SQL, f"/root/testdata/{sf}")
        assert mine == other and len(mine) > 0


def test_laws_and_edge_rows(spark, tmp_path):
    r = random.Random(4)
    rows = [(i, " ".join("w" * r.randrange(1, 4) for _ in range(r.randrange(0, 60))), r.choice(["hot"] * 9 + ["b", "c", None]), i) for i in range(800)]
    rows += [(None, "a b c", "b", 1), (5, None, "hot", 1), (6, "", "only-empty", 1), (7, "one", "c", 1), (7, "one", "c", 1), (8, "x" * 90_000, "c", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    one = [tuple(x) for x in op9_mix_sources(spark, str(tmp_path)).collect()]
    assert sorted(map(str, one)) == sorted(str(tuple(x)) for x in op9_mix_sources(spark, str(tmp_path)).collect())
    assert len(one) == len(rows)
    taken = {}
    for _, size, source_size, target, t in one:
        assert 0 <= t <= 2 * size
        taken[(source_size, target)] = taken.get((source_size, target), 0) + t
    for (source_size, target), t in taken.items():
        assert t == round(target) and target <= 2 * source_size


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op9_mix_sources(spark, str(tmp_path)).collect() == []
