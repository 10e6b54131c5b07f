"""Every query against its SQL, at the scale the driver uses, as the driver compares."""

import duckdb
import pytest

from folioforge.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _norm(x):
    if isinstance(x, float):
        return round(x, 9)
    return x


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    cur = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    mine = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=key)
    other = sorted((tuple(_norm(r[names.index(c)]) for c in order) for r in cur.fetchall()), key=key)
    assert len(mine) > 0
    different = [(a, b) for a, b in zip(mine, other, strict=False) if a != b]
    assert len(mine) == len(other) and not different, (name, len(mine), len(other), len(different), different[:2])
    if len(mine) > 20:  # not vacuous: booleans take both values
        for i, c in enumerate(order):
            values = {r[i] for r in mine}
            assert values != {True} and values != {False} or name in ALWAYS, (name, c, values)


#: Laws that hold for every row.
ALWAYS = {"c12_restore_spans"}


def test_every_query_is_listed():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


def test_score_report_rounds_as_its_sql(spark, tmp_path):
    # one long line each: the scores are thousandths, every tenth of them halfway between two hundredths
    rows = [(k, ("word " * 1200)[: 3000 + k]) for k in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'web' AS source", "length(text) AS n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT doc_id, order_of_sources, best FROM ({catalog.oracle_sql()['a15_score_report']})").fetchall()
    got = catalog.queries()["a15_score_report"](spark, str(tmp_path)).select("doc_id", "order_of_sources", "best").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(got) == 600
