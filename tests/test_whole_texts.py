from folioforge.plans import bases, catalog


def documents(spark, tmp_path, text):
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_papers_hold_the_whole_text(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(300)) + "\nA line of its own near the end.\nlast words"
    d = documents(spark, tmp_path, text)
    paper = bases.papers(spark, d).first().text
    assert text in paper and "A line of its own near the end." in paper.split("\n")
    assert bases.papers(spark, d).where("text LIKE '%## 2.1 Method%'").count() == 1


def test_queries_without_sql_see_the_whole_text(spark, tmp_path):
    short, long = ("words of a paper without an end " * n for n in (4, 400))
    seen = []
    for k, text in enumerate((short, long)):
        d = documents(spark, tmp_path / str(k), text)
        rows = catalog.queries()["x13_block_pipeline"](spark, d).where("kind = 'paragraph'").collect()
        seen.append((rows[0].n_chars, catalog.queries()["e09_repair_interrupted_prose"](spark, d).first().text_hash))
    assert seen[1][0] - seen[0][0] > 10_000 and seen[0][1] != seen[1][1]
