from folioforge.operators import pipeline, providers

PAPER = "What is a topic?\n\nAnn Author\nx\nAbstract\nA para-\ngraph of the abstract with `code` in it.\n1 Introduction\nWe study prompt injection attacks.\n\nE = m * c^2\n\nFigure 1: An overview.\nReferences\nA. Smith. On things, 2019."


def test_run_papers(spark, tmp_path):
    rows = [(1, "extracted", 0, "# Source Extracted Text\n\nSource PDF: a\n\n## Extracted Content\n\n" + PAPER), (1, "converted", 1, "short"), (2, "converted", 1, PAPER), (3, "extracted", 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, name string, priority int, raw string")
    out = pipeline.run_papers(df, lambda: providers.RuleProvider(lambda t: "這是譯文：" + t + "。"), str(tmp_path / "out"))
    assert {(r.doc_id, r.name) for r in out["best"].collect()} == {(1, "extracted"), (2, "converted")}
    kinds = [r.kind for r in out["blocks"].where("doc_id = 1").orderBy("block").collect()]
    assert kinds.count("heading") == 4 and {"equation", "figure", "reference", "paragraph"} <= set(kinds)
    final = {r.source: r for r in out["final"].where("doc_id = 2").collect()}
    assert "`code`" in next(r.translated for s, r in final.items() if "code" in s)
    text = out["archival"].where("doc_id = 1").first().document
    assert "## 摘要" in text and "$$\nE = m * c^2\n$$" in text and "> [Figure] Figure 1: An overview." in text and text.index("摘要") < text.index("1 導論")
    assert {r.term for r in out["glossary"].where("doc_id = 1").collect()} >= {"prompt injection attacks"}


def test_stored_drafts_are_kept_and_failures_marked(spark, tmp_path):
    blocks = spark.createDataFrame([(1, "b1", "paragraph", "one text"), (1, "b2", "paragraph", "bad text"), (1, "b3", "code", "x = 1")], "doc_id long, block_id string, kind string, source string")
    stored = spark.createDataFrame([(1, "b1", "已完成")], "doc_id long, block_id string, translated string")
    got = pipeline.translated_blocks(blocks, lambda: providers.RuleProvider(poison="bad"), str(tmp_path / "a"), stored)
    assert {r.block_id: r.translated for r in got.collect()} == {"b1": "已完成", "b2": "[TRANSLATION_ERROR:1__b2__0]", "b3": "x = 1"}
