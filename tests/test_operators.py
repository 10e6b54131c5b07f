"""Operators on small inputs with known results."""

import pytest
from pyspark.sql import functions as F

from folioforge.functions import assembly, lines, repair, translation, validation
from folioforge.functions.dialect import SPARK, columns_of
from folioforge.operators import english_repair, planning, providers, segment
from folioforge.sources import jsonl, pdf

D = SPARK


def prose_of(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = df.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).selectExpr("doc_id", "CAST(p + 1 AS BIGINT) AS line_no", "line")
    return rows, rows.where(f"{D.strip('line')} <> ''").selectExpr(*columns_of(lines.flagged(D)))


def blocks_of(spark, text):
    rows = segment.segment(spark, prose=prose_of(spark, {1: text})[1]).orderBy("block").collect()
    return [(r.kind, r.source) for r in rows], rows


def test_caption_ends_at_a_full_stop(spark):
    got, _ = blocks_of(spark, "# Title\nFigure 1: Cases in contexts.\n\nlowercase line goes on")
    assert got == [("heading", "Title"), ("figure", "Figure 1: Cases in contexts."), ("paragraph", "lowercase line goes on")]


def test_caption_goes_on_over_a_blank_line(spark):
    got, _ = blocks_of(spark, "# Title\nFigure 1: Cases respond to\n\nlowercase rest of it")
    assert got == [("heading", "Title"), ("figure", "Figure 1: Cases respond to\nlowercase rest of it")]


def test_caption_with_panels(spark):
    got, _ = blocks_of(spark, "# Title\nSome prose that stops here.\nFigure 2: Overview\nfirst Upper Right: one Lower Right: two.\n\nAnd more prose.")
    assert [k for k, _ in got] == ["heading", "paragraph", "figure", "paragraph"]


def test_note_is_apart(spark):
    got, rows = blocks_of(spark, "*Equal contribution\n\nSome prose follows here.")
    assert [k for k, _ in got] == ["unknown", "paragraph"]
    assert [r.block_id for r in rows] == ["b000001", "b000002"]


def test_references(spark):
    got, rows = blocks_of(spark, "Abstract\nText of it.\nReferences\nA. Smith. On things.\nJournal, 2019.\nmore of it\nB. Jones. Other, 2020.")
    assert [k for k, _ in got] == ["heading", "paragraph", "heading", "reference", "reference"]
    assert {r.section for r in rows[2:]} == {"references"}


def test_lines_are_kept(spark):
    text = "Abstract\nOne line\nand another.\n\n1 Introduction\nE = m * c^2\n```\n    x = 1\n```\nTable 1: Counts\na | b\nReferences\n[1] A. B. 2019."
    _, rows = blocks_of(spark, text)
    kept = " ".join(r.source.replace("\n", " ") for r in rows).split()
    assert sorted(kept) == sorted(text.replace("\n", " ").split())
    assert [r.line_start for r in rows] == sorted(r.line_start for r in rows)


def test_cleaning(spark):
    rows, _ = prose_of(spark, {1: "A title\nx\n[.]\nAbstract\nA para-\ngraph .\n1\n\nIntroduction\n2.1\n\nMethod\nFigure 1: kept"})
    text = segment.clean_paragraphs(spark, lines=rows).first().text
    assert text == "A title\n\n## Abstract\n\nA paragraph.\n\n## 1 Introduction\n\n### 2.1 Method\n\nFigure 1: kept"


def value(spark, expression, **names):
    df = spark.createDataFrame([tuple(names.values())], ", ".join(f"{k} string" for k in names))
    return df.selectExpr(f"{expression} AS v").first().v


@pytest.mark.parametrize("line,want", [("## 1 Introduction", "heading"), ("Figure 1: a caption", "caption"), ("a@b.com", "metadata"), ("A sentence.", "paragraph")])
def test_block_kind(spark, line, want):
    assert value(spark, repair.kind(D, "x"), x=line) == want


def test_normalize(spark):
    assert value(spark, lines.normalize_whitespace(D, "x"), x="a b\r\nc​\td\fe") == "a b\nc d\n\ne"


def test_masks(spark):
    text = "See `code`, https://a.b/c and a.b@c.de for $x+y$ in GPT-4o"
    assert value(spark, translation.masked(D, "x"), x=text) == "See §PROTECTED_0§, §PROTECTED_1§ and §PROTECTED_2§ for §PROTECTED_3§ in GPT-4o"
    assert value(spark, translation.restored(D, translation.masked(D, "x"), translation.protected_spans(D, "x")), x=text) == text
    assert value(spark, translation.masked(D, "x"), x="RLHF and multi-word terms") == "RLHF and multi-word terms"


def test_truncated(spark):
    long = "This is a sentence of the source. " * 8
    expression = translation.is_truncated(D, "s", "t", "'paragraph'")
    assert value(spark, expression, s=long, t="翻譯到一半 (")
    assert not value(spark, expression, s=long, t="這是一個完整的句子。" * 12)
    assert value(spark, translation.strip_meta(D, "x"), x="以下是修復後的繁體中文翻譯：\n\n內容") == "內容"


@pytest.mark.parametrize(
    "source,out,want",
    [
        ("The term prompt stays", "保留 prompt 一詞", "ok"),
        ("See {v0} here", "見 { v0 } 處", "ok"),
        ("{v1} then {v2}", "{v2} 再 {v1}", "ok"),
        ("User {v1} asks", "很抱歉，我無法提供", "ok"),
        ("{v1} text", "文字", "placeholder_mismatch"),
        ("text", "文字 {v ", "dangling_placeholder"),
        ("text", "中文 some foreign words", "suspicious_english:foreign,some,words"),
        ("text", "", "empty_translation"),
        ("text", "<think>想</think>", "think_leak"),
        ("text", "Rules: 一", "leak_marker:Rules:"),
    ],
)
def test_validation(spark, source, out, want):
    assert value(spark, validation.reason(D, "s", "t"), s=source, t=out) == want


def test_render(spark):
    rows = [("heading", "Introduction", "1"), ("equation", "E = 1", "1"), ("figure", "Figure 1: x", "1"), ("reference", "A. B.", "references"), ("code", "x", "1")]
    df = spark.createDataFrame(rows, "k string, t string, s string")
    got = [r.v for r in df.selectExpr(f"{assembly.rendered(D, 't', 'k', 's')} AS v").collect()]
    assert got == ["## Introduction", "$$\nE = 1\n$$", "> [Figure] Figure 1: x", "- A. B.", "```\nx\n```"]
    assert value(spark, assembly.heading_text(D, "s", "t"), s="1 Introduction", t="") == "1 導論"
    assert value(spark, assembly.heading_text(D, "s", "t"), s="Appendix B: Discussion", t="") == "附錄 B：討論"


def test_packing_and_batches(spark):
    df = spark.createDataFrame([(1, "A sentence here. " * 30 + "x" * 500), (2, ""), (3, "short"), (4, None)], "doc_id long, text string")
    rows = planning.chunks(spark, texts=df).collect()
    assert max(len(r.text) for r in rows) <= 180 and {r.doc_id for r in rows} == {1, 3}
    batches = df.where("doc_id = 1").selectExpr(f"{planning.batch_numbers(D, 'array(400L, 500L, 200L, 1200L, 1L)')} AS b").first().b
    assert batches == [1, 1, 2, 3, 4]


def test_interrupted_prose():
    r = english_repair.repaired
    assert r("politically sen-\n\nsitive words") == "politically sensitive words\n"
    assert r("prose that is cut\n\n*Equal contribution\n\ngoes on here.") == "prose that is cut goes on here.\n\n*Equal contribution\n"
    assert r("prose that is cut\n\nFigure 1: Overview\n\nLeft: the parts. goes on here.") == "prose that is cut goes on here.\n\nFigure 1: Overview Left: the parts.\n"
    assert r("prose that is cut\n\nFigure 1: Overview\n\nof it Left: parts\n\ngoes on") == "prose that is cut goes on\n\nFigure 1: Overview of it Left: parts\n"
    assert r(None) == "\n" and r("# H\n\ntext") == "# H\n\ntext\n"


def test_provider_bisects_and_retries():
    p = providers.RuleProvider(poison="bad", flaky=1)
    got = providers.ask(p, {"a": "one", "b": "bad", "c": "three", "d": "four"})
    assert got == {"a": "譯：one", "b": "[TRANSLATION_ERROR:b]", "c": "譯：three", "d": "譯：four"}
    assert [len(r) for r in providers.requests([str(i) for i in range(20)], ["x" * 100] * 20, 8, 500)] == [5, 5, 5, 5]
    assert providers.parse_blocks("```\n<BLOCK a>\nx\n</BLOCK a><BLOCK b>y</BLOCK b>\n```") == {"a": "x", "b": "y"}
    with pytest.raises(providers.ProviderError):
        providers.parse_blocks("nothing")
    assert providers.backend("openai", "gemini-2.5") == "gemini" and providers.backend(url="http://h/api/generate") == "ollama"


def test_pdf():
    assert pdf.literal(rb"(Hello\040World\nLine\0502\051)", 0)[0] == "Hello World\nLine(2)"
    import zlib

    body = zlib.compress(b"BT <48656c6c6f> Tj 0 -12 Td [(wor) 20 (ld) -300 (!)] TJ ET")
    data = b"1 0 obj\n<< /Filter /FlateDecode >>\nstream\n" + body + b"\nendstream\nendobj\n2 0 obj\n<< /Filter [/LZWDecode] >>\nstream\nBT (x) Tj ET\nendstream\nendobj"
    assert pdf.text_of(data) == "Hello\nworld !"
    assert pdf.text_of(None) == "" and pdf.text_of(b"junk") == ""


def test_strict_reading_fails_on_a_missing_key(spark, tmp_path):
    spark.createDataFrame([('{"doc_id": 1, "block_id": "b1"}',)], "value string").write.text(f"{tmp_path}/x")
    with pytest.raises(Exception, match="required key"):
        jsonl.read_blocks(spark, f"{tmp_path}/x").collect()


def test_markdown_round_trip(spark, tmp_path):
    (tmp_path / "p1.md").write_text("# A\n\ntext\n")
    got = jsonl.read_markdown(spark, str(tmp_path / "p1.md")).first()
    assert (got.paper_id, got.text) == ("p1", "# A\n\ntext\n")


def test_same_result_for_any_partitions(spark):
    from folioforge.plans import catalog

    q = catalog.queries()["e04_segment_blocks"]
    out = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(str, q(spark, "/root/testdata/sf0.001").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]
