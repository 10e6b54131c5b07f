"""Inputs that queries share, for Spark and for SQL.

`documents` has no paper structure, so papers() derives a paper-like text from
each row by one deterministic expression; pairs() derives blocks with drafts of
a translation that show every kind of defect. Both hold the whole text of a row
and are rendered from one definition for either engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import lines
from ..functions.dialect import DUCK, SPARK, Dialect, columns_of
from ..operators import segment

NL = "\n"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The line below the title, in parts: authors, affiliations, addresses.
AUTHORS = (
    "'Ann Author'",
    "CASE WHEN doc_id % 3 = 0 THEN ', Cy Third' ELSE '' END",
    "' and Bo Writer'",
    "CASE doc_id % 4 WHEN 0 THEN ' 1 CMU, Some City 2 Other Lab ' WHEN 1 THEN ' University of Tests ' WHEN 2 THEN ' SMU MPI ' ELSE ', ' END",
    "concat('ann', doc_id, '@example.org')",
    "CASE WHEN doc_id % 5 = 0 THEN ' bo@example.org' ELSE '' END",
)


def paper_text(d: Dialect) -> str:
    """The whole text, with its own lines, is the body of the paper."""
    t = d.text
    parts = [
        "concat('What is topic ', doc_id, '?')",
        f"concat({', '.join(AUTHORS)})",
        "CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE '[.]' END",
        "'v'",
        "CASE WHEN doc_id % 10 = 9 THEN 'Summary' ELSE 'Abstract' END",
        "concat(text, ' cut in the mid-')",
        "'dle of a word and goes on'",
        "concat('with document ', doc_id, ' at its end.')",
        f"CASE WHEN doc_id % 7 = 0 THEN {t(' padded text​ with\ttabs\fand a form feed')} ELSE 'plain words follow here' END",
        "''",
        f"CASE WHEN doc_id % 4 = 0 THEN {t('1' + NL + NL + 'Introduction')} ELSE '1 Introduction' END",
        "'We study politically sensitive prompts and prompt injection attacks with LLMs and GPT-4o models'",
        "''",
        "'*Equal contribution'",
        "''",
        "'and the text continues after the note for a while.'",
        "concat('Figure ', doc_id % 5 + 1, ': Left: an overview of the')",
        "CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'whole pipeline with Right: the parts' END",
        "'lowercase line that may continue the caption. but Left: this is prose'",
        "'Prose after the figure is a paragraph,'",
        "'and it has two lines.'",
        "concat('Table ', doc_id % 3 + 1, ': Counts per source')",
        "concat('a | ', doc_id, ' | 3')",
        "concat('E = m * c^', doc_id % 4)",
        "'x <= y + z'",
        "'```'",
        "'    code = 1'",
        "'```'",
        "concat('12 34 56.5 ', doc_id % 100, '%')",
        "'## 2.1 Method'",
        "'A University of the North (UN) and Prompt Injection Attacks (PIAS) are used.'",
        "concat('See https://example.org/p/', doc_id, ' and `code span` or $a+b$ for more: 2019')",
        "'B Appendix Details'",
        "CASE WHEN doc_id % 6 = 0 THEN 'Notes' ELSE 'References' END",
        "'[1] A. Smith. A study of large models. In Proceedings, 2019.'",
        "'B. Jones and C. Doe. Another study of models.'",
        "'Journal of Tests, 2020a.'",
        "'continued reference text without a year.'",
        "'C. Brown. Third study. 2021.'",
    ]
    return f"concat_ws({t(NL)}, {', '.join(parts)})"


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text)"""
    return read(spark, sf_dir, "documents").selectExpr("doc_id", f"{paper_text(SPARK)} AS text")


PAPERS = f"papers AS (SELECT doc_id, {paper_text(DUCK)} AS text FROM documents)"


def paper_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, line): lines of the cleaned text, counted from 1."""
    return segment.lines_of(papers(spark, sf_dir))


#: Lines of papers (doc_id, text).
LINES_OF = (
    f"clean AS (SELECT doc_id, {lines.clean_text(DUCK)} AS text FROM papers), "
    f"lines AS (SELECT doc_id, line_no, {DUCK.rstrip('line')} AS line FROM (SELECT doc_id, CAST(unnest(range(1, len(a) + 1)) AS BIGINT) AS line_no, unnest(a) AS line FROM (SELECT doc_id, string_split(text, {DUCK.text(NL)}) AS a FROM clean)))"
)
LINES = f"{PAPERS}, {LINES_OF}"


def prose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, line, previous, gap, before_abstract, in_references) of the lines that are not blank."""
    return segment.prose_of(paper_lines(spark, sf_dir))


PROSE = f"{LINES}, prose AS (SELECT {lines.flagged(DUCK)} FROM lines WHERE {DUCK.strip('line')} <> '')"


def pair_columns(d: Dialect) -> str:
    t = d.text
    k, h, v = "doc_id % 16", f"{d.idiv('doc_id', '16')} % 7", f"{d.idiv('doc_id', '2')} % 14"
    kind = f"CASE WHEN {k} < 4 THEN 'heading' WHEN {k} = 4 THEN 'figure' WHEN {k} = 5 THEN 'table' WHEN {k} = 6 THEN 'equation' WHEN {k} = 7 THEN 'code' WHEN {k} = 8 THEN 'reference' WHEN {k} = 9 THEN 'unknown' ELSE 'paragraph' END"
    heads = ("'Introduction'", "'Appendix B: Discussion'", "'3.1 Conclusion'", "'References'", "'2.1 X'", "concat('Topic ', doc_id, '?')", "'C Discussion'")
    head = f"CASE {h} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(heads[:-1])) + f" ELSE {heads[-1]} END"
    body = "CASE WHEN doc_id % 9 = 0 THEN concat('User {v1} ', text) WHEN doc_id % 9 = 1 THEN concat('{ v 1 } and {v2}: ', text) ELSE text END"
    source = f"CASE WHEN {k} < 4 THEN {head} WHEN {k} = 9 THEN '*Equal contribution' ELSE {body} END"
    drafts = (
        "''",
        t("[TRANSLATION_ERROR:b1] 部分文字"),
        t("§PROTECTED_0§ 與 §PROTECTED_1§ 文字"),
        t("導論：已完成的翻譯。"),
        t("以下是翻譯：這是內容，沒有結尾"),
        f"repeat({t('這是一個完整的句子。')}, CAST(14 + {d.idiv('length(text)', '30')} AS INT))",
        f"concat(repeat({t('文字 ')}, 40), '(')",
        f"concat({t('結果 ')}, text)",
        f"repeat({t('重複的一行' + NL)}, 4)",
        f"repeat({t('長文。')}, 700)",
        t("Rules: 翻譯"),
        t("{v1} 保留 {v 開放"),
        t("{v2} {v1} 中文 some foreign english words here"),
        t("很抱歉，我無法提供這個翻譯。<think>"),
    )
    draft = f"CASE {v} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(drafts[:-1])) + f" ELSE {drafts[-1]} END"
    section = "CASE doc_id % 5 WHEN 0 THEN 'title' WHEN 1 THEN 'abstract' WHEN 2 THEN '2.1' WHEN 3 THEN NULL ELSE '3.2.1' END"
    repaired = f"CASE WHEN doc_id % 11 = 0 THEN {t('已修復的翻譯文字。')} END"
    return f"doc_id, {kind} AS kind, {section} AS section, {source} AS source, {draft} AS translated, {repaired} AS repaired"


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, kind, section, source, translated, repaired)"""
    return read(spark, sf_dir, "documents").selectExpr(*columns_of(pair_columns(SPARK)))


PAIRS = f"pairs AS (SELECT {pair_columns(DUCK)} FROM documents)"
