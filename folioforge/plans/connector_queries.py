"""Queries of sources, sinks, providers and the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import DUCK, SPARK, columns_of
from ..operators import english_repair, glossary, providers
from ..sources import jsonl, pdf
from ..sources.shared import fresh_path
from ..streaming import events as stream
from . import bases, relational_queries

_BLOCKS = lambda d: "doc_id, concat('b', doc_id) AS block_id, kind AS type, section, source, translated, repaired"


def a07_jsonl_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written as JSON lines and read strictly."""
    rows = bases.pairs(spark, sf_dir).selectExpr(*columns_of(_BLOCKS(SPARK))).withColumn("meta", F.struct(F.lit(1).cast("bigint").alias("line_start"), F.col("doc_id").alias("line_end")))
    path = jsonl.write_blocks(rows, fresh_path(spark, "blocks"))
    return jsonl.read_blocks(spark, path).select("doc_id", "block_id", "type", "section", F.md5("source").alias("source_hash"), F.col("meta.line_end").alias("line_end"))


def a08_lenient_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of which some are broken, read leniently: broken ones are kept as text."""
    line = F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit('{"doc_id": '), "doc_id", F.lit(', "type'))).otherwise(F.to_json(F.struct("doc_id", F.col("kind").alias("type"))))
    path = fresh_path(spark, "lines")
    bases.pairs(spark, sf_dir).select(line.alias("value")).write.text(path)
    return jsonl.read_blocks(spark, path, strict=False).groupBy("type").agg(F.count("*").alias("n"), F.count("broken").alias("n_broken"))


def a09_glossary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = glossary.build(spark, lines=bases.paper_lines(spark, sf_dir))
    return jsonl.read_glossaries(spark, jsonl.write_glossaries(entries, fresh_path(spark, "glossary")))


def a04_markdown_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bases.papers(spark, sf_dir).select("doc_id", F.md5("text").alias("text_hash"), F.length("text").cast("long").alias("n_chars"))


#: Texts as PDF strings can hold them: what is beyond Latin-1 becomes a question mark.
_LATIN = lambda d: d.sub("text", r"[^\x00-\x{FF}]" if d.name == "duckdb" else r"[^\x00-\xFF]", "?")


def _streams(spark: SparkSession, sf_dir: str, body: str) -> DataFrame:
    """(doc_id, content): a PDF file of each text with one content stream, given over `ls`, the text's lines, and `hs`, the same in hexadecimal; and a stream with a filter that is not read."""
    rows = bases.read(spark, sf_dir, "documents").selectExpr("doc_id", f"split({_LATIN(SPARK)}, '\\n') AS ls").selectExpr("doc_id", "ls", "transform(ls, l -> concat('<', hex(encode(l, 'ISO-8859-1')), '>')) AS hs")
    file = f"concat('%PDF-1.4\\n', doc_id, ' 0 obj\\n<< /Length 9 >>\\nstream\\nBT /F1 12 Tf ', {body}, ' ET\\nendstream\\nendobj\\n2 0 obj\\n<< /Filter /DCTDecode >>\\nstream\\nBT (no) Tj ET\\nendstream\\nendobj\\n')"
    return rows.selectExpr("doc_id", f"CAST({file} AS BINARY) AS content")


_EACH = "array_join(transform(hs, (h, i) -> concat(CASE i % 3 WHEN 0 THEN concat(h, ' Tj') WHEN 1 THEN concat(h, ' \\'') ELSE concat('[', h, ' -200 (end) 5 (s)] TJ') END, ' ')), '')"


def a01_pdf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of PDF files, one of each document's whole text, a line of it a line of the page."""
    made = _streams(spark, sf_dir, "array_join(transform(hs, h -> concat(h, ' Tj T* ')), '')")
    return pdf.extract(made, "doc_id", "content").select(F.col("id").alias("doc_id"), F.md5("text").alias("text_hash"), F.length("text").cast("long").alias("n_chars"))


def a02_pdf_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the same kind of files, by kind."""
    return pdf.count_tokens(_streams(spark, sf_dir, _EACH), "doc_id", "content").withColumnRenamed("id", "doc_id")


def a03_text_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines set by three text operators in turn: Tj goes on, ' begins a line, TJ puts a blank for a wide shift."""
    return pdf.extract(_streams(spark, sf_dir, _EACH), "doc_id", "content").select(F.col("id").alias("doc_id"), F.md5("text").alias("text_hash"))


def _page_lines(joined: str) -> str:
    """SQL of a page's text from its raw text."""
    d = DUCK
    nl = chr(10)
    line = d.strip(d.sub("l", r"[ \t\x0b\x0c\r\x1c-\x1f]+", " "), " ")
    return d.strip(d.sub(d.join(d.map(d.split(joined, nl), "l", line), nl), r"\n{3,}", nl * 2))


_LINES_LATIN = f"SELECT doc_id, string_split({_LATIN(DUCK)}, {DUCK.text(chr(10))}) AS ls FROM documents"
_SET = f"array_to_string(list_transform(ls, lambda l, i: CASE (i - 1) % 3 WHEN 0 THEN l WHEN 1 THEN concat({DUCK.text(chr(10))}, l) ELSE concat(l, ' ends') END), '')"


def a08_block_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written to a folder for each paper and read again, one of the folders' names a column."""
    rows = bases.pairs(spark, sf_dir).selectExpr(*columns_of(_BLOCKS(SPARK)), "concat('p', doc_id % 10) AS paper_id").withColumn("meta", F.struct(F.lit(1).cast("bigint").alias("line_start"), F.col("doc_id").alias("line_end")))
    path = jsonl.write_blocks(rows, fresh_path(spark, "papers"), by="paper_id")
    back = spark.read.schema(f"{jsonl.BLOCK}, paper_id STRING").json(path)
    return back.select("paper_id", "doc_id", "type", F.md5("source").alias("source_hash"), F.md5("translated").alias("translated_hash"), "repaired")


def a10_layout_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions from JSON lines, as a layout model would leave them, taken back as boxes with their numbers."""
    path = fresh_path(spark, "regions")
    found = relational_queries.regions(spark, sf_dir)
    rows = found.select(F.format_string("p%03d_r%03d", F.col("page"), F.col("det_id")).alias("region_id"), F.col("page").alias("page_index"), F.array(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")]).alias("bbox"), F.col("label").alias("layout_label"), "confidence")
    rows.write.json(path)
    back = spark.read.schema("region_id STRING, page_index BIGINT, bbox ARRAY<DOUBLE>, layout_label STRING, confidence DOUBLE").json(path)
    return back.select("region_id", "page_index", *[F.col("bbox")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))], "layout_label", "confidence")


def a18_provider_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a provider by rule that refuses some texts: neighbours of a refused text keep their answers."""
    rows = bases.pairs(spark, sf_dir).select("doc_id", "source")
    got = providers.call(rows, lambda: providers.RuleProvider(poison="Appendix"), "doc_id", "source")
    return got.select(F.col("id").cast("bigint").alias("doc_id"), F.md5("answer").alias("answer_hash"))


_CONFIG = "doc_id, CASE doc_id % 4 WHEN 0 THEN 'gemini' WHEN 1 THEN 'ollama' ELSE 'openai' END AS name, CASE WHEN doc_id % 3 = 0 THEN 'gemini-2.5-flash' ELSE 'minimax-2.7' END AS model, CASE WHEN doc_id % 5 = 0 THEN 'http://localhost:1/api/generate' ELSE 'http://localhost:1/v1/completions' END AS url"


def a19_backend_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which client serves a configuration: by name, by the model's name, by the address."""
    rows = bases.read(spark, sf_dir, "documents").selectExpr(*columns_of(_CONFIG))
    return rows.selectExpr("doc_id", f"{providers.backend_of(SPARK, 'name', 'model', 'url')} AS backend")


def h15_block_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in a fence, a block for the whole text and one for its source, taken apart; every seventh reply has no block."""
    reply = "CASE WHEN doc_id % 7 = 0 THEN text ELSE concat('```json\\n<BLOCK a', doc_id, '>\\n', text, '\\n</BLOCK a', doc_id, '>\\n<BLOCK b> ', source, ' </BLOCK b>\\n```') END AS reply"
    rows = bases.read(spark, sf_dir, "documents").selectExpr("doc_id", reply)
    return providers.parsed(rows, "doc_id", "reply").select(F.col("id").cast("bigint").alias("doc_id"), "key", F.md5("answer").alias("answer_hash"))


def c13_parse_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block marks of answers taken apart, missing keys told (a pattern with a back reference)."""
    made = bases.pairs(spark, sf_dir).select("doc_id", F.concat(F.lit("```\n<BLOCK b1> "), F.coalesce("section", F.lit("none")), F.lit(" </BLOCK b1>\n"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("<BLOCK b2>two</BLOCK b2>"), F.lit("\n```")).alias("reply"))
    found = F.regexp_extract_all("reply", F.lit(r"(?s)<BLOCK\s+([^>]+)>\s*(.*?)\s*</BLOCK\s+\1>"), F.lit(1))
    text = F.regexp_extract_all("reply", F.lit(r"(?s)<BLOCK\s+([^>]+)>\s*(.*?)\s*</BLOCK\s+\1>"), F.lit(2))
    return made.select("doc_id", F.array_join(found, ",").alias("found"), F.array_join(text, ",").alias("answers"), F.array_join(F.array_except(F.array(F.lit("b1"), F.lit("b2")), found), ",").alias("missing"))


def h20_front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors, affiliations and addresses of the paragraph below the title."""
    rows = bases.paper_lines(spark, sf_dir).where("line_no = 2").select("doc_id", english_repair.title_parts("line").alias("p"))
    return rows.select("doc_id", "p.*")


def i07_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bases.read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    return stream.counts_of(spark, rows).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


QUERIES = {
    f.__name__: f
    for f in (
        a01_pdf_text, a02_pdf_tokens, a03_text_operators, a04_markdown_scan, a07_jsonl_blocks, a08_block_sink, a08_lenient_blocks, a09_glossary_json, a10_layout_regions, a18_provider_answers, a19_backend_choice,
        c13_parse_responses, h15_block_mapping, h20_front_matter, i07_event_windows,
    )
}

def _front_sql() -> str:
    d = DUCK
    place = r"\b(?:[0-9]+\.?\s*)?(?:CMU|SMU|University|Institute|Vector|MPI|AREA|Science Park)\b"
    before = d.extract("rest", "^(.*?)" + place, 1)
    found = d.rx("rest", place)
    tail = d.strip(f"substr(rest, length({before}) + 1)", " ,")
    numbered = d.split(d.sub("tail", r"\s+([0-9]+\.?\s+)", "\x1e\\1"), "\x1e")
    plain = d.split(d.sub("tail", r"\s+((?:CMU|SMU|University|MPI|AREA)\b)", "\x1e\\1"), "\x1e")
    clean = lambda a: d.join(d.filter(d.map(a, "p", d.strip("p", " ,")), "p", "p <> ''"), ";")
    return (
        f"WITH {bases.LINES}, r AS (SELECT doc_id, {d.join(d.extract_all('line', english_repair.EMAIL), ';')} AS emails, {d.strip(d.sub('line', english_repair.EMAIL))} AS rest FROM lines WHERE line_no = 2),"
        f" p AS (SELECT *, {found} AS placed, CASE WHEN {found} THEN {before} ELSE rest END AS names, CASE WHEN {found} THEN {tail} ELSE '' END AS tail FROM r)"
        f" SELECT doc_id, {d.strip('names', ' ,')} AS authors, CASE WHEN NOT placed THEN '' WHEN {d.rx('tail', '(?:^|[ ])[0-9]+[.]?[ ]')} THEN {clean(numbered)} ELSE {clean(plain)} END AS affiliations, emails FROM p"
    )


ORACLES = {
    "a01_pdf_text": f"SELECT doc_id, md5(t) AS text_hash, length(t) AS n_chars FROM (SELECT doc_id, {_page_lines(DUCK.join('ls', chr(10)))} AS t FROM ({_LINES_LATIN}))",
    "a02_pdf_tokens": f"SELECT doc_id, CAST(len(ls) + 2 * (len(ls) // 3) AS BIGINT) AS n_strings, CAST(1 + 2 * (len(ls) // 3) AS BIGINT) AS n_numbers, CAST(len(ls) + 3 AS BIGINT) AS n_operators FROM ({_LINES_LATIN})",
    "a03_text_operators": f"SELECT doc_id, md5({_page_lines(_SET)}) AS text_hash FROM ({_LINES_LATIN})",
    "a08_block_sink": f"WITH {bases.PAIRS} SELECT concat('p', doc_id % 10) AS paper_id, doc_id, kind AS type, md5(source) AS source_hash, md5(translated) AS translated_hash, repaired FROM pairs",
    "a19_backend_choice": f"SELECT doc_id, {providers.backend_of(DUCK, 'name', 'model', 'url')} AS backend FROM (SELECT {_CONFIG} FROM documents)",
    "h15_block_mapping": f"WITH r AS (SELECT doc_id, unnest(CASE WHEN doc_id % 7 = 0 THEN [0] ELSE [1, 2] END) AS k, text, source FROM documents) SELECT doc_id, CASE k WHEN 1 THEN concat('a', doc_id) WHEN 2 THEN 'b' END AS key, md5(CASE k WHEN 1 THEN {DUCK.strip('text')} WHEN 2 THEN {DUCK.strip('source')} END) AS answer_hash FROM r",
    "a04_markdown_scan": f"WITH {bases.PAPERS} SELECT doc_id, md5(text) AS text_hash, length(text) AS n_chars FROM papers",
    "a07_jsonl_blocks": f"WITH {bases.PAIRS} SELECT doc_id, concat('b', doc_id) AS block_id, kind AS type, section, md5(source) AS source_hash, doc_id AS line_end FROM pairs",
    "a08_lenient_blocks": f"WITH {bases.PAIRS} SELECT CASE WHEN doc_id % 10 <> 3 THEN kind END AS type, count(*) AS n, count(*) FILTER (doc_id % 10 = 3) AS n_broken FROM pairs GROUP BY 1",
    "a09_glossary_json": f"WITH {bases.LINES}, {glossary.build.sql()[5:]}",
    "a10_layout_regions": f"WITH {relational_queries.BOXES} SELECT printf('p%03d_r%03d', page, det_id) AS region_id, page AS page_index, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, label AS layout_label, confidence FROM regions",
    "a18_provider_answers": f"WITH {bases.PAIRS} SELECT doc_id, md5(CASE WHEN contains(source, 'Appendix') THEN concat('[TRANSLATION_ERROR:', doc_id, ']') ELSE concat('譯：', source) END) AS answer_hash FROM pairs",
    "c13_parse_responses": f"WITH {bases.PAIRS} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'b1' ELSE 'b1,b2' END AS found, CASE WHEN doc_id % 3 = 0 THEN coalesce(section, 'none') ELSE concat(coalesce(section, 'none'), ',two') END AS answers, CASE WHEN doc_id % 3 = 0 THEN 'b2' ELSE '' END AS missing FROM pairs",
    "h20_front_matter": _front_sql(),
    "i07_event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY date_trunc('hour', ts), event_type HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE",
}
