"""Queries of operators made of others: resume, repair modes, validated calls, page runs."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import assembly, lines, repair, translation, validation
from ..functions.dialect import DUCK
from ..operators import crops, english_repair, glossary, layout, pipeline, planning, providers, runs, segment
from ..operators.template import Operator
from ..sources.shared import fresh_path
from . import bases, block_queries, relational_queries

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def add(key, operator, ctes, select=None, **inputs):
    block_queries.add(key, operator, ctes, select, **inputs)
    QUERIES[key] = block_queries.QUERIES.pop(key)
    ORACLES[key] = block_queries.ORACLES.pop(key)


# Whole blocks translated by a provider that says how many glossary terms came with each chunk.
def _counted(text: str, prompt: str) -> str:
    return f"譯{prompt.split('Passage: ')[0].count(' => ')}：{text}"


_blocks = lambda s, d: bases.pairs(s, d).selectExpr("doc_id", "concat('b', doc_id) AS block_id", "kind", "section", "source", "translated")


def _translated(spark: SparkSession, sf_dir: str, resume: bool) -> DataFrame:
    rows = _blocks(spark, sf_dir)
    terms = glossary.build(spark, lines=segment.lines_of(rows.selectExpr("doc_id", "source AS text")))
    stored = rows.select("doc_id", "block_id", "translated") if resume else None
    done = pipeline.translated_blocks(rows.drop("translated"), lambda: providers.RuleProvider(guided=_counted), fresh_path(spark, "translated"), stored, terms)
    return done.select("doc_id", "kind", F.md5("translated").alias("text_hash"))


def x03_translate_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All blocks: spans masked, long texts in chunks, each chunk with its glossary terms, answers put together."""
    return _translated(spark, sf_dir, False)


def x04_translate_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that goes on: complete drafts stay, the others are asked for."""
    return _translated(spark, sf_dir, True)


def _translated_sql(resume: bool) -> str:
    d = DUCK
    whole = f"({d.strip('translated')} <> '' AND NOT {translation.is_truncated(d, 'source', 'translated', 'kind')})"
    entries = glossary.build.sql()
    entries = entries[len("WITH ") : block_queries._last_select(entries)]
    return (
        f"WITH {bases.PAIRS}, papers AS (SELECT doc_id, source AS text FROM pairs), {bases.LINES_OF}, {entries},"
        " g AS (SELECT doc_id, list(lower(term)) AS ts FROM entries GROUP BY doc_id),"
        f" m AS (SELECT p.*, {translation.masked(d, 'source')} AS masked, {translation.protected_spans(d, 'source')} AS spans, coalesce(ts, CAST([] AS VARCHAR[])) AS ts FROM pairs p LEFT JOIN g ON g.doc_id = p.doc_id),"
        f" cut AS (SELECT *, {planning.packed(d, 'masked')} AS c FROM m),"
        " told AS (SELECT *, list_transform(c, lambda x: concat('譯', least(8, len(list_filter(ts, lambda t: contains(lower(x), t)))), '：', x)) AS a FROM cut),"
        f" joined AS (SELECT *, {translation.response_chunk(d, 'kind', 'a')} AS said FROM told)"
        f" SELECT doc_id, kind, md5(CASE WHEN NOT {d.in_('kind', translation.TRANSLATABLE)} THEN source {f'WHEN {whole} THEN translated' if resume else ''} ELSE {translation.restored(d, 'said', 'spans')} END) AS text_hash FROM joined"
    )


def x05_repair_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspicious drafts are asked for again, the others stay."""
    done = pipeline.repaired_blocks(_blocks(spark, sf_dir), lambda: providers.RuleProvider(lambda t: "修：" + t), fresh_path(spark, "repaired"))
    return done.select("doc_id", "suspicious", F.md5("translated").alias("text_hash"))


QUERIES |= {f.__name__: f for f in (x03_translate_blocks, x04_translate_resume, x05_repair_blocks)}
ORACLES |= {
    "x03_translate_blocks": _translated_sql(False),
    "x04_translate_resume": _translated_sql(True),
    "x05_repair_blocks": f"WITH {bases.PAIRS} SELECT doc_id, suspicious, md5(CASE WHEN suspicious THEN concat('修：', source) ELSE translated END) AS text_hash FROM (SELECT *, {translation.is_suspicious(DUCK, 'source', 'translated', 'kind')} AS suspicious FROM pairs)",
}


# English repair: papers with every line a block of its own.
def _spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bases.papers(spark, sf_dir).select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))


def e09_repair_interrupted_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(spark, sf_dir).select("doc_id", F.md5(english_repair.repair(F.col("text"))).alias("text_hash"))


def x06_hybrid_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both modes of the English repair: interrupted prose put together and what still looks broken asked for; all blocks but headings asked for."""
    out = []
    for mode in ("hybrid", "full"):
        rows = pipeline.repaired_english(_spread(spark, sf_dir), lambda: providers.RuleProvider(lambda t: "mended: " + t), fresh_path(spark, "english"), mode)
        joined = F.expr("array_join(transform(array_sort(collect_list(struct(place, block))), e -> e.block), '\n\n')")
        out.append(rows.groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.count_if("asked").alias("n_asked"), F.md5(joined).alias("text_hash")).withColumn("mode", F.lit(mode)))
    return out[0].unionByName(out[1])


def _repaired_sql() -> str:
    """CTEs spread (doc_id, text) and mended (doc_id, text): the scan of the prose repair, a step a row."""
    d = DUCK
    nl = d.text(chr(10))
    strip = lambda x: d.strip(x, " \t\n\r\x0b\x0c\u00a0")
    cut = d.filter(d.map(d.split("text", chr(10) * 2), "b", strip("b")), "b", "b <> ''")
    kind = lambda x: f"({repair.kind(d, x)})"
    merge = lambda a, b: f"CASE WHEN {d.ends(a, '-')} AND {d.lower_start(b)} THEN concat(left({a}, -1), {b}) ELSE concat({a}, ' ', {b}) END"
    panels = lambda x: d.any_of(x, lines.PANELS)
    open_ = f"x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL AND {kind('x')} NOT IN ('heading', 'caption')"
    note = f"({open_} AND {kind('y')} = 'metadata' AND {repair.can_merge(d, 'x', 'z')})"
    caption = f"{open_} AND {kind('y')} = 'caption' AND NOT {d.rx('x', '[.!?:]$')}"
    mixed = f"({caption} AND {panels('z')} AND {d.rx('z', repair.MIXED)})"
    apart = f"({caption} AND w IS NOT NULL AND {d.lower_start('z')} AND {panels('z')} AND {kind('z')} <> 'caption' AND {kind('w')} <> 'metadata')"
    part = lambda k: strip(d.extract("z", repair.MIXED, k))
    step = (
        "SELECT doc_id, i, n, now, x, CASE WHEN now IS NOT NULL THEN CASE WHEN x IS NOT NULL AND "
        f"{repair.can_merge(d, 'now', 'x')} THEN 'on' ELSE 'end' END WHEN {note} THEN 'note' WHEN {mixed} THEN 'mixed' WHEN {apart} THEN 'apart' ELSE 'new' END AS rule, y, z, w"
        " FROM (SELECT r.doc_id, r.i, r.n, r.now, bs[r.i] AS x, bs[r.i + 1] AS y, bs[r.i + 2] AS z, bs[r.i + 3] AS w FROM run r JOIN cut ON cut.doc_id = r.doc_id WHERE r.i <= len(bs) OR r.now IS NOT NULL)"
    )
    return (
        f"{bases.PAPERS}, spread AS (SELECT doc_id, replace(text, {nl}, {d.text(chr(10) * 2)}) AS text FROM papers), cut AS (SELECT doc_id, {cut} AS bs FROM spread),"
        " run AS (SELECT doc_id, 1 AS i, 0 AS n, CAST(NULL AS VARCHAR) AS now, CAST([] AS VARCHAR[]) AS done FROM cut UNION ALL"
        " SELECT doc_id, i + CASE rule WHEN 'end' THEN 0 WHEN 'note' THEN 3 WHEN 'mixed' THEN 3 WHEN 'apart' THEN 4 ELSE 1 END, n + 1,"
        f" CASE rule WHEN 'on' THEN {merge('now', 'x')} WHEN 'new' THEN x END,"
        f" CASE rule WHEN 'end' THEN [now] WHEN 'note' THEN [{merge('x', 'z')}, y] WHEN 'mixed' THEN [{merge('x', part(2))}, {merge('y', part(1))}] WHEN 'apart' THEN [{merge('x', 'w')}, {merge('y', 'z')}] ELSE CAST([] AS VARCHAR[]) END"
        f" FROM ({step})),"
        f" told AS (SELECT doc_id, n, k, {strip(repair.tidy(d, 'b'))} AS b FROM (SELECT doc_id, n, unnest(done) AS b, unnest(range(len(done))) AS k FROM run)),"
        f" mended AS (SELECT doc_id, concat(string_agg(b, {d.text(chr(10) * 2)} ORDER BY n, k), {nl}) AS text FROM told GROUP BY doc_id)"
    )


def _hybrid_sql() -> str:
    d = DUCK
    nl = d.text(chr(10) * 2)
    mode = lambda name, table, test: (
        f"SELECT doc_id, count(*) AS n_blocks, count(*) FILTER (asked) AS n_asked, md5(string_agg(CASE WHEN asked THEN concat('mended: ', block) ELSE block END, {nl} ORDER BY place)) AS text_hash, '{name}' AS mode"
        f" FROM (SELECT *, {test} AS asked FROM (SELECT doc_id, unnest(bs) AS block, unnest(range(len(bs))) AS place FROM (SELECT doc_id, {repair.blocks(d, 'text')} AS bs FROM {table}))) GROUP BY doc_id"
    )
    return f"WITH RECURSIVE {_repaired_sql()} {mode('hybrid', 'mended', repair.is_suspicious(d, 'block'))} UNION ALL {mode('full', 'spread', "NOT " + repair.is_heading(d, "block"))}"


QUERIES |= {"e09_repair_interrupted_prose": e09_repair_interrupted_prose, "x06_hybrid_repair": x06_hybrid_repair}
ORACLES |= {"e09_repair_interrupted_prose": f"WITH RECURSIVE {_repaired_sql()} SELECT doc_id, md5(text) AS text_hash FROM mended", "x06_hybrid_repair": _hybrid_sql()}

add(
    "x07_repair_prompt",
    Operator(lambda d: f"SELECT doc_id, line_no, concat_ws({d.text(chr(10))}, 'Mend what extraction broke, change nothing else.', concat('Kind: ', {repair.kind(d, 'line')}), concat('Text: ', line)) AS prompt FROM @prose@ WHERE {repair.is_suspicious(d, 'line')}"),
    bases.PROSE,
    {"doc_id": lambda d: "doc_id", "line_no": lambda d: "line_no", "prompt_hash": lambda d: "md5(prompt)"},
    prose=bases.prose_lines,
)


def _validated(d) -> str:
    """A stored draft if it is valid, else an answer by rule if that is, else the source."""
    answer = "concat('譯：', source)"
    if d.name == "spark":  # the words of the source are made once for both
        reason = lambda t: validation.reason(d, "source", t, source_words="ws")
        return (
            f"SELECT doc_id, CASE WHEN stored_reason = 'ok' THEN 'stored' WHEN answer_reason = 'ok' THEN 'answer' ELSE 'source' END AS came_from, stored_reason, answer_reason"
            f" FROM (SELECT doc_id, {reason('translated')} AS stored_reason, {reason(answer)} AS answer_reason FROM (SELECT *, {validation.lowercase_words(d, 'source')} AS ws FROM @pairs@))"
        )
    return (
        f"SELECT doc_id, CASE WHEN stored_reason = 'ok' THEN 'stored' WHEN answer_reason = 'ok' THEN 'answer' ELSE 'source' END AS came_from, stored_reason, answer_reason"
        f" FROM (SELECT doc_id, {validation.reason(d, 'source', 'translated')} AS stored_reason, {validation.reason(d, 'source', answer)} AS answer_reason FROM @pairs@)"
    )


add("x10_validated_translate", Operator(_validated), bases.PAIRS, pairs=bases.pairs)

# A run of pages: what is pending is done by rule, then the whole paper is summed up.
add(
    "x11_page_run",
    Operator(
        lambda d: f"WITH {runs.records(d)}, todo AS (SELECT w.paper_id, w.page FROM @wanted@ w WHERE w.page % 10 <> 7 AND NOT EXISTS (SELECT 1 FROM records r WHERE r.paper_id = w.paper_id AND r.page = w.page AND r.made)),"
        " after AS (SELECT paper_id, page, status FROM records WHERE made UNION ALL SELECT paper_id, page, CASE WHEN page % 5 = 0 THEN 'failed_hard_source_passthrough' ELSE 'pass' END FROM todo)"
        " SELECT w.paper_id, count(*) AS pages, count(CASE WHEN a.status = 'pass' THEN 1 END) AS passed, count(CASE WHEN a.status = 'degraded_pass' THEN 1 END) AS degraded, count(CASE WHEN a.status = 'failed_hard_source_passthrough' THEN 1 END) AS failed, count(CASE WHEN a.page IS NULL THEN 1 END) AS not_run FROM @wanted@ w LEFT JOIN after a ON a.paper_id = w.paper_id AND a.page = w.page GROUP BY w.paper_id"
    ),
    relational_queries.STOPPED,
    attempts=relational_queries.stopped,
    wanted=relational_queries.wanted,
)


def _merged(d) -> str:
    order = "array_join(transform(array_sort(collect_list(struct(w.page, CASE WHEN r.made THEN 'T' ELSE 'O' END AS s))), e -> e.s), '')" if d.name == "spark" else "string_agg(CASE WHEN r.made THEN 'T' ELSE 'O' END, '' ORDER BY w.page)"
    return f"WITH {runs.records(d)} SELECT w.paper_id, {order} AS pages FROM @wanted@ w LEFT JOIN records r ON r.paper_id = w.paper_id AND r.page = w.page GROUP BY w.paper_id"


add("a16_merge_plan", Operator(_merged), relational_queries.STOPPED, attempts=relational_queries.stopped, wanted=relational_queries.wanted)
add("a14_artifact_paths", Operator(lambda d: "SELECT DISTINCT paper_id, concat('outputs/', paper_id, '/work/blocks') AS blocks, concat('outputs/', paper_id, '/work/translated') AS translated, concat('outputs/', paper_id, '/', paper_id, '.md') AS document FROM @wanted@"), relational_queries.ATTEMPTS, wanted=relational_queries.wanted)
add("g06_required_keys", Operator(lambda d: "SELECT kind, count(*) AS n, count(section) AS with_section, count(repaired) AS with_repaired FROM @pairs@ GROUP BY kind"), bases.PAIRS, pairs=bases.pairs)
add("g04_words_except_allowed", Operator(lambda d: f"SELECT kind, word, count(*) AS n FROM (SELECT kind, {'explode' if d.name == 'spark' else 'unnest'}({validation.suspicious_words(d, 'source', 'translated')}) AS word FROM @pairs@) GROUP BY kind, word"), bases.PAIRS, pairs=bases.pairs)
add("d14_distinct_line_ratio", Operator(lambda d: f"SELECT doc_id, round({d.double(d.size(d.distinct(assembly.lines_of(d, 'text'))))} / greatest(1, {d.size(assembly.lines_of(d, 'text'))}), 6) AS ratio FROM @documents@"), "", documents=lambda s, d: bases.read(s, d, "documents"))


def i03_bisected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that a provider refuses, and how many of their neighbours kept their answers: requests are halved until single texts remain."""
    rows = bases.pairs(spark, sf_dir).selectExpr("kind", "doc_id", "source")
    got = providers.call(rows, lambda: providers.RuleProvider(poison="{v1}"), "doc_id", "source").withColumn("doc_id", F.col("id").cast("bigint"))
    return rows.join(got, "doc_id").groupBy("kind").agg(F.count("*").alias("n"), F.count_if(F.col("answer").startswith("[TRANSLATION_ERROR:")).alias("failed"))


def i02_retried_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider whose first two calls in each task fail: the third try has all answers."""
    got = providers.call(bases.pairs(spark, sf_dir).select("doc_id", "source"), lambda: providers.RuleProvider(flaky=2), "doc_id", "source")
    return got.select(F.col("id").cast("bigint").alias("doc_id"), F.md5("answer").alias("answer_hash"))


def i04_degraded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refused text degrades its own row to the source and no other."""
    rows = bases.pairs(spark, sf_dir).selectExpr("CAST(doc_id AS STRING) AS id", "kind", "source")
    got = rows.join(providers.call(rows, lambda: providers.RuleProvider(poison="{v1}"), "id", "source"), "id")
    failed = F.col("answer") == F.concat(F.lit("[TRANSLATION_ERROR:"), "id", F.lit("]"))
    return got.select(F.col("id").cast("bigint").alias("doc_id"), failed.alias("degraded"), F.md5(F.when(failed, F.col("source")).otherwise(F.col("answer"))).alias("text_hash"))


def _twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A run that some texts are refused in, then a run of another provider with the same store."""
    rows, store = bases.pairs(spark, sf_dir).select("doc_id", "source"), fresh_path(spark, "store")
    providers.answered(rows, lambda: providers.RuleProvider(poison="{v1}"), "doc_id", "source", store)
    return providers.answered(rows, lambda: providers.RuleProvider(lambda t: "再：" + t), "doc_id", "source", store), store


def i05_resumed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first run had stays, only what failed is asked again."""
    return _twice(spark, sf_dir)[0].select(F.col("id").cast("bigint").alias("doc_id"), F.md5("answer").alias("answer_hash"))


def i06_batch_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the store holds after both runs: a row for each different text, another for each that failed first."""
    store = spark.read.schema("key string, answer string, failed boolean").parquet(_twice(spark, sf_dir)[1])
    return store.groupBy("failed").agg(F.count("*").alias("n"), F.countDistinct("key").alias("n_keys"))


QUERIES |= {f.__name__: f for f in (i02_retried_requests, i04_degraded_rows, i05_resumed_answers, i06_batch_checkpoints)}
ORACLES |= {
    "i02_retried_requests": f"WITH {bases.PAIRS} SELECT doc_id, md5(concat('譯：', source)) AS answer_hash FROM pairs",
    "i04_degraded_rows": f"WITH {bases.PAIRS} SELECT doc_id, contains(source, '{{v1}}') AS degraded, md5(CASE WHEN contains(source, '{{v1}}') THEN source ELSE concat('譯：', source) END) AS text_hash FROM pairs",
    "i05_resumed_answers": f"WITH {bases.PAIRS} SELECT doc_id, md5(concat(CASE WHEN contains(source, '{{v1}}') THEN '再：' ELSE '譯：' END, source)) AS answer_hash FROM pairs",
    "i06_batch_checkpoints": f"WITH {bases.PAIRS} SELECT failed, count(*) AS n, count(*) AS n_keys FROM (SELECT DISTINCT source, unnest([false, true]) AS failed FROM pairs) WHERE NOT failed OR contains(source, '{{v1}}') GROUP BY failed",
}


def a17_crop_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops of all captions by a renderer that draws blank images: their sizes, as the files say."""
    boxes = layout.crops()(spark, boxes=relational_queries.boxes(spark, sf_dir))
    files = crops.render_crops(boxes.select(F.col("box_id").alias("id"), F.lit(b"").alias("content"), "page", "x0", "y0", "x1", "y1"), crops.BlankRenderer)
    number = lambda at: F.conv(F.hex(F.substring("png", at, 4)), 16, 10).cast("bigint")
    return files.select(F.col("id").alias("box_id"), number(17).alias("width"), number(21).alias("height"))


def _thin(content: bytes) -> None:
    if content.endswith(b"3"):
        raise ValueError("this font cannot be made smaller")


def x12_optional_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step on the file that fails for some: their crops come all the same."""
    boxes = layout.crops()(spark, boxes=relational_queries.boxes(spark, sf_dir))
    files = crops.render_crops(boxes.select(F.col("box_id").alias("id"), F.col("box_id").cast("string").cast("binary").alias("content"), "page", "x0", "y0", "x1", "y1"), crops.BlankRenderer, optional=_thin)
    return files.select(F.col("id").alias("box_id"), "whole", F.length("png").cast("bigint").alias("n_bytes")).where("n_bytes > 0").drop("n_bytes")


_CROPS = layout.crops().sql()
_CROPS = f"WITH {relational_queries.BOXES}, {_CROPS[len('WITH ') : block_queries._last_select(_CROPS)]}, made AS ({_CROPS[block_queries._last_select(_CROPS) :]})"
QUERIES |= {"a17_crop_files": a17_crop_files, "x12_optional_step": x12_optional_step}
ORACLES |= {
    "a17_crop_files": f"{_CROPS} SELECT box_id, CAST(greatest(1, (x1 - x0) * 2) AS BIGINT) AS width, CAST(greatest(1, (y1 - y0) * 2) AS BIGINT) AS height FROM made",
    "x12_optional_step": f"{_CROPS} SELECT box_id, box_id % 10 <> 3 AS whole FROM made",
}

QUERIES["i03_bisected_requests"] = i03_bisected_requests
ORACLES["i03_bisected_requests"] = f"WITH {bases.PAIRS} SELECT kind, count(*) AS n, count(*) FILTER (contains(source, '{{v1}}')) AS failed FROM pairs GROUP BY kind"


def _guided(text: str, prompt: str) -> str:
    """The rule, and the glossary's translations put in as the prompt asks."""
    for line in prompt.split("Passage: ")[0].split("\n"):
        term, arrow, use = line.removeprefix("- ").partition(" => ")
        if arrow and use not in ("preserve English", "prefer consistent translation"):
            text = re.sub(re.escape(term), lambda _, u=use: u, text, flags=re.I)
    return "譯：" + text


def x13_block_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all papers in two candidates with a provider by rule: count and characters of the blocks by kind, of the sources chosen, the glossary's terms by policy and both documents."""
    papers = bases.papers(spark, sf_dir)
    wrapped = "concat('# Source Extracted Text\\n\\nSource PDF: a\\n\\n## Extracted Content\\n\\n', text)"
    broken = "CASE WHEN doc_id % 2 = 0 THEN replace(text, 'Abstract', '(cid:1)') ELSE text END"
    candidates = papers.selectExpr("doc_id", "'converted' AS name", "1 AS priority", "text AS raw").unionByName(papers.selectExpr("doc_id", "'extracted' AS name", "0 AS priority", f"{broken.replace('ELSE text', f'ELSE {wrapped}')} AS raw"))
    out = pipeline.run_papers(candidates, lambda: providers.RuleProvider(guided=_guided), fresh_path(spark, "papers"), repaired_input=True)
    parts = [
        out["final"].select("kind", F.col("translated").alias("t"), "suspicious"),
        out["best"].select(F.concat(F.lit("source: "), "name").alias("kind"), F.col("text").alias("t"), F.lit(False).alias("suspicious")),
        out["glossary"].select(F.concat(F.lit("glossary: "), "policy").alias("kind"), F.col("term").alias("t"), F.lit(False).alias("suspicious")),
        *[out[k].select(F.lit(k).alias("kind"), F.col("document").alias("t"), F.lit(False).alias("suspicious")) for k in ("archival", "study")],
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("n_chars"), F.count_if("suspicious").alias("suspicious"))


QUERIES["x13_block_pipeline"] = x13_block_pipeline
