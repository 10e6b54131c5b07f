"""Queries over papers as wholes: segmentation, cleaning, scoring, assembly, planning."""

from __future__ import annotations

from functools import partial

from ..functions import lines
from ..functions.dialect import DUCK, SPARK
from ..operators import planning, segment
from . import bases

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _with(ctes: str, sql: str) -> str:
    """Put further CTEs in front of a query, which may have some of its own."""
    head = "WITH RECURSIVE " if ctes else ""
    return f"{head}{ctes}, {sql[5:]}" if sql.startswith("WITH ") and ctes else f"{head}{ctes} {sql}" if ctes else sql


def add(key: str, operator, ctes: str, select=None, **inputs) -> None:
    """inputs: name -> function (spark, sf_dir) -> DataFrame; ctes define the same names for SQL. select: columns over the result, for either dialect."""

    def run(spark, sf_dir):
        df = operator(spark, **{k: f(spark, sf_dir) for k, f in inputs.items()})
        return df.selectExpr(*[f"{f(SPARK)} AS {n}" for n, f in select.items()]) if select else df

    QUERIES[key] = run
    sql = operator.sql()
    if select:
        shown = ", ".join(f"{f(DUCK)} AS {n}" for n, f in select.items())
        at = _last_select(sql)
        sql = f"{sql[:at]} SELECT {shown} FROM ({sql[at:]})"
    ORACLES[key] = _with(ctes, sql)


def _last_select(sql: str) -> int:
    """Where the main select begins: the last one outside parentheses."""
    depth, quote, at = 0, "", 0
    for i, c in enumerate(sql):
        if quote:
            quote = "" if c == quote else quote
        elif c == "'":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif depth == 0 and sql.startswith("SELECT ", i):
            at = i
    return at


prose, PROSE = bases.prose_lines, bases.PROSE
col = lambda *names: {n: (lambda n: lambda d: n)(n) for n in names}
md5 = lambda **names: {k: (lambda x: lambda d: f"md5({x})")(x) for k, x in names.items()}
documents = lambda s, d: bases.read(s, d, "documents")

add("e04_segment_blocks", segment.segment, PROSE, {**col("doc_id", "block_id", "kind", "section", "line_start", "line_end"), **md5(source_hash="source")}, prose=prose)
add("e01_section_fill", segment.over_blocks("SELECT doc_id, block_id, section FROM blocks WHERE kind <> 'heading'"), PROSE, prose=prose)
add("e03_dense_ids", segment.over_blocks("SELECT doc_id, count(*) AS n, max(block_id) AS last_id FROM blocks GROUP BY doc_id"), PROSE, prose=prose)
add("e05_special_blocks", segment.over_blocks("SELECT doc_id, block_id, kind, source FROM blocks WHERE kind IN ('figure', 'table', 'equation', 'code')"), PROSE, prose=prose)
add("e06_reference_blocks", segment.over_blocks("SELECT doc_id, block_id, source, line_start, line_end FROM blocks WHERE kind = 'reference'"), PROSE, prose=prose)
add("d16_block_line_range", segment.over_blocks("SELECT doc_id, kind, min(line_start) AS first_line, max(line_end) AS last_line, count(*) AS n FROM blocks GROUP BY doc_id, kind"), PROSE, prose=prose)
add("d05_assembled_document", segment.assemble, PROSE, {**col("doc_id", "n_blocks"), **md5(document_hash="document")}, prose=prose)
add("e13_front_matter", segment.front_matter, PROSE, prose=prose)
add("e14_stop_at_references", segment.study_blocks, PROSE, {**col("doc_id", "block"), **md5(chunk_hash="chunk")}, prose=prose)
add("x08_study_document", segment.study_document, PROSE, {**col("doc_id", "n_blocks"), **md5(document_hash="document")}, prose=prose)

add("b02_front_matter_noise", segment.remove_noise, bases.LINES, lines=bases.paper_lines)
add("e07_join_split_headings", segment.join_headings, bases.LINES, lines=bases.paper_lines)
add("e08_reflow_paragraphs", segment.clean_paragraphs, bases.LINES, {**col("doc_id", "n_blocks"), **md5(text_hash="text")}, lines=bases.paper_lines)
add("d06_fold_paragraphs", segment.Operator(lambda d: f"WITH {segment.reflowed(d)} SELECT doc_id, island, block FROM styled"), bases.LINES, {"doc_id": lambda d: "doc_id", "island": lambda d: "CAST(island AS BIGINT)", "block": lambda d: "md5(block)"}, lines=bases.paper_lines)
add("x02_clean_candidate", segment.clean_paragraphs, bases.LINES, {**col("doc_id"), "n_chars": lambda d: "CAST(length(text) AS BIGINT)", **md5(text_hash="text")}, lines=bases.paper_lines)
add("e15_first_abstract", segment.Operator(lambda d: f"SELECT doc_id, min(line_no) AS line_no FROM @lines@ WHERE {d.strip('line')} = 'Abstract' GROUP BY doc_id"), bases.LINES, lines=bases.paper_lines)

_candidates = lambda d: (
    f"candidates AS (SELECT doc_id, 'extracted' AS name, 0 AS priority, {lines.wrap(d, 'text', d.text('a.pdf'))} AS raw FROM @papers@ WHERE doc_id % 3 <> 1"
    " UNION ALL SELECT doc_id, 'converted' AS name, 1 AS priority, CASE WHEN doc_id % 3 = 2 THEN replace(text, 'Abstract', '(cid:1)') ELSE text END AS raw FROM @papers@),"
    f" scored AS (SELECT doc_id, name, priority, raw, {d.round(segment.score(d, 'raw', 'rs'), 6)} AS score FROM (SELECT *, {segment.source_rows(d, 'raw')} AS rs FROM candidates))"
)
add("d02_source_score", segment.Operator(lambda d: f"SELECT doc_id, round({segment.score(d, 'text', 'rs')}, 6) AS score FROM (SELECT doc_id, text, {segment.source_rows(d, 'text')} AS rs FROM @documents@)"), "", documents=documents)
add("g01_candidate_union", segment.Operator(lambda d: f"WITH {_candidates(d)} SELECT doc_id, name, priority, md5(raw) AS raw_hash FROM candidates"), bases.PAPERS, papers=bases.papers)
add("x01_candidates", segment.Operator(lambda d: f"WITH {_candidates(d)} SELECT doc_id, name, score, md5({lines.unwrap(d, 'raw')}) AS content_hash FROM scored"), bases.PAPERS, papers=bases.papers)
add("d03_best_candidate", segment.Operator(lambda d: f"WITH {_candidates(d)} SELECT doc_id, name, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, priority) AS rn FROM scored) WHERE rn = 1"), bases.PAPERS, papers=bases.papers)
add("f03_candidate_report", segment.Operator(lambda d: f"WITH {_candidates(d)} SELECT doc_id, name, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, priority) AS BIGINT) AS place, score FROM scored"), bases.PAPERS, papers=bases.papers)
_list = lambda d: f"array_join(transform(array_sort(collect_list(struct(-score AS s, priority, name))), e -> e.name), ',')" if d.name == "spark" else "string_agg(name, ',' ORDER BY -score, priority)"
add("a15_score_report", segment.Operator(lambda d: f"WITH {_candidates(d)} SELECT doc_id, {_list(d)} AS order_of_sources, {d.round('max(score)', 2)} AS best FROM scored GROUP BY doc_id"), bases.PAPERS, papers=bases.papers)
add("a20_first_existing", segment.Operator(lambda d: f"WITH {_candidates(d)}, a AS (SELECT * FROM candidates WHERE priority = 0), b AS (SELECT * FROM candidates WHERE priority = 1) SELECT b.doc_id, coalesce(a.name, b.name) AS name FROM b LEFT JOIN a ON a.doc_id = b.doc_id"), bases.PAPERS, papers=bases.papers)

_texts = "texts AS (SELECT doc_id, text FROM documents)"
_kinds = lambda d: f"CASE WHEN doc_id % 4 = 0 THEN 'figure' ELSE 'paragraph' END"
add("e11_sentence_chunks", planning.chunk_counts, _texts, texts=documents)
add("e10_char_budget_batches", planning.batches, _texts, texts=documents)
add("e12_chunk_index", planning.chunks, _texts, {**col("doc_id", "chunk_idx", "chunk_total"), **md5(text_hash="text")}, texts=documents)


def _answered(spark, sf_dir):
    c = planning.chunks(spark, texts=documents(spark, sf_dir))
    return c.selectExpr("doc_id", "chunk_idx", f"{_kinds(SPARK)} AS kind", "text")


_CHUNKS = f"{_texts}, cut AS ({planning.chunks.sql()}), chunks AS (SELECT doc_id, chunk_idx, {_kinds(DUCK)} AS kind, text FROM cut), answers AS (SELECT doc_id, chunk_idx, concat(' 譯：', text, ' ') AS answer FROM chunks WHERE (doc_id + chunk_idx) % 7 <> 0)"
add("c11_reassemble_chunks", planning.reassemble, _CHUNKS, chunks=_answered, answers=lambda s, d: _answered(s, d).where("(doc_id + chunk_idx) % 7 <> 0").selectExpr("doc_id", "chunk_idx", "concat(' 譯：', text, ' ') AS answer"))

_pairs = lambda where: lambda s, d: bases.pairs(s, d).where(where)
add("c01_resume_merge", planning.resume, f"{bases.PAIRS}, fresh AS (SELECT * FROM pairs WHERE doc_id % 13 <> 5), stored AS (SELECT * FROM pairs WHERE doc_id % 17 <> 3)", fresh=_pairs("doc_id % 13 <> 5"), stored=_pairs("doc_id % 17 <> 3"))
