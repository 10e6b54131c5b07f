"""Queries of joins, aggregates and sorts: glossary, layout, page runs, caches."""

from __future__ import annotations

from ..functions.dialect import DUCK, SPARK, columns_of
from ..operators import glossary, layout, runs
from ..operators.template import Operator
from . import bases, block_queries

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def add(key, operator, ctes, select=None, **inputs):
    block_queries.add(key, operator, ctes, select, **inputs)
    QUERIES[key] = block_queries.QUERIES.pop(key)
    ORACLES[key] = block_queries.ORACLES.pop(key)


documents = lambda s, d: bases.read(s, d, "documents")
LINES, paper_lines = bases.LINES, bases.paper_lines

add("d04_glossary_build", glossary.build, LINES, lines=paper_lines)
add("g02_glossary_union", Operator(lambda d: f"WITH {glossary.entries(d)} SELECT doc_id, source, count(*) AS n FROM entries GROUP BY doc_id, source"), LINES, lines=paper_lines)
add("f02_glossary_order", glossary.ordered, LINES, lines=paper_lines)
add("b27_noise_heading", glossary.noise_headings, LINES, lines=paper_lines)
add("c04_dictionary_presence", glossary.presence, LINES, lines=paper_lines)
add("c02_block_glossary", glossary.subset, LINES, lines=paper_lines)
add("f05_top_glossary_hits", glossary.hits, LINES, lines=paper_lines)
add("d04_acronym_tokens", glossary.acronyms, "", documents=documents)

# Boxes by rule: pages of 25 text boxes and as many regions, so pages grow in number with the documents and not in size.
_PAGE = lambda d: d.idiv("doc_id", "25")
_box = lambda d: (
    f"{_PAGE(d)} AS page, doc_id AS box_id, (doc_id * 37) % 400 AS x0, (doc_id * 53) % 600 AS y0, (doc_id * 37) % 400 + 40 + doc_id % 190 AS x1, (doc_id * 53) % 600 + 15 + doc_id % 50 AS y1,"
    " concat(CASE WHEN doc_id % 9 = 0 THEN '2.1 Part ' WHEN doc_id % 7 = 0 THEN concat('Figure ', doc_id % 5 + 1, ': ') ELSE '' END, text) AS hint, CASE WHEN doc_id % 9 = 0 THEN 'title' WHEN doc_id % 6 = 1 THEN 'noise' ELSE 'body' END AS role"
)
_region = lambda d: f"{_PAGE(d)} AS page, doc_id AS det_id, (doc_id * 29) % 400 AS x0, (doc_id * 71) % 600 AS y0, (doc_id * 29) % 400 + 90 + doc_id % 70 AS x1, (doc_id * 71) % 600 + 60 + doc_id % 40 AS y1, CASE WHEN doc_id % 2 = 0 THEN 'text' ELSE 'figure' END AS label, CAST(doc_id % 10 AS DOUBLE) / 10 AS confidence"
BOXES = f"boxes AS (SELECT {_box(DUCK)} FROM documents), regions AS (SELECT {_region(DUCK)} FROM documents)"
boxes = lambda s, d: documents(s, d).selectExpr(*columns_of(_box(SPARK)))
regions = lambda s, d: documents(s, d).selectExpr(*columns_of(_region(SPARK)))
add("h11_bbox_iou", Operator(lambda d: f"SELECT t.box_id, round({layout.iou(d, 't', 'r')}, 9) AS overlap FROM @boxes@ t JOIN @regions@ r ON t.box_id = r.det_id"), BOXES, boxes=boxes, regions=regions)
add("c05_assign_regions", layout.assign, BOXES, boxes=boxes, regions=regions)
add("f01_reading_order", layout.reading_order, BOXES, boxes=boxes)
add("d12_smallest_area", layout.smallest, BOXES, boxes=boxes)
add("d13_bbox_union", layout.unions, BOXES, boxes=boxes)
add("h12_column_bounds", layout.columns, BOXES, boxes=boxes)
add("c10_crop_rectangles", layout.crops(), BOXES, boxes=boxes)
add("b25_drop_noise_regions", Operator(lambda d: f"SELECT page, count(*) AS n FROM @boxes@ WHERE role <> 'noise' AND {d.strip('hint')} <> '' GROUP BY page"), BOXES, boxes=boxes)
add("x09_layout_document", layout.render, BOXES, boxes=boxes)

# Page runs from events: a page for each event, a paper for each user.
_TEXT = lambda d: "STRING" if d.name == "spark" else "VARCHAR"


def _attempt(d):
    nl = d.text(chr(10))
    warn = d.text("Falling back to degraded translation output due to validation failure: ")
    fail = d.text("Invalid translation output after retries: ")
    log = f"concat('start', {nl}, CASE WHEN event_type = 'click' THEN concat({warn}, 'reason-', event_id % 3, {nl}, {warn}, 'think_leak', {nl}) ELSE '' END, CASE WHEN event_type = 'error' THEN concat({fail}, 'empty_translation', {nl}) ELSE '' END, 'end')"
    return f"concat('p', user_id % 50) AS paper_id, event_id AS page, event_type <> 'error' AS made, round(value, 3) AS seconds, {log} AS log"


_WANTED = "wanted AS (SELECT concat('p', user_id % 50) AS paper_id, event_id AS page FROM events)"
ATTEMPTS = f"attempts AS (SELECT {_attempt(DUCK)} FROM events), {_WANTED}"
#: A run that stopped: a quarter of the pages wanted was never tried. For the operators whose subject is that gap.
STOPPED = f"attempts AS (SELECT {_attempt(DUCK)} FROM events WHERE event_id % 4 <> 3), {_WANTED}"
events = lambda s, d: bases.read(s, d, "events")
attempts = lambda s, d: events(s, d).selectExpr(*columns_of(_attempt(SPARK)))
stopped = lambda s, d: events(s, d).where("event_id % 4 <> 3").selectExpr(*columns_of(_attempt(SPARK)))
wanted = lambda s, d: events(s, d).selectExpr("concat('p', user_id % 50) AS paper_id", "event_id AS page")
add("i01_page_state", runs.page_states, ATTEMPTS, attempts=attempts)
add("d01_run_summary", runs.summary, ATTEMPTS, attempts=attempts)
add("d15_paper_rollup", runs.rollup, ATTEMPTS, attempts=attempts)
add("d10_reason_counts", runs.reason_counts, ATTEMPTS, attempts=attempts)
add("h22_log_reasons", Operator(lambda d: f"SELECT paper_id, page, {d.join(runs.reasons(d, 'log', runs.WARNING), ';')} AS warnings, {d.join(runs.reasons(d, 'log', runs.ERROR), ';')} AS errors FROM @attempts@"), ATTEMPTS, attempts=attempts)
add("a12_error_log", runs.errors, ATTEMPTS, attempts=attempts)
add("c06_pending_pages", runs.pending, STOPPED, attempts=stopped, wanted=wanted)
add("c07_page_sources", runs.sources, STOPPED, attempts=stopped, wanted=wanted)
add("b30_page_range", Operator(lambda d: "SELECT paper_id, count(*) AS n FROM @wanted@ WHERE page BETWEEN 100 AND 699 GROUP BY paper_id"), ATTEMPTS, wanted=wanted)
add("f08_page_sequence", Operator(lambda d: f"SELECT paper_id, {'explode(sequence(1, n))' if d.name == 'spark' else 'unnest(range(1, n + 1))'} AS page FROM (SELECT paper_id, count(*) AS n FROM @wanted@ GROUP BY paper_id)"), ATTEMPTS, wanted=wanted)
add("a11_manifest", Operator(lambda d: "SELECT paper_id, count(*) AS page_count, min(page) AS first_page, max(page) AS last_page FROM @wanted@ GROUP BY paper_id"), ATTEMPTS, wanted=wanted)
add("h23_page_names", Operator(lambda d: f"SELECT page, {'format_string' if d.name == 'spark' else 'printf'}('page-%02d', page) AS folder, concat(paper_id, '-mono.pdf') AS file FROM @wanted@"), ATTEMPTS, wanted=wanted)
add("h26_duration", Operator(lambda d: f"SELECT user_id, round({'CAST(unix_micros(CAST(max(ts) AS TIMESTAMP)) - unix_micros(CAST(min(ts) AS TIMESTAMP)) AS DOUBLE)' if d.name == 'spark' else 'CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE)'} / 1000000, 3) AS seconds FROM @events@ GROUP BY user_id"), "", events=events)

# Caches and checkpoints: keyed by content, the last write counts.
_TASK = lambda d: "doc_id, text, CASE WHEN doc_id % 2 = 0 THEN 'hybrid' ELSE 'full' END AS mode"
_STORED = lambda d: f"{'sha2' if d.name == 'spark' else 'sha256'}(concat(text, '|', 'hybrid'){', 256' if d.name == 'spark' else ''}) AS k, concat('old:', doc_id) AS answer, doc_id AS seq"
TASKS = f"tasks AS (SELECT {_TASK(DUCK)} FROM documents), stored AS (SELECT {_STORED(DUCK)} FROM documents WHERE doc_id % 3 = 0)"
_tasks = dict(tasks=lambda s, d: documents(s, d).selectExpr(*columns_of(_TASK(SPARK))), stored=lambda s, d: documents(s, d).where("doc_id % 3 = 0").selectExpr(*columns_of(_STORED(SPARK))))
add("c15_translation_cache", runs.with_stored, TASKS, **_tasks)
add("c08_checkpoint_skip", Operator(lambda d: f"SELECT t.doc_id FROM @tasks@ t WHERE NOT EXISTS (SELECT 1 FROM @stored@ s WHERE s.k = {'sha2' if d.name == 'spark' else 'sha256'}(concat(t.text, '|', t.mode){', 256' if d.name == 'spark' else ''}))"), TASKS, **_tasks)
add("a13_checkpoint_last_write", Operator(lambda d: f"SELECT k, {'max_by' if d.name == 'spark' else 'arg_max'}(answer, seq) AS answer FROM (SELECT k, answer, seq FROM @stored@ UNION ALL SELECT k, concat(answer, '+') AS answer, seq + 1 AS seq FROM @stored@ WHERE seq % 2 = 0) GROUP BY k"), TASKS, stored=_tasks["stored"])
add("g07_missing_ids", Operator(lambda d: "SELECT doc_id FROM @tasks@ EXCEPT SELECT seq FROM @stored@"), TASKS, **_tasks)

# Anchors of figures and tables.
_anchor = r"^(Figure|Table)\s+([0-9]+):"
_anchors = lambda d: f"anchors AS (SELECT doc_id, line_no, lower({d.extract('line', _anchor, 1)}) AS kind, CAST({d.extract('line', _anchor, 2)} AS BIGINT) AS num FROM @lines@ WHERE {d.rx('line', _anchor)})"
add("d11_anchor_page", Operator(lambda d: f"WITH {_anchors(d)} SELECT kind, num, doc_id % 7 AS paper, max(doc_id) AS page FROM anchors GROUP BY kind, num, doc_id % 7"), LINES, lines=paper_lines)
add("e16_first_per_key", Operator(lambda d: f"WITH {_anchors(d)} SELECT kind, num, doc_id, line_no FROM (SELECT *, row_number() OVER (PARTITION BY kind, num ORDER BY doc_id, line_no) AS rn FROM anchors) WHERE rn = 1"), LINES, lines=paper_lines)
add("f04_anchor_order", Operator(lambda d: f"WITH {_anchors(d)} SELECT doc_id, kind, num, CAST(row_number() OVER (PARTITION BY doc_id % 7 ORDER BY doc_id, kind, num) AS BIGINT) AS place FROM anchors"), LINES, lines=paper_lines)
add(
    "c09_visual_links",
    Operator(lambda d: f"WITH {_anchors(d)}, crops AS (SELECT 'figure' AS kind, k AS num, concat('figure-', k, '.png') AS file FROM (SELECT {'explode(sequence(1L, 3L))' if d.name == 'spark' else 'unnest(range(1, 4))'} AS k)) SELECT a.doc_id, a.line_no, CASE WHEN a.rn = 1 THEN c.file END AS file FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, num ORDER BY line_no) AS rn FROM anchors) a LEFT JOIN crops c ON c.kind = a.kind AND c.num = a.num"),
    LINES,
    lines=paper_lines,
)

# Front matter lists
_email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
add(
    "d07_distinct_emails",
    Operator(lambda d: f"SELECT doc_id, {d.size('found')} AS n, {d.join(d.sort(d.distinct('found')), ' ')} AS emails FROM (SELECT doc_id, {d.extract_all(f'concat(text, {d.text(chr(32))}, text)', _email)} AS found FROM @papers@)"),
    bases.PAPERS,
    papers=bases.papers,
)
add("g03_allowed_words", Operator(lambda d: f"SELECT doc_id, {d.join(d.sort(d.distinct(('array_union' if d.name == 'spark' else 'list_concat') + '(' + d.split('lower(source)', ' ') + ', ' + d.array(d.text('model'), d.text('token')) + ')')), ' ')} AS allowed FROM @pairs@ WHERE kind = 'heading'"), bases.PAIRS, pairs=bases.pairs)
