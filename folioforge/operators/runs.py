"""Page runs: states, summaries, resume, page sources, reasons from logs, caches and checkpoints."""

from __future__ import annotations

from ..functions.dialect import Dialect
from .template import Operator

# Page states and the phrases of logs that carry reasons.
STATES = ("pass", "degraded_pass", "failed_hard_source_passthrough")
WARNING = r"Falling back to degraded translation output due to validation failure: ([^\n]+)"
ERROR = r"Invalid translation output after retries: ([^\n]+)"


def state(made: str, warnings: str) -> str:
    """made: the translated page exists. The exit code does not count."""
    return f"CASE WHEN NOT {made} THEN 'failed_hard_source_passthrough' WHEN {warnings} > 0 THEN 'degraded_pass' ELSE 'pass' END"


def fallback(status: str) -> str:
    return f"CASE {status} WHEN 'failed_hard_source_passthrough' THEN 'original_page_passthrough' WHEN 'degraded_pass' THEN 'translator_level_degraded_output' END"


def reasons(d: Dialect, log: str, pattern: str) -> str:
    return d.extract_all(log, pattern, 1)


def records(d: Dialect) -> str:
    """CTE records over @attempts@ (paper_id, page, made, seconds, log)."""
    w, e = reasons(d, "log", WARNING), reasons(d, "log", ERROR)
    s = state("made", d.size(w))
    return f"records AS (SELECT paper_id, page, made, seconds, log, {s} AS status, {fallback('(' + s + ')')} AS fallback, {w} AS warnings, {e} AS errors FROM @attempts@)"


page_states = Operator(lambda d: f"WITH {records(d)} SELECT paper_id, page, status, fallback, {d.size('warnings')} AS n_warnings, {d.size('errors')} AS n_errors FROM records")
errors = Operator(lambda d: f"WITH {records(d)} SELECT paper_id, page, status, {d.join('warnings', ';')} AS warnings, {d.join('errors', ';')} AS errors FROM records WHERE status <> 'pass'")
_each = lambda d: "explode" if d.name == "spark" else "unnest"
reason_counts = Operator(lambda d: f"WITH {records(d)} SELECT reason, count(*) AS n FROM (SELECT {_each(d)}(warnings) AS reason FROM records UNION ALL SELECT {_each(d)}(errors) AS reason FROM records) GROUP BY reason")

def _summary(d: Dialect) -> str:
    states = d.array(*map(d.text, STATES))
    return (
        f"WITH {records(d)}, states AS (SELECT paper_id, {'explode' if d.name == 'spark' else 'unnest'}({states}) AS status FROM (SELECT DISTINCT paper_id FROM records)),"
        " counts AS (SELECT paper_id, status, count(*) AS n, sum(seconds) AS seconds FROM records GROUP BY paper_id, status)"
        " SELECT s.paper_id, s.status, coalesce(c.n, 0) AS n, round(coalesce(c.seconds, 0), 3) AS seconds FROM states s LEFT JOIN counts c ON c.paper_id = s.paper_id AND c.status = s.status"
    )


#: Counts of every state of every paper, zeros included, and seconds.
summary = Operator(_summary)
rollup = Operator(lambda d: f"WITH {records(d)} SELECT paper_id, status, count(*) AS n, round(sum(seconds), 3) AS seconds FROM records GROUP BY ROLLUP(paper_id, status)")

#: Pages still to do: those without a translated page in a final state.
pending = Operator(lambda d: f"WITH {records(d)} SELECT w.paper_id, w.page FROM @wanted@ w WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.paper_id = w.paper_id AND r.page = w.page AND r.made)")

#: Where each page of a paper comes from, whatever range was run.
sources = Operator(lambda d: f"WITH {records(d)} SELECT w.paper_id, w.page, CASE WHEN r.made THEN 'translated_page' ELSE 'original_page_passthrough' END AS source FROM @wanted@ w LEFT JOIN records r ON r.paper_id = w.paper_id AND r.page = w.page")

#: Rows whose key is stored keep the stored answer, the others are asked anew.
with_stored = Operator(
    lambda d: f"SELECT t.doc_id, s.answer IS NOT NULL AS reused, coalesce(s.answer, concat('new:', md5(t.text))) AS answer FROM @tasks@ t LEFT JOIN (SELECT k, {'max_by' if d.name == 'spark' else 'arg_max'}(answer, seq) AS answer FROM @stored@ GROUP BY k) s ON s.k = sha2(concat(t.text, '|', t.mode), 256)".replace("sha2(concat(t.text, '|', t.mode), 256)", "sha2(concat(t.text, '|', t.mode), 256)" if d.name == "spark" else "sha256(concat(t.text, '|', t.mode))")
)
