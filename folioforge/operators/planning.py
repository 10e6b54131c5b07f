"""Planning of translation: sentence packing, request batches, resume, reassembly."""

from __future__ import annotations

from ..functions import translation
from ..functions.dialect import Dialect
from .template import Operator, folded

MOST = 180
BATCH, BUDGET = 8, 1000


def packed(d: Dialect, x: str, most: int = MOST) -> str:
    """Sentences packed greedily into chunks of at most `most` characters; longer ones are cut by width."""
    t = d.strip(x)
    mark = "\x1e"
    parts = d.filter(d.map(d.split(d.sub(t, r"([.!?。！？])\s+", "\\1" + mark), mark), "p", d.strip("p")), "p", "p <> ''")
    if d.name == "spark":
        fits = f"@s IS NOT NULL AND length(@s) + 1 + length(x) <= {most}"
        chunks = folded(parts, "CAST(NULL AS STRING)", f"CASE WHEN {fits} THEN concat(@s, ' ', x) ELSE x END", f"CASE WHEN @s IS NULL OR ({fits}) THEN CAST(array() AS ARRAY<STRING>) ELSE array(@s) END", "STRING", "CASE WHEN @s IS NULL THEN CAST(array() AS ARRAY<STRING>) ELSE array(@s) END")
        cut = f"flatten(transform({chunks}, c -> transform(sequence(1, length(c), {most}), i -> substring(c, i, {most}))))"
        return f"CASE WHEN {t} = '' THEN CAST(array() AS ARRAY<STRING>) WHEN length({t}) <= {most} THEN array({t}) ELSE {cut} END"
    chunks = f"list_reduce(list_transform({parts}, lambda p: [p]), lambda a, p: CASE WHEN length(a[-1]) + 1 + length(p[1]) <= {most} THEN list_append(a[:-2], a[-1] || ' ' || p[1]) ELSE list_append(a, p[1]) END)"
    cut = f"flatten(list_transform({chunks}, lambda c: list_transform(range(1, length(c) + 1, {most}), lambda i: substr(c, i, {most}))))"
    return f"CASE WHEN {t} = '' THEN CAST([] AS VARCHAR[]) WHEN length({t}) <= {most} THEN [{t}] ELSE {cut} END"


def batch_numbers(d: Dialect, sizes: str, most: int = BATCH, budget: int = BUDGET) -> str:
    """The request, from 1, of each item of an array of sizes: a new one when `most` items or `budget` characters would be passed. The sum starts anew with each request, so no running sum will do."""
    if d.name == "spark":
        full = f"@s.n > 0 AND (@s.n >= {most} OR @s.chars + x > {budget})"
        step = f"CASE WHEN {full} THEN named_struct('b', @s.b + 1, 'n', 1L, 'chars', x) ELSE named_struct('b', @s.b, 'n', @s.n + 1, 'chars', @s.chars + x) END"
        return folded(sizes, "named_struct('b', 1L, 'n', 0L, 'chars', 0L)", step, f"array(CASE WHEN {full} THEN @s.b + 1 ELSE @s.b END)", "BIGINT")
    full = f"a[2] > 0 AND (a[2] >= {most} OR a[3] + s[1] > {budget})"
    step = f"CASE WHEN {full} THEN list_concat([a[1] + 1, 1, s[1]], list_append(a[4:], a[1] + 1)) ELSE list_concat([a[1], a[2] + 1, a[3] + s[1]], list_append(a[4:], a[1])) END"
    return f"list_reduce(list_transform({sizes}, lambda z: [CAST(z AS BIGINT)]), lambda a, s: {step}, [CAST(1 AS BIGINT), 0, 0])[4:]"


def _chunks(d: Dialect) -> str:
    if d.name == "spark":
        return f"SELECT doc_id, CAST(pos AS BIGINT) AS chunk_idx, total AS chunk_total, text FROM (SELECT doc_id, CAST(size(c) AS BIGINT) AS total, posexplode(c) AS (pos, text) FROM (SELECT doc_id, {packed(d, 'text')} AS c FROM @texts@))"
    return f"SELECT doc_id, CAST(unnest(range(len(c))) AS BIGINT) AS chunk_idx, CAST(len(c) AS BIGINT) AS chunk_total, unnest(c) AS text FROM (SELECT doc_id, {packed(d, 'text')} AS c FROM @texts@)"


chunk_counts = Operator(lambda d: f"SELECT doc_id, {d.size('c')} AS n_chunks, md5({d.join('c', chr(31))}) AS chunk_hash FROM (SELECT doc_id, {packed(d, 'text')} AS c FROM @texts@)")
chunks = Operator(_chunks)
batches = Operator(lambda d: f"SELECT doc_id, {d.join(batch_numbers(d, d.map('c', 'x', 'CAST(length(x) AS BIGINT)')), ',')} AS requests FROM (SELECT doc_id, {packed(d, 'text')} AS c FROM @texts@)")

#: Drafts of an earlier run, kept unless truncated; `problems` counts blocks that only one side has.
resume = Operator(
    lambda d: f"SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, n.doc_id IS NOT NULL AND o.doc_id IS NOT NULL AS matched, CASE WHEN n.doc_id IS NOT NULL AND o.doc_id IS NOT NULL AND NOT {translation.is_truncated(d, 'n.source', 'o.translated', 'n.kind')} THEN md5(o.translated) END AS kept"
    " FROM @fresh@ n FULL OUTER JOIN @stored@ o ON n.doc_id = o.doc_id"
)


def _reassembled(d: Dialect) -> str:
    order = "array_sort(collect_list(struct(chunk_idx, answer)))" if d.name == "spark" else ""
    parts = f"transform({order}, e -> e.answer)" if d.name == "spark" else "list(answer ORDER BY chunk_idx)"
    number = "CAST(c.chunk_idx AS STRING)" if d.name == "spark" else "CAST(c.chunk_idx AS VARCHAR)"
    return (
        f"SELECT doc_id, count(*) AS n_chunks, count(lost) AS n_lost, md5({translation.response_chunk(d, 'min(kind)', parts)}) AS text_hash FROM"
        f" (SELECT c.doc_id, c.chunk_idx, c.kind, coalesce(a.answer, concat('[TRANSLATION_ERROR:', {number}, ']')) AS answer, CASE WHEN a.answer IS NULL THEN 1 END AS lost"
        " FROM @chunks@ c LEFT JOIN @answers@ a ON c.doc_id = a.doc_id AND c.chunk_idx = a.chunk_idx) GROUP BY doc_id"
    )


#: Chunks and the answers to them; a lost answer becomes an error mark.
reassemble = Operator(_reassembled)
