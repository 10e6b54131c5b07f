"""Glossary: several sources of terms, the first one wins; use in prompts; presence of terms.

Dictionaries are small tables of the caller; the ones here are defaults.
"""

from __future__ import annotations

from ..functions import lines
from ..functions.dialect import DUCK, SPARK, Dialect
from .template import Operator

# Forms of acronyms and of phrases that introduce one.
ACRONYM = r"^[A-Z][A-Z0-9-]+$"
PHRASE = r"([A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,5})\s*\(([A-Z][A-Z0-9-]{1,})\)"
# Terms that stay English, terms with a known translation.
PRESERVE = ("LLMs", "PSP", "PIAs", "RLHF", "LEACE", "GPT-4o", "Gemini", "Qwen", "Llama", "OLMo")
CANONICAL = {
    "prompt injection attacks": "提示注入攻擊",
    "politically sensitive prompts": "政治敏感提示",
    "political sensitivity": "政治敏感性",
    "safety guardrails": "安全護欄",
    "censorship": "審查",
    "refusal": "拒絕",
    "partial refusal": "部分拒絕",
}


def is_noise_heading(d: Dialect, x: str) -> str:
    s = d.strip(x)
    return (
        f"({s} = '' OR {d.rx(s, r'^[0-9]+(?:\.[0-9]+)+\s+\S+$')} OR {d.rx(s, r'^[0-9]+\s+[A-Z]{1,4}$')}"
        f" OR ({d.rx(s, r'^[0-9]+(?:\.[0-9]+)*\s+')} AND {d.count(s, r'[0-9]+(?:\.[0-9]+)*')} > 1))"
    )


def _heading(d: Dialect) -> str:
    """The heading that a line is, or null."""
    return f"CASE WHEN {d.rx('line', '^#{1,6} +.+$')} THEN {d.strip(d.extract('line', '^#{1,6} +(.+)$'))} ELSE substring(md, instr(md, ' ') + 1) END"


def _entries_spark(preserve: tuple[str, ...], canonical: dict[str, str]) -> str:
    """Each line gives an array of its terms, in one pass; the first source of a term in a document is a partial aggregate."""
    d = SPARK
    item = lambda term, policy, source, translation, priority: f"named_struct('term', {term}, 'policy', '{policy}', 'source', '{source}', 'translation', CAST({translation} AS STRING), 'priority', {priority})"
    kept = d.array(*map(d.text, preserve))
    known = d.array(*[f"named_struct('term', {d.text(t)}, 'translation', {d.text(z)})" for t, z in canonical.items()])
    terms = (
        f"concat(CASE WHEN term IS NOT NULL AND NOT {is_noise_heading(d, 'term')} THEN array({item('term', 'preferred_translation', 'heading', 'NULL', 1)}) ELSE array() END,"
        f" CASE WHEN {d.has('line', '(')} THEN transform({d.extract_all('line', PHRASE, 2)}, t -> {item(d.strip('t'), 'preserve', 'acronym', 'NULL', 2)}) ELSE array() END,"
        f" CASE WHEN {d.has('line', '(')} THEN {d.let('ps', f"transform({d.extract_all('line', PHRASE, 1)}, p -> lower(p))", f"transform(filter({known}, k -> array_contains(ps, k.term)), k -> {item('k.term', 'canonical_translation', 'phrase_with_acronym', 'k.translation', 3)})")} ELSE array() END,"
        f" transform(filter({kept}, t -> contains(line, t)), t -> {item('t', 'preserve', 'preserve_list', 'NULL', 4)}),"
        f" transform(filter({known}, k -> contains(low, k.term)), k -> {item('k.term', 'canonical_translation', 'canonical_list', 'k.translation', 5)}))"
    )
    return (
        f"headed AS (SELECT doc_id, line, low, {_heading(d)} AS term FROM (SELECT doc_id, line, lower(line) AS low, {lines.markdown_of(d, 's')} AS md FROM (SELECT doc_id, line, {d.trimmed('line')} AS s FROM @lines@))),"
        f" pool AS (SELECT doc_id, e.term, e.policy, e.source, e.translation, e.priority FROM (SELECT doc_id, explode({terms}) AS e FROM headed)),"
        " entries AS (SELECT doc_id, term, b.policy, b.source, b.translation FROM (SELECT doc_id, term, min_by(named_struct('policy', policy, 'source', source, 'translation', translation), priority) AS b FROM pool GROUP BY doc_id, term))"
    )


def _table(d: Dialect, rows: list[tuple[str, ...]], names: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(map(d.text, r)) + ')' for r in rows)}) AS v({names})"


def _entries_duck(preserve: tuple[str, ...], canonical: dict[str, str]) -> str:
    """The same from the text as a whole, source by source: the counterpart that the check compares with."""
    d = DUCK
    nothing = "CAST(NULL AS VARCHAR)"
    return (
        f"headed AS (SELECT DISTINCT doc_id, {_heading(d)} AS term FROM (SELECT doc_id, line, {lines.markdown_heading(d, 'line')} AS md FROM @lines@)),"
        f" phrases AS (SELECT doc_id, unnest({d.extract_all('line', PHRASE, 1)}) AS phrase FROM @lines@),"
        f" shorts AS (SELECT doc_id, unnest({d.extract_all('line', PHRASE, 2)}) AS term FROM @lines@),"
        f" whole AS (SELECT doc_id, string_agg(line, {d.text(chr(10))} ORDER BY line_no) AS text FROM @lines@ GROUP BY doc_id),"
        f" kept AS (SELECT term FROM {_table(d, [(t,) for t in preserve], 'term')}), known AS (SELECT term, translation FROM {_table(d, list(canonical.items()), 'term, translation')}),"
        f" pool AS (SELECT doc_id, term, 'preferred_translation' AS policy, 'heading' AS source, {nothing} AS translation, 1 AS priority FROM headed WHERE term IS NOT NULL AND NOT {is_noise_heading(d, 'term')}"
        f" UNION ALL SELECT doc_id, {d.strip('term')}, 'preserve', 'acronym', {nothing}, 2 FROM shorts"
        " UNION ALL SELECT doc_id, k.term, 'canonical_translation', 'phrase_with_acronym', k.translation, 3 FROM phrases JOIN known k ON lower(phrase) = k.term"
        f" UNION ALL SELECT doc_id, k.term, 'preserve', 'preserve_list', {nothing}, 4 FROM whole JOIN kept k ON contains(text, k.term)"
        " UNION ALL SELECT doc_id, k.term, 'canonical_translation', 'canonical_list', k.translation, 5 FROM whole JOIN known k ON contains(lower(text), k.term)),"
        " entries AS (SELECT doc_id, term, policy, source, translation FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, term ORDER BY priority) AS rn FROM pool) WHERE rn = 1)"
    )


def entries(d: Dialect, preserve: tuple[str, ...] = PRESERVE, canonical: dict[str, str] = CANONICAL) -> str:
    """CTEs pool and entries (doc_id, term, policy, source, translation) over @lines@ (doc_id, line_no, line). Dictionary terms hold no line break."""
    return (_entries_spark if d.name == "spark" else _entries_duck)(preserve, canonical)


def builder(preserve: tuple[str, ...] = PRESERVE, canonical: dict[str, str] = CANONICAL) -> Operator:
    """The glossary of each document, with dictionaries of the caller."""
    return Operator(lambda d: f"WITH {entries(d, preserve, canonical)} SELECT doc_id, term, policy, source, translation FROM entries")


build = builder()
ordered = Operator(lambda d: f"WITH {entries(d)} SELECT doc_id, term, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY lower(term), policy, term) AS BIGINT) AS place FROM entries")
noise_headings = Operator(lambda d: f"WITH {entries(d)} SELECT DISTINCT doc_id, term, {is_noise_heading(d, 'term')} AS noise FROM headed WHERE term IS NOT NULL")
presence = Operator(lambda d: f"WITH {entries(d)} SELECT DISTINCT doc_id, term, source FROM pool WHERE priority >= 4")

def held_terms(text: str, terms: str) -> str:
    """Spark SQL: the first eight of the sorted terms (low, ...) that a text holds; the text is put into small letters once, not for each term."""
    return SPARK.let("low_", f"lower({text})", f"slice(filter({terms}, e -> contains(low_, e.low)), 1, 8)")


#: Terms that a block holds, at most eight in glossary order. The terms of a document go to its lines as one sorted array, so no pair that does not match becomes a row.
def _subset(d: Dialect) -> str:
    if d.name == "spark":
        return (
            f"WITH {entries(d)}, sorted AS (SELECT doc_id, array_sort(collect_list(struct(lower(term) AS low, policy, term))) AS terms FROM entries GROUP BY doc_id)"
            f" SELECT doc_id, line_no, e.term, CAST(pos + 1 AS BIGINT) AS place FROM (SELECT l.doc_id, l.line_no, posexplode({held_terms('l.line', 's.terms')}) AS (pos, e) FROM @lines@ l JOIN sorted s ON l.doc_id = s.doc_id)"
        )
    return (
        f"WITH {entries(d)} SELECT doc_id, line_no, term, CAST(rn AS BIGINT) AS place FROM (SELECT l.doc_id, l.line_no, e.term, row_number() OVER (PARTITION BY l.doc_id, l.line_no ORDER BY lower(e.term), e.policy, e.term) AS rn"
        " FROM @lines@ l JOIN entries e ON l.doc_id = e.doc_id AND contains(lower(l.line), lower(e.term))) WHERE rn <= 8"
    )


subset = Operator(_subset)


def _hits(d: Dialect) -> str:
    """How many terms a line holds, counted up to eight."""
    if d.name == "spark":
        return (
            f"WITH {entries(d)}, sorted AS (SELECT doc_id, array_sort(collect_list(struct(lower(term) AS low, policy, term))) AS terms FROM entries GROUP BY doc_id)"
            f" SELECT doc_id, line_no, n FROM (SELECT l.doc_id, l.line_no, CAST(size({held_terms('l.line', 's.terms')}) AS BIGINT) AS n FROM @lines@ l JOIN sorted s ON l.doc_id = s.doc_id) WHERE n > 0"
        )
    return f"WITH {entries(d)}, hits AS (SELECT l.doc_id, l.line_no, e.term, row_number() OVER (PARTITION BY l.doc_id, l.line_no ORDER BY lower(e.term), e.policy, e.term) AS rn FROM @lines@ l JOIN entries e ON l.doc_id = e.doc_id AND contains(lower(l.line), lower(e.term))) SELECT doc_id, line_no, count(*) AS n FROM hits WHERE rn <= 8 GROUP BY doc_id, line_no"


hits = Operator(_hits)

#: Acronyms by whole tokens, in the order of their counts.
acronyms = Operator(
    lambda d: f"SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, {'explode' if d.name == 'spark' else 'unnest'}({d.filter(d.split(d.sub('text', '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_-]+', ' '), ' '), 't', d.rx('t', ACRONYM))}) AS token FROM @documents@) GROUP BY doc_id, token"
)
