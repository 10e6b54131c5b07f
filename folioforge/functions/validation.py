"""Validation of translated text against its source, as portable expressions."""

from __future__ import annotations

from .assembly import ARTIFACTS, HAN
from .dialect import Dialect

# Placeholder forms, refusal phrases, words of venue names.
PLACEHOLDER = r"\{\s*[vV]\s*([0-9]+)\s*\}"
DANGLING = r"\{\s*[vV]"
REFUSALS = ("很抱歉，我無法", "抱歉，我無法", "我無法翻譯此內容", "我無法提供", "我不能幫助", "無法協助")
VENUE = r"(?:^|[^\p{L}\p{N}_])(?:In\s+)?[A-Z][A-Za-z]+\s+(?:of|the|for|and|on|Annual|Meeting|Association|Computational|Linguistics|Long|Papers|ACL|Proceedings|Conference|Symposium|Workshop|Journal|Transactions|Preprint|arXiv|Online|Bangkok|Thailand)"
ROLE = r"^(?:User|Assistant)\s*\{\s*[vV]\s*[0-9]+\s*\}"
NOT_WORD = r"[^\p{L}\p{N}_-]+"


def placeholders(d: Dialect, x: str) -> str:
    return d.map(d.extract_all(x, PLACEHOLDER, 1), "n", "concat('{v', n, '}')")


def has_dangling(d: Dialect, x: str) -> str:
    return d.rx(d.sub(x, PLACEHOLDER), DANGLING)


def joined_words(d: Dialect, x: str) -> str:
    """Words that extraction cut in two put together: after a hyphen, or short pieces over a line break."""
    if d.name == "spark":  # a word before a cut counts by its last letter; patterns are tried only where what they need is there
        hyphen = d.sub("x_", r"([A-Za-z])-\s+([A-Za-z]{1,20})", "\\1\\2")
        broken = d.sub("y_", r"(^|[^\p{L}\p{N}_])([A-Za-z]{1,2})\s*\n\s*([a-z]{1,20})", "\\1\\2\\3")
        broken = d.sub(broken, r"([A-Za-z])\s*\n\s*([a-z]{1,2})($|[^\p{L}\p{N}_])", "\\1\\2\\3")
        return d.let("x_", x, d.let("y_", f"CASE WHEN {d.has('x_', '-')} THEN {hyphen} ELSE x_ END", f"CASE WHEN {d.has('y_', chr(10))} THEN {broken} ELSE y_ END"))
    x = d.sub(x, r"([A-Za-z]{1,20})-\s+([A-Za-z]{1,20})", "\\1\\2")
    x = d.sub(x, r"(^|[^\p{L}\p{N}_])([A-Za-z]{1,2})\s*\n\s*([a-z]{1,20})", "\\1\\2\\3")
    return d.sub(x, r"([A-Za-z]{1,20})\s*\n\s*([a-z]{1,2})($|[^\p{L}\p{N}_])", "\\1\\2\\3")


def lowercase_words(d: Dialect, x: str) -> str:
    """Tokens of small English letters, four or more with hyphens."""
    if d.name == "spark":
        return d.filter(f"split({joined_words(d, x)}, {d.pattern(NOT_WORD)})", "w", d.rx("w", r"^[a-z][a-z-]{3,}$"))
    spaced = d.sub(joined_words(d, x), NOT_WORD, " ")
    return d.filter(d.split(spaced, " "), "w", d.rx("w", r"^[a-z][a-z-]{3,}$"))


def suspicious_words(d: Dialect, source: str, translated: str) -> str:
    """Distinct words of the translation that its source lacks, sorted by code point."""
    return d.sort(d.minus(d.distinct(lowercase_words(d, translated)), lowercase_words(d, source)))


def _reason_spark(d: Dialect, source: str, translated: str, markers, source_words: str) -> str:
    """reason() a step after another: what a step needs is made once, and only for translations that come so far."""
    leak = " ".join(f"WHEN {d.has('low_', m.lower())} THEN {d.text('leak_marker:' + m)}" for m in markers)
    a, b = "a_", "b_"
    excused = (
        f"(({d.size(a)} > 0 AND {d.sort(a)} = {d.sort(b)}) OR ({d.size(a)} > 0 AND {d.size(b)} = 0 AND {d.rx('t_', VENUE)}) OR ({d.size(a)} = 1 AND {d.rx(source, ROLE)} AND {d.any_of('t_', REFUSALS)}))"
    )
    odd = d.sort(d.minus(d.distinct("ws_"), source_words))
    many = f"({d.size('odd_')} >= 3 OR ({d.size('odd_')} >= 2 AND {d.size('ws_')} >= 8))"
    words = d.let("ws_", lowercase_words(d, "t_"), d.let("odd_", odd, f"CASE WHEN {many} THEN concat('suspicious_english:', {d.join(d.slice('odd_', 8), ',')}) ELSE 'ok' END"))
    held = f"CASE WHEN {a} <> {b} AND NOT {excused} THEN 'placeholder_mismatch' WHEN {d.rx('t_', HAN)} THEN {words} ELSE 'ok' END"
    held = d.let(a, placeholders(d, source), d.let(b, placeholders(d, "t_"), held))
    steps = f"CASE {leak} WHEN {d.has('low_', '<think>')} OR {d.has('low_', '</think>')} THEN 'think_leak' WHEN {d.has('t_', '{')} AND {has_dangling(d, 't_')} THEN 'dangling_placeholder' ELSE {held} END"
    return d.let("t_", d.strip(f"coalesce({translated}, '')"), f"CASE WHEN t_ = '' THEN 'empty_translation' ELSE {d.let('low_', 'lower(t_)', steps)} END")


def reason(d: Dialect, source: str, translated: str, markers=ARTIFACTS, source_words: str = "") -> str:
    """'ok', or why the translation is refused. markers: what leaks from prompts; the list is a policy of the caller. source_words: lowercase_words() of the source, for Spark, where it is a column already."""
    if d.name == "spark":
        return _reason_spark(d, source, translated, markers, source_words or lowercase_words(d, source))
    t = d.strip(f"coalesce({translated}, '')")
    low = f"lower({t})"
    leak = " ".join(f"WHEN {d.has(low, m.lower())} THEN {d.text('leak_marker:' + m)}" for m in markers)
    a, b = placeholders(d, source), placeholders(d, t)
    excused = (
        f"(({d.size(a)} > 0 AND {d.sort(a)} = {d.sort(b)}) OR ({d.size(a)} > 0 AND {d.size(b)} = 0 AND {d.rx(t, VENUE)}) OR ({d.size(a)} = 1 AND {d.rx(source, ROLE)} AND {d.any_of(t, REFUSALS)}))"
    )
    odd = suspicious_words(d, source, t)
    many = f"({d.size(odd)} >= 3 OR ({d.size(odd)} >= 2 AND {d.size(lowercase_words(d, t))} >= 8))"
    return (
        f"CASE WHEN {t} = '' THEN 'empty_translation' {leak} WHEN {d.has(low, '<think>')} OR {d.has(low, '</think>')} THEN 'think_leak' WHEN {has_dangling(d, t)} THEN 'dangling_placeholder'"
        f" WHEN {a} <> {b} AND NOT {excused} THEN 'placeholder_mismatch' WHEN {d.rx(t, HAN)} AND {many} THEN concat('suspicious_english:', {d.join(d.slice(odd, 8), ',')}) ELSE 'ok' END"
    )
