"""Predicates and merges of English text blocks, as portable expressions."""

from __future__ import annotations

from .dialect import Dialect
from .lines import PANELS

# Patterns that tell headings, captions, metadata and broken words.
HEADING = r"^#{1,6}\s+"
CAPTION = r"^(?:[Ff][Ii][Gg][Uu][Rr][Ee]|[Tt][Aa][Bb][Ll][Ee])\s+[0-9]+"
URLISH = r"^(?:[0-9]+\s*)?https?://\S+$"
EMAILISH = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
METADATA = r"University|Institute|Science Park|@|[0-9][A-Z]{2,}|Equal contribution"
#: The words of METADATA; what else it takes is [0-9][A-Z]{2,}.
METADATA_WORDS = ("University", "Institute", "Science Park", "@", "Equal contribution")
MIXED = r"(?s)^(.*[.!?])\s+([a-z].*)$"


def is_heading(d: Dialect, x: str) -> str:
    return d.rx(d.strip(x), HEADING)


def is_caption(d: Dialect, x: str) -> str:
    return d.rx(d.strip(x), CAPTION)


def _metadata_of(d: Dialect, s: str) -> str:
    """s: a stripped text in Spark. Words are looked for one by one, which costs less than one pattern of all."""
    found = " OR ".join([d.has(s, w) for w in METADATA_WORDS] + [d.rx(s, "[0-9][A-Z]{2,}")])
    return f"({s} <> '' AND (({found}) AND ((NOT {d.rx(s, HEADING)} AND NOT {d.rx(s, CAPTION)}) OR ({d.has(s, '@')} AND {d.rx(s, EMAILISH)}))))"


def is_metadata(d: Dialect, x: str) -> str:
    s = d.strip(x)
    if d.name == "spark":
        return d.let("m_", s, _metadata_of(d, "m_"))
    return f"({s} <> '' AND ({d.rx(s, EMAILISH)} OR ({d.rx(s, METADATA)} AND NOT {is_heading(d, x)} AND NOT {is_caption(d, x)})))"


def kind(d: Dialect, x: str) -> str:
    if d.name == "spark":
        told = f"CASE WHEN {d.rx('k_', HEADING)} THEN 'heading' WHEN {d.rx('k_', CAPTION)} THEN 'caption' WHEN {_metadata_of(d, 'k_')} THEN 'metadata' ELSE 'paragraph' END"
        return d.let("k_", d.trimmed(x) if x.isidentifier() else d.strip(x), told)
    return f"CASE WHEN {is_heading(d, x)} THEN 'heading' WHEN {is_caption(d, x)} THEN 'caption' WHEN {is_metadata(d, x)} THEN 'metadata' ELSE 'paragraph' END"


def can_merge(d: Dialect, a: str, b: str) -> str:
    plain = lambda x: f"{x} <> '' AND NOT {is_heading(d, x)} AND NOT {is_caption(d, x)} AND NOT {is_metadata(d, x)} AND NOT {d.rx(d.strip(x), URLISH)}"
    return f"({plain(a)} AND {plain(b)} AND NOT {d.ends(d.strip(a), ':')} AND ({d.rx(d.strip(b), '^[a-z]')} OR {d.ends(d.rstrip(a), '-')}))"


def merge(d: Dialect, a: str, b: str) -> str:
    a, b = d.strip(a), d.strip(b)
    return f"CASE WHEN {d.ends(a, '-')} AND {d.lower_start(b)} THEN concat(substring({a}, 1, CAST(length({a}) - 1 AS INT)), {b}) ELSE {d.strip(f'concat({a}, {d.text(chr(32))}, {b})')} END"


def tidy(d: Dialect, x: str) -> str:
    """No white space before punctuation."""
    return d.sub(x, r"\s+([,.;:?!])", "\\1")


def caption_part(d: Dialect, x: str, group: int) -> str:
    """A caption with prose behind it, cut at the last sentence end before a small letter: 1 the caption, 2 the prose; null if not mixed."""
    s = d.strip(x)
    return f"CASE WHEN {d.any_of(s, PANELS)} AND {d.rx(s, MIXED)} THEN {d.strip(d.extract(s, MIXED, group))} END"


def is_caption_tail(d: Dialect, x: str) -> str:
    s = d.strip(x)
    return f"({d.lower_start(s)} AND {d.any_of(s, PANELS)})"


def is_suspicious(d: Dialect, x: str) -> str:
    """Words broken by extraction, metadata, line breaks or several captions in one block."""
    broken = r"(?:^|[^\p{L}\p{N}_])[a-z]{1,4}[A-Z]{2,}|[\p{L}\p{N}_]-$"
    several = f"({d.count(x, 'Figure ')} + {d.count(x, 'Table ')} > 1)"
    if d.name == "spark":
        inside = f"({d.rx(x, '[a-z][A-Z][A-Z]')} AND {d.rx(x, r'(?:^|[^\p{L}\p{N}_])[a-z]{1,4}[A-Z]{2,}')})"
        cut = f"({d.ends(x, '-')} AND {d.rx(f'right({x}, 2)', r'[\p{L}\p{N}_]-$')})"
        held = f"(({d.has(x, 'Figure ')} OR {d.has(x, 'Table ')}) AND {several})"
        stripped = d.trimmed(x) if x.isidentifier() else d.strip(x)
        return d.let("s_", stripped, f"(s_ <> '' AND NOT {d.rx('s_', HEADING)} AND ({_metadata_of(d, 's_')} OR {inside} OR {cut} OR ({d.has(x, chr(10))} AND NOT {d.rx('s_', CAPTION)}) OR {held}))")
    return f"({d.strip(x)} <> '' AND NOT {is_heading(d, x)} AND ({is_metadata(d, x)} OR {d.rx(x, broken)} OR ({d.has(x, chr(10))} AND NOT {is_caption(d, x)}) OR {several}))"


def blocks(d: Dialect, x: str) -> str:
    """Blocks between blank lines, stripped, without empty ones."""
    nl = chr(10)
    clean = f"replace(replace({x}, {d.text(chr(13) + nl)}, {d.text(nl)}), {d.text(chr(13))}, {d.text(nl)})"
    if d.name == "spark":
        clean = d.let("c_", x, f"CASE WHEN {d.has('c_', chr(13))} THEN replace(replace(c_, {d.text(chr(13) + nl)}, {d.text(nl)}), {d.text(chr(13))}, {d.text(nl)}) ELSE c_ END")
    return d.filter(d.map(d.split(clean, nl + nl), "b", d.trimmed("b")), "b", "b <> ''")
