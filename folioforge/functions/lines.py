"""Predicates and classes of single lines, as portable expressions (x: SQL of a string)."""

from __future__ import annotations

from .dialect import SPARK, Dialect

# Markers, symbols and words that decide a line's class.
CONTENT_MARKER = "## Extracted Content"
TITLE_LINE = "# Source Extracted Text"
SOURCE_PREFIX = "Source PDF:"
NUMBERED = r"^[0-9]+(?:\.[0-9]+)*\s+\S"
APPENDIX = r"^[A-Z]\s+[A-Z][A-Za-z0-9].+"
MARKDOWN = r"^(#{1,6})\s+(.*\S)\s*$"
FIGURE = r"^Figure\s+[0-9]+:"
TABLE = r"^Table\s+[0-9]+:"
SYMBOL = r"\$.*\$|[=+×*/^_<>≤≥∈∑∏λµβγδθ]"
STRONG_SYMBOLS = ("∈", "∑", "∏", "≤", "≥", "^", "_")
PANELS = ("Upper Right:", "Lower Right:", "Left:", "Right:")
NOTE = r"^[*†‡].*$"


def words(d: Dialect, x: str) -> str:
    """Number of words between white space."""
    return d.count(x, r"\S+")


def _replaced(d: Dialect, x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {d.text(a)}, {d.text(b)})"
    return x


def normalize_whitespace(d: Dialect, x: str) -> str:
    return _replaced(d, x, BLANK_FORMS)


def normal_columns(x: str = "text") -> list[str]:
    """normalize_whitespace() of a column in Spark, a step after another over the column itself: texts without a carriage return, or of ASCII alone, are not searched for each form."""
    d = SPARK
    return [
        f"CASE WHEN {d.has(x, chr(13))} THEN {_replaced(d, x, BLANK_FORMS[:2])} ELSE {x} END",
        f"CASE WHEN length({x}) = octet_length({x}) THEN {x} ELSE {_replaced(d, x, BLANK_FORMS[2:-2])} END",
        f"CASE WHEN {d.has(x, chr(9))} OR {d.has(x, chr(12))} THEN {_replaced(d, x, BLANK_FORMS[-2:])} ELSE {x} END",
    ]


BLANK_FORMS = (("\r\n", "\n"), ("\r", "\n"), ("﻿", ""), (" ", " "), (" ", " "), (" ", " "), ("​", ""), ("‌", ""), ("‍", ""), ("⁠", ""), ("\t", " "), ("\f", "\n\n"))


def unwrap(d: Dialect, x: str) -> str:
    """What follows the content marker, stripped; all where there is none."""
    m = d.text(CONTENT_MARKER)
    after = f"substring({x}, {'instr' if d.name == 'spark' else 'strpos'}({x}, {m}) + {len(CONTENT_MARKER)})"
    return f"CASE WHEN {d.has(x, CONTENT_MARKER)} THEN {d.strip(after)} ELSE {d.strip(x)} END"


def wrap(d: Dialect, x: str, name: str) -> str:
    return f"concat({d.text(TITLE_LINE)}, {d.text(chr(10) * 2 + SOURCE_PREFIX + ' ')}, {name}, {d.text(chr(10) * 2 + CONTENT_MARKER + chr(10) * 2)}, {d.strip(x)}, {d.text(chr(10))})"


def is_noise(d: Dialect, x: str) -> str:
    s = d.strip(x)
    return f"(length({s}) = 1 OR {d.rx(s, r'^[\[\].:]+$')})"


def is_heading_text(d: Dialect, x: str) -> str:
    s = d.strip(x)
    capital = d.count(s, r"(?:^|\s)\p{Lu}")
    n = words(d, s)
    return f"({s} <> '' AND ({d.in_(s, ('Abstract', 'References'))} OR {d.rx(s, r'^[A-Z] [A-Za-z].*$')} OR {d.rx(s, r'^[0-9]+(?:\.[0-9]+)* [A-Z][A-Za-z0-9,\-–()/\x27 ]+$')} OR ({n} BETWEEN 1 AND 8 AND {capital} >= greatest(1, {n} - 1))))"


def markdown_heading(d: Dialect, x: str) -> str:
    return markdown_of(d, d.strip(x))


def markdown_of(d: Dialect, s: str) -> str:
    """s: the stripped line."""
    put = lambda mark: f"concat({d.text(mark + ' ')}, {s})"
    return (
        f"CASE WHEN {d.in_(s, ('Abstract', 'References'))} THEN {put('##')} WHEN {d.rx(s, r'^[0-9]+ [A-Z].*$')} THEN {put('##')}"
        f" WHEN {d.rx(s, r'^[0-9]+\.[0-9]+ [A-Z].*$')} THEN {put('###')} WHEN {d.rx(s, r'^[0-9]+\.[0-9]+\.[0-9]+ [A-Z].*$')} THEN {put('####')}"
        f" WHEN {d.rx(s, r'^[A-Z] [A-Z].*$')} THEN {put('##')} END"
    )


def is_table_line(d: Dialect, x: str) -> str:
    s = d.strip(x)
    if d.name == "spark":
        return table_of(d, s)
    tokens = d.extract_all(s, r"\S+")
    numeric = d.size(d.filter(tokens, "t", d.rx(d.strip("t", "%,()"), r"^[-+]?[0-9]+(?:\.[0-9]+)?$")))
    return (
        f"({s} <> '' AND ({d.rx(s, r'^(?:Figure|Table)\s+[0-9]+')} OR {d.has(s, '|')} OR {d.rx(s, r'\$[0-9]')} OR {d.rx(s, r'^[0-9.]+$')}"
        f" OR ({d.size(tokens)} >= 4 AND {numeric} >= greatest(2, {d.idiv(d.size(tokens), '2')}))))"
    )


def table_of(d: Dialect, s: str) -> str:
    """is_table_line() of a stripped line s, in Spark: numbers are counted as whole words by one pattern, and only where there are two digits."""
    number = r"(?<!\S)[%,()]*[-+]?[0-9]+(?:\.[0-9]+)?[%,()]*(?!\S)"
    n = words(d, s)
    return (
        f"({s} <> '' AND ({d.has(s, '|')} OR {d.rx(s, r'^(?:Figure|Table)\s+[0-9]+')} OR ({d.has(s, '$')} AND {d.rx(s, r'\$[0-9]')}) OR {d.rx(s, r'^[0-9.]+$')}"
        f" OR ({d.rx(s, '(?s)[0-9].*[0-9]')} AND {d.count(s, number)} >= 2 AND {n} >= 4 AND {d.count(s, number)} >= {d.idiv(n, '2')})))"
    )


def opens_prose(d: Dialect, s: str, md: str, table: str) -> tuple[str, str]:
    """Of a stripped line s: whether it may go on with a paragraph, and whether a paragraph may go on behind it. md: its heading or null; table: whether it is a table line."""
    plain = f"({s} <> '' AND {md} IS NULL AND NOT {table})"
    return plain, f"({plain} AND NOT {d.ends(s, ':')} AND NOT {d.rx(s, NOTE)} AND NOT {d.rx(s, r'^\(?[A-Za-z]?[0-9]+[A-Za-z]?\)?$')})"


def continues_prose(d: Dialect, current: str, following: str) -> str:
    """Whether following belongs to the paragraph that current is in (source cleaning)."""
    c = current
    return (
        f"({c} <> '' AND {following} <> '' AND ({markdown_heading(d, c)}) IS NULL AND ({markdown_heading(d, following)}) IS NULL AND NOT {is_table_line(d, c)} AND NOT {is_table_line(d, following)}"
        f" AND NOT {d.ends(c, ':')} AND NOT {d.rx(c, NOTE)} AND NOT {d.rx(c, r'^\(?[A-Za-z]?[0-9]+[A-Za-z]?\)?$')})"
    )


def heading_name(d: Dialect, x: str) -> str:
    """A heading without its number signs."""
    s = d.strip(x)
    return f"CASE WHEN {d.rx(s, MARKDOWN)} THEN {d.strip(d.extract(s, MARKDOWN, 2))} ELSE {s} END"


def heading_of(d: Dialect, s: str, n: str, before_abstract: str = "false") -> str:
    """s: the stripped line, n: its heading name."""
    return (
        f"({n} <> '' AND NOT {d.in_(s, (TITLE_LINE, CONTENT_MARKER))} AND NOT {d.starts(s, SOURCE_PREFIX)} AND ({d.rx(s, MARKDOWN)} OR {d.in_(n, ('Abstract', 'References'))}"
        f" OR ({before_abstract} AND {d.ends(n, '?')}) OR {d.rx(n, NUMBERED)} OR ({d.rx(n, APPENDIX)} AND length({n}) > 8)))"
    )


def is_heading(d: Dialect, x: str, before_abstract: str = "false") -> str:
    return heading_of(d, d.strip(x), f"({heading_name(d, x)})", before_abstract)


def is_figure(d: Dialect, x: str) -> str:
    return d.rx(d.strip(x), FIGURE)


def is_table(d: Dialect, x: str) -> str:
    return d.rx(d.strip(x), TABLE)


def is_code(d: Dialect, x: str) -> str:
    s = d.strip(x)
    return f"({d.starts(s, '```')} OR ({d.starts(x, '    ')} AND {s} <> ''))"


def equation_of(d: Dialect, s: str, taken: str) -> str:
    """s: the stripped line; taken: whether it is a caption or a heading."""
    n = words(d, s)
    if d.name == "spark":  # what costs little comes first
        few = f"length({s}) <= {{}} AND {n} <= {{}}"
        return (
            f"({s} <> '' AND NOT {taken} AND CASE WHEN {d.starts(s, '$')} AND {d.ends(s, '$')} THEN true"
            f" WHEN {d.has(s, '=')} THEN {few.format(80, 12)} WHEN {d.any_of(s, STRONG_SYMBOLS)} THEN {n} <= 12"
            f" ELSE {few.format(64, 10)} AND {d.count(s, SYMBOL)} >= 2 END)"
        )
    return (
        f"({s} <> '' AND NOT {taken} AND CASE WHEN {d.starts(s, '$')} AND {d.ends(s, '$')} THEN true"
        f" WHEN {d.has(s, '=')} THEN {n} <= 12 AND length({s}) <= 80 WHEN {d.any_of(s, STRONG_SYMBOLS)} THEN {n} <= 12"
        f" ELSE {d.count(s, SYMBOL)} >= 2 AND {n} <= 10 AND length({s}) <= 64 END)"
    )


def is_equation(d: Dialect, x: str) -> str:
    return equation_of(d, d.strip(x), f"({is_figure(d, x)} OR {is_table(d, x)} OR {is_heading(d, x)})")


def is_note(d: Dialect, x: str) -> str:
    return note_of(d, d.strip(x))


def note_of(d: Dialect, s: str) -> str:
    return f"({d.rx(s, NOTE)} OR {s} = 'Equal contribution')"


def class_of(d: Dialect, s: str, heading: str, figure: str, table: str, in_references: str, code: str, equation: str, note: str) -> str:
    """The class of a line s from what it is found to be, the first that holds."""
    return (
        f"CASE WHEN {heading} THEN 'heading' WHEN {figure} THEN 'figure' WHEN {table} THEN 'table' WHEN {in_references} THEN 'reference'"
        f" WHEN {code} THEN 'code' WHEN {equation} THEN 'equation' WHEN {note} THEN 'unknown'"
        f" WHEN length({s}) <= 2 AND NOT {d.rx(s, r'^\p{L}+$')} THEN 'unknown' ELSE 'paragraph' END"
    )


def line_class(d: Dialect, x: str, before_abstract: str, in_references: str) -> str:
    return class_of(d, d.strip(x), is_heading(d, x, before_abstract), is_figure(d, x), is_table(d, x), in_references, is_code(d, x), is_equation(d, x), is_note(d, x))


def caption_goes_on(d: Dialect, previous: str, s: str, starts: str, gap: str) -> str:
    """previous, s: stripped; starts: whether s is a heading, begins a caption or stands in the references."""
    return f"(NOT {starts} AND NOT {d.ends_in(previous, '.!?')} AND (NOT {gap} OR {d.lower_start(s)} OR {d.any_of(s, PANELS)}))"


def continues_caption(d: Dialect, previous: str, x: str, gap: str, before_abstract: str, in_references: str) -> str:
    return caption_goes_on(d, d.strip(previous), d.strip(x), f"({is_heading(d, x, before_abstract)} OR {is_figure(d, x)} OR {is_table(d, x)} OR {in_references})", gap)


def continues_paragraph(d: Dialect, previous: str, x: str, kind: str) -> str:
    """kind: class of x with its flags. Blank lines between do not matter."""
    return paragraph_goes_on(d, d.strip(previous), d.strip(x), kind)


def paragraph_goes_on(d: Dialect, p: str, s: str, kind: str) -> str:
    """p, s: stripped."""
    return (
        f"({d.in_(kind, ('paragraph', 'unknown'))} AND NOT {d.ends_in(p, '.!?:')} AND NOT {d.starts(p, 'Figure ')} AND NOT {d.starts(p, 'Table ')} AND NOT {note_of(d, p)}"
        f" AND NOT (length({s}) <= 3 AND NOT {d.rx(s, r'^\p{L}+$')}))"
    )


def starts_reference(d: Dialect, previous: str, x: str) -> str:
    return reference_of(d, d.strip(previous), d.strip(x))


def reference_of(d: Dialect, p: str, s: str) -> str:
    """p, s: stripped."""
    year = r"(?:^|[^\p{L}\p{N}_])(?:19|20)[0-9]{2}[a-z]?(?:[^\p{L}\p{N}_]|$)"
    held = f"({d.has(s, '19')} OR {d.has(s, '20')}) AND " if d.name == "spark" else ""
    return f"({d.ends(p, '.')} AND {d.rx(s, r'^\p{Lu}')} AND {held}{d.rx(s, year)})"


def section_of(d: Dialect, x: str) -> str:
    """The section value of a heading."""
    n = f"({heading_name(d, x)})"
    number = r"^([0-9]+(?:\.[0-9]+)*)(?:[^\p{L}\p{N}_]|$)"
    letter = r"^([A-Z])(?:[^\p{L}\p{N}_]|$)"
    return (
        f"CASE WHEN {d.in_(n, ('Abstract', 'References'))} THEN lower({n}) WHEN {d.rx(n, number)} THEN {d.extract(n, number)}"
        f" WHEN {d.rx(n, letter)} AND {words(d, n)} >= 2 THEN {d.extract(n, letter)} WHEN {d.ends(n, '?')} THEN 'title' ELSE {n} END"
    )


def clean_text(d: Dialect, x: str = "text") -> str:
    return d.strip(normalize_whitespace(d, x))


def flagged(d: Dialect) -> str:
    """Columns over non-blank lines: previous one, whether a blank line lies between, and the two flags of a paper."""
    w = "OVER (PARTITION BY doc_id ORDER BY line_no"
    held = lambda name: f"{d.has('line', name)} AND " if d.name == "spark" else ""
    seen = lambda name: f"coalesce(max(CASE WHEN {held(name)}{heading_name(d, 'line')} = '{name}' THEN 1 ELSE 0 END) {w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1"
    return (
        f"doc_id, line_no, line, lag(line) {w}) AS previous, coalesce(line_no - lag(line_no) {w}) > 1, false) AS gap,"
        f" NOT ({seen('Abstract')}) AS before_abstract, {seen('References')} AS in_references"
    )
