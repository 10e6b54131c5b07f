"""Assembly: text choice, headings and Markdown rendering, as portable expressions."""

from __future__ import annotations

from .dialect import Dialect
from .translation import SOURCE_STOPS, TARGET_STOPS, is_truncated, strip_meta

# Markers that a model's answer must not hold, CJK ranges, heading patterns.
ARTIFACTS = ("Translate the following academic paper passage", "Translate each academic paper block", "Rules:", "Passage:", "<BLOCK ", "[TRANSLATION_ERROR:")
CJK = "[㐀-䶿一-鿿豈-﫿]"
HAN = "[㐀-鿿]"
SECTION_NUMBER = r"^([0-9]+(?:\.[0-9]+)*|[A-Z])\s+(.+)$"
APPENDIX = r"^[Aa][Pp][Pp][Ee][Nn][Dd][Ii][Xx]\s+([A-Z])(?::\s*(.+))?$"
BAD_HEADING = r"^(?:[0-9]+(?:\.[0-9]+)*\s+[A-Z]?|[0-9]+(?:\.[0-9]+)+\s+[A-Za-z0-9 .-]{0,20})$"
# Headings with a known translation; a caller's own table may replace them.
HEADINGS = {
    "Are LLMs Good Safety Agents or a Propaganda Engine?": "LLM 是優秀的安全代理，還是宣傳引擎？",
    "Abstract": "摘要",
    "References": "參考文獻",
    "Appendix": "附錄",
    "Introduction": "導論",
    "Problem De nition": "問題定義",
    "Problem Definition": "問題定義",
    "Refusals": "拒答",
    "Refusal versus Censorship": "拒答與審查",
    "Related Work": "相關工作",
    "Existing, Scope-Limited Data Sources": "既有且範圍受限的資料來源",
    "Our Data Construction Method": "我們的資料建構方法",
    "Data Statistics of PSP": "PSP 的資料統計",
    "Data-driven approach": "資料驅動方法",
    "Representation-level approach": "表徵層級方法",
    "Prompt Injection Attacks": "提示注入攻擊",
    "Experimental Setup": "實驗設定",
    "Discussion": "討論",
    "RQ1: Impact of de-politicization": "RQ1：去政治化的影響",
    "RQ2: Prompt injection attacks and partial refusals": "RQ2：提示注入攻擊與部分拒答",
    "Conclusion": "結論",
}


def has_cjk(d: Dialect, x: str) -> str:
    return d.rx(x, CJK)


def archival(d: Dialect, x: str) -> str:
    """Line feeds only, blanks collapsed and off line ends, at most one blank line running."""
    nl = chr(10)
    if d.name == "spark":  # patterns that match only what changes
        feeds = f"replace(replace(a_, {d.text(chr(13) + nl)}, {d.text(nl)}), {d.text(chr(13))}, {d.text(nl)})"
        blanks = d.sub("a_", r"[ \t]{2,}|\t", " ")
        lines = d.sub(d.sub("a_", r" +\n *|\n +", nl), r"\n{3,}", nl + nl)
        x = d.let("a_", x, d.let("a_", f"CASE WHEN {d.has('a_', chr(13))} THEN {feeds} ELSE a_ END", d.trimmed("a_")))
        return d.let("a_", x, d.let("a_", f"CASE WHEN {d.has('a_', '  ')} OR {d.has('a_', chr(9))} THEN {blanks} ELSE a_ END", d.let("a_", f"CASE WHEN {d.has('a_', nl)} THEN {lines} ELSE a_ END", d.trimmed("a_"))))
    x = d.strip(f"replace(replace({x}, {d.text(chr(13) + nl)}, {d.text(nl)}), {d.text(chr(13))}, {d.text(nl)})")
    return d.strip(d.sub(d.sub(d.sub(x, r"[ \t]+", " "), r" *\n *", nl), r"\n{3,}", nl + nl))


def study(d: Dialect, x: str) -> str:
    return archival(d, d.sub(x, r"\[TRANSLATION_ERROR:[^\]]+\]\s*"))


def one_line(d: Dialect, x: str) -> str:
    """Layout text: words cut by a hyphen at a line's end joined, all white space one blank."""
    return d.strip(d.sub(d.sub(d.sub(x, r"-\n([a-z])", "\\1"), r"\s*\n\s*", " "), r"[ \t]+", " "))


def lines_of(d: Dialect, x: str) -> str:
    return d.filter(d.map(d.split(x, chr(10)), "l", d.strip("l")), "l", "l <> ''")


def has_duplicate_lines(d: Dialect, x: str) -> str:
    a = lines_of(d, x)
    return f"({d.size(a)} >= 3 AND {d.size(d.distinct(a))} <= greatest(1, {d.idiv(d.size(a), '2')}))"


def is_suspicious(d: Dialect, source: str, translated: str, kind: str) -> str:
    """source and translated: archival()."""
    t = translated
    return (
        f"({t} = '' OR {d.any_of(t, ARTIFACTS)} OR {has_duplicate_lines(d, t)} OR length({t}) > greatest(length({source}) * 4, 1200) OR {d.count(t, '§PROTECTED_')} >= 2"
        f" OR ({kind} = 'heading' AND {d.in_(source, HEADINGS)} AND NOT {has_cjk(d, t)}))"
    )


def known_heading(d: Dialect, x: str) -> str:
    if d.name == "spark":
        return f"try_element_at(map({', '.join(f'{d.text(a)}, {d.text(b)}' for a, b in HEADINGS.items())}), {x})"
    return f"CASE {x} " + " ".join(f"WHEN {d.text(a)} THEN {d.text(b)}" for a, b in HEADINGS.items()) + " END"


def heading_text(d: Dialect, source: str, translated: str) -> str:
    """Dictionary, appendix, numbered title from the dictionary, first line of a sound draft, source. Both: archival()."""
    rest = d.strip(d.extract(source, APPENDIX, 2))
    tail = d.strip(d.extract(source, SECTION_NUMBER, 2))
    number = d.extract(source, SECTION_NUMBER, 1)
    first = d.strip(d.at(d.split(translated, chr(10)), 1))
    known = known_heading(d, source)
    return (
        f"CASE WHEN ({known}) IS NOT NULL THEN {known}"
        f" WHEN {d.rx(source, APPENDIX)} THEN concat('附錄 ', {d.extract(source, APPENDIX, 1)}, CASE WHEN {rest} <> '' THEN concat('：', coalesce({known_heading(d, rest)}, {rest})) ELSE '' END)"
        f" WHEN {d.rx(source, SECTION_NUMBER)} AND ({known_heading(d, tail)}) IS NOT NULL THEN concat({number}, CASE WHEN {d.rx(number, '^[0-9]')} THEN ' ' ELSE '' END, {known_heading(d, tail)})"
        f" WHEN {has_cjk(d, translated)} AND NOT {is_suspicious(d, source, translated, d.text('heading'))} AND {first} <> '' THEN {first} ELSE {source} END"
    )


def archival_choice(d: Dialect, source: str, preferred: str, kind: str) -> str:
    """source, preferred (repaired, else translated): archival()."""
    return f"CASE WHEN {kind} = 'heading' THEN {heading_text(d, source, preferred)} WHEN {preferred} <> '' AND NOT {is_suspicious(d, source, preferred, kind)} THEN {preferred} ELSE {source} END"


def study_choice(d: Dialect, source: str, preferred: str, kind: str) -> str:
    """source: study(); preferred: study(strip_meta())."""
    weak = (
        f"{is_truncated(d, source, preferred, kind)} AND (length({preferred}) < greatest(60, CAST(floor(length({source}) * CAST(0.18 AS DOUBLE)) AS BIGINT))"
        f" OR ({d.count(source, SOURCE_STOPS)} >= 2 AND {d.count(preferred, TARGET_STOPS)} = 0))"
    )
    return (
        f"CASE WHEN {kind} = 'heading' THEN CASE WHEN {has_cjk(d, preferred)} THEN {preferred} ELSE {source} END WHEN {d.in_(kind, ('equation', 'code'))} THEN {source}"
        f" WHEN NOT {has_cjk(d, preferred)} OR ({weak}) THEN {source} ELSE {preferred} END"
    )


def preferred_study(d: Dialect, repaired: str, translated: str) -> str:
    a, b = study(d, strip_meta(d, f"coalesce({repaired}, '')")), study(d, strip_meta(d, f"coalesce({translated}, '')"))
    return f"coalesce(nullif({a}, ''), {b})"


def is_bad_heading(d: Dialect, x: str) -> str:
    """x: study()."""
    return f"CASE WHEN {x} = '' THEN true WHEN {d.starts(x, '## References')} OR {d.in_(x, ('參考文獻', '摘要', 'Abstract'))} THEN false WHEN {d.rx(x, BAD_HEADING)} THEN true ELSE length({x}) < 2 END"


def dots(section: str) -> str:
    return f"CAST(length({section}) - length(replace({section}, '.', '')) AS INT)"


def level(d: Dialect, section: str) -> str:
    """Archival heading level; a null section counts as other."""
    s = f"coalesce({section}, '')"
    return f"CASE WHEN {s} = 'title' THEN 1 WHEN {d.rx(s, '^[0-9]')} THEN least(2 + {dots(s)}, 6) ELSE 2 END"


def study_level(d: Dialect, section: str) -> str:
    s = f"coalesce({section}, '')"
    return f"CASE WHEN {s} = 'title' THEN 1 WHEN {d.in_(s, ('abstract', 'references'))} OR {dots(s)} = 0 THEN 2 ELSE 3 END"


def rendered(d: Dialect, text: str, kind: str, section: str) -> str:
    nl = d.text(chr(10))
    return (
        f"CASE {kind} WHEN 'heading' THEN concat(repeat('#', {level(d, section)}), ' ', {text}) WHEN 'equation' THEN concat('$$', {nl}, {text}, {nl}, '$$') WHEN 'code' THEN concat('```', {nl}, {text}, {nl}, '```')"
        f" WHEN 'figure' THEN concat('> [Figure] ', {text}) WHEN 'table' THEN concat('> [Table] ', {text}) WHEN 'reference' THEN concat('- ', {text}) ELSE {text} END"
    )


def study_rendered(d: Dialect, text: str, kind: str, section: str) -> str:
    """Null: the row is left out."""
    return (
        f"CASE WHEN {text} = '' THEN NULL WHEN {kind} = 'unknown' AND {d.in_(d.strip(text), ('*Equal contribution', 'Equal contribution'))} THEN NULL"
        f" WHEN {kind} = 'heading' THEN CASE WHEN {is_bad_heading(d, text)} THEN NULL WHEN {d.in_(text, ('參考文獻', 'References'))} THEN '## 參考文獻' WHEN {d.rx(text, '^#{1,3} ')} THEN {text}"
        f" ELSE concat(repeat('#', {study_level(d, section)}), ' ', {text}) END"
        f" WHEN {kind} = 'figure' THEN concat('> [Figure] ', {text}) WHEN {kind} = 'table' THEN concat('> [Table] ', {text}) WHEN {kind} = 'reference' THEN concat('- ', {text}) ELSE {text} END"
    )
