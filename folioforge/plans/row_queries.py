"""Queries of one row each: classifiers, text functions, validators. Key: operator id and name."""

from __future__ import annotations

from functools import partial

from ..functions import assembly, lines, repair, translation, validation
from ..functions.dialect import DUCK, SPARK
from . import bases

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_BASES = {
    "documents": (lambda s, d: bases.read(s, d, "documents"), "", "documents", ("doc_id",)),
    "papers": (bases.papers, bases.PAPERS, "papers", ("doc_id",)),
    "lines": (bases.paper_lines, bases.LINES, "lines", ("doc_id", "line_no")),
    "prose": (bases.prose_lines, bases.PROSE, "prose", ("doc_id", "line_no")),
    "pairs": (bases.pairs, bases.PAIRS, "pairs", ("doc_id",)),
}


def _run(base, keys, columns, where, given, spark, sf_dir):
    df = _BASES[base][0](spark, sf_dir)
    if where:
        df = df.where(where(SPARK))
    if given:
        df = df.selectExpr("*", *[f"{f(SPARK)} AS {name}" for name, f in given.items()])
    return df.selectExpr(*keys, *[f"{f(SPARK)} AS {name}" for name, f in columns.items()])


def add(key: str, base: str, where=None, given=None, **columns) -> None:
    """columns: name -> function of a dialect that gives an expression over the columns of the base and over those of given, which are made once before."""
    _, ctes, table, keys = _BASES[base]
    QUERIES[key] = partial(_run, base, keys, columns, where, given)
    shown = ", ".join([*keys, *[f"{f(DUCK)} AS {name}" for name, f in columns.items()]])
    rows = f"{table}" + (f" WHERE {where(DUCK)}" if where else "")
    if given:
        rows = f"(SELECT *, {', '.join(f'{f(DUCK)} AS {name}' for name, f in given.items())} FROM {rows})"
    ORACLES[key] = (f"WITH {ctes} " if ctes else "") + f"SELECT {shown} FROM {rows}"


# Sources and sinks as text
add("a05_wrapped_markdown", "documents", wrapped=lambda d: d.md5(lines.wrap(d, "text", "source")))
add("a06_unwrap_content", "documents", content=lambda d: d.md5(lines.unwrap(d, f"CASE WHEN doc_id % 2 = 0 THEN {lines.wrap(d, 'text', 'source')} ELSE text END")))

# Lines
add("b01_vertical_noise", "lines", noise=lambda d: lines.is_noise(d, "line"))
add("b03_heading_text", "lines", heading=lambda d: lines.is_heading_text(d, "line"))
add("b04_markdown_heading", "lines", heading=lambda d: lines.markdown_heading(d, "line"))
add("b05_table_line", "lines", table_line=lambda d: lines.is_table_line(d, "line"))
add("b06_continue_clean_paragraph", "prose", joins=lambda d: lines.continues_prose(d, "coalesce(previous, '')", "line"))
add("b07_is_heading", "prose", heading=lambda d: lines.is_heading(d, "line", "before_abstract"))
add("b08_figure_table_start", "lines", figure=lambda d: lines.is_figure(d, "line"), starts_table=lambda d: lines.is_table(d, "line"))
add("b09_code_line", "lines", code=lambda d: lines.is_code(d, "line"))
add("b10_equation_line", "lines", equation=lambda d: lines.is_equation(d, "line"))
add("b11_metadata_noise", "lines", note=lambda d: lines.is_note(d, "line"))
add("b12_line_classes", "prose", kind=lambda d: lines.line_class(d, "line", "before_abstract", "in_references"))
add("b13_continue_caption", "prose", joins=lambda d: lines.continues_caption(d, "coalesce(previous, '')", "line", "gap", "before_abstract", "in_references"))
add("b14_continue_paragraph", "prose", joins=lambda d: lines.continues_paragraph(d, "coalesce(previous, '')", "line", f"({lines.line_class(d, 'line', 'before_abstract', 'in_references')})"))
add("b15_new_reference", "prose", starts=lambda d: lines.starts_reference(d, "coalesce(previous, '')", "line"))
add("b16_block_kind", "lines", kind=lambda d: repair.kind(d, "line"))
add("b17_can_merge", "prose", merges=lambda d: repair.can_merge(d, "coalesce(previous, '')", "line"))
add("b18_suspicious_english", "prose", suspicious=lambda d: repair.is_suspicious(d, f"concat(coalesce(previous, ''), CASE WHEN line_no % 3 = 0 THEN {d.text(chr(10))} ELSE ' ' END, line)"))
add("e02_state_flags", "prose", before=lambda d: "before_abstract", refs=lambda d: "in_references", gap=lambda d: "gap")
add("e17_caption_body_split", "lines", caption=lambda d: repair.caption_part(d, "line", 1), body=lambda d: repair.caption_part(d, "line", 2))
add("h04_heading_name", "lines", name=lambda d: lines.heading_name(d, "line"))
add("h05_section_value", "lines", section=lambda d: lines.section_of(d, "line"), where=lambda d: f"{d.strip('line')} <> ''")
add("h13_merge_pair", "prose", merged=lambda d: d.md5(repair.tidy(d, repair.merge(d, "coalesce(previous, '')", "line"))))
add("h21_caption_anchor", "lines", kind=lambda d: f"lower({d.extract(d.strip('line'), '^([Ff]igure|[Tt]able)[ ]*([0-9]+)[:：]', 1)})", number=lambda d: d.extract(d.strip("line"), "^([Ff]igure|[Tt]able)[ ]*([0-9]+)[:：]", 2), where=lambda d: d.rx(d.strip("line"), "^([Ff]igure|[Tt]able)[ ]*([0-9]+)[:：]"))
add("h25_caption_tail", "lines", tail=lambda d: repair.is_caption_tail(d, "line"))

# Texts
add("h01_normalize_whitespace", "papers", text_hash=lambda d: d.md5(lines.normalize_whitespace(d, "text")))
add("h02_normalize_text", "papers", archival=lambda d: d.md5(assembly.archival(d, "text")), study=lambda d: d.md5(assembly.study(d, "concat('[TRANSLATION_ERROR:b9] ', text)")), layout=lambda d: d.md5(assembly.one_line(d, "text")))
add("h24_split_blocks", "papers", n_blocks=lambda d: d.size(repair.blocks(d, "text")), hash=lambda d: d.md5(d.join(repair.blocks(d, "text"), "|")))
add("b22_duplicate_lines", "documents", given={"rows": lambda d: assembly.lines_of(d, "text")}, n_lines=lambda d: d.size("rows"), n_distinct=lambda d: d.size(d.distinct("rows")), duplicate=lambda d: f"({d.size('rows')} >= 3 AND {d.size(d.distinct('rows'))} <= greatest(1, {d.idiv(d.size('rows'), '2')}))")
add("d08_latin_density", "documents", letters=lambda d: translation.latin_letters(d, "text"), density=lambda d: f"round({translation.latin_density(d, 'text')}, 6)")
add("d09_sentence_counts", "documents", source_stops=lambda d: d.count("text", translation.SOURCE_STOPS), target_stops=lambda d: d.count("text", translation.TARGET_STOPS))
add("h06_protect_spans", "papers", n_protected=lambda d: d.size(translation.protected_spans(d, "text")), masked_hash=lambda d: d.md5(translation.masked(d, "text")))
add("c12_restore_spans", "papers", same=lambda d: f"{translation.restored(d, translation.masked(d, 'text'), translation.protected_spans(d, 'text'))} = text")
_marks = lambda d: d.text("§PROTECTED_1§ §PROTECTED_0§ §PROTECTED_0§ §PROTECTED_11§")
add("h07_restore_text", "papers", given={"spans": lambda d: translation.protected_spans(d, "text")}, restored=lambda d: translation.restored(d, _marks(d), "spans"))
add("f07_snippets", "documents", error=lambda d: "substr(text, 1, 400)", fallback=lambda d: d.md5("substr(text, 1, 500)"))
add("h09_join_broken_words", "papers", joined=lambda d: d.md5(validation.joined_words(d, "text")))

# Drafts of translations
add("b19_suspicious_block", "pairs", suspicious=lambda d: translation.is_suspicious(d, "source", "translated", "kind"))
add("b20_truncated_translation", "pairs", truncated=lambda d: translation.is_truncated(d, "source", "translated", "kind"))
_ARCHIVAL = {"s": lambda d: assembly.archival(d, "source"), "t": lambda d: assembly.archival(d, "translated"), "p": lambda d: assembly.archival(d, "coalesce(repaired, translated)")}
_given = lambda *names: {n: _ARCHIVAL[n] for n in names}
_STUDY = {"s": lambda d: assembly.study(d, "source")}
add("b21_suspicious_translation", "pairs", given=_given("s", "t"), suspicious=lambda d: assembly.is_suspicious(d, "s", "t", "kind"))
add("b23_bad_heading", "pairs", given=_STUDY, bad=lambda d: assembly.is_bad_heading(d, "s"), where=lambda d: "kind = 'heading'")
add("b24_translatable", "pairs", asks=lambda d: f"({d.in_('kind', translation.TRANSLATABLE)} AND {d.strip('translated')} = '')", kept=lambda d: d.md5(f"CASE WHEN {d.in_('kind', translation.TRANSLATABLE)} THEN translated ELSE source END"))
add("b26_validate_translation", "pairs", reason=lambda d: validation.reason(d, "source", "translated"))
add("b28_contains_chinese", "pairs", chinese=lambda d: assembly.has_cjk(d, "translated"))
add("b29_study_row_dropped", "pairs", given=_STUDY, dropped=lambda d: f"({assembly.study_rendered(d, 's', 'kind', 'section')}) IS NULL")
add("b31_dangling_placeholder", "pairs", dangling=lambda d: validation.has_dangling(d, "translated"))
add("c14_foreign_words", "pairs", words=lambda d: d.join(validation.suspicious_words(d, "source", "translated"), ","))
add("f06_first_foreign_words", "pairs", words=lambda d: d.join(d.slice(validation.suspicious_words(d, "source", "translated"), 8), ","))
add("g05_placeholder_equality", "pairs", given={"a": lambda d: validation.placeholders(d, "source"), "b": lambda d: validation.placeholders(d, "translated")}, ordered=lambda d: "(a = b)", unordered=lambda d: f"({d.sort('a')} = {d.sort('b')})")
add("h03_heading_levels", "pairs", archival=lambda d: assembly.level(d, "section"), study=lambda d: assembly.study_level(d, "section"))
add("h08_strip_meta_prefix", "pairs", text_hash=lambda d: d.md5(translation.strip_meta(d, "translated")))
add("h10_placeholders", "pairs", found=lambda d: d.join(validation.placeholders(d, "source"), ","))
add("h14_prompt", "pairs", prompt=lambda d: d.md5(translation.prompt(d, "source", "kind", "section", "0", "doc_id % 3 + 1", translation.guidance_line(d, "'PSP'", "'preserve'", "NULL"))))
add("h16_heading_text", "pairs", given=_given("s", "p"), heading=lambda d: assembly.heading_text(d, "s", "p"), where=lambda d: "kind = 'heading'")
add("h17_archival_choice", "pairs", given=_given("s", "p"), text_hash=lambda d: d.md5(assembly.archival_choice(d, "s", "p", "kind")))
add("h18_study_choice", "pairs", given={**_STUDY, "p": lambda d: assembly.preferred_study(d, "repaired", "translated")}, text_hash=lambda d: d.md5(assembly.study_choice(d, "s", "p", "kind")))
add("h19_render_block", "pairs", given={**_given("s"), "y": _STUDY["s"]}, block=lambda d: d.md5(assembly.rendered(d, "s", "kind", "section")), study=lambda d: d.md5(f"coalesce({assembly.study_rendered(d, 'y', 'kind', 'section')}, '')"))
add("c03_heading_dictionary", "pairs", given=_given("s"), known=lambda d: assembly.known_heading(d, "s"), where=lambda d: "kind = 'heading'")
add("f09_first_line", "pairs", line=lambda d: d.at(d.split("translated", chr(10)), 1))
