"""Lines to typed blocks with sections, cleaned paragraphs, rendered documents.

Everything is keyed by doc_id; a paper's lines meet in one row only to be
folded, which a paper's length bounds. Rows come from papers without order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import assembly, lines
from ..functions.dialect import SPARK, Dialect, columns_of
from .template import Operator, folded

NL = chr(10)


def lines_of(texts: DataFrame) -> DataFrame:
    """texts (doc_id, text) -> (doc_id, line_no, line): lines of the cleaned text, counted from 1, without blanks at their ends."""
    clean = texts.select("doc_id", "text")
    for step in [*lines.normal_columns("text"), SPARK.trimmed("text")]:
        clean = clean.selectExpr("doc_id", f"{step} AS text")
    return clean.select("doc_id", F.posexplode(F.split("text", NL)).alias("pos", "line")).selectExpr("doc_id", "CAST(pos + 1 AS BIGINT) AS line_no", f"{SPARK.rtrimmed('line')} AS line")


def prose_of(numbered: DataFrame) -> DataFrame:
    """The lines that are not blank, each with the one before it, whether a blank line lies between, and the flags of its paper."""
    return numbered.where(f"{SPARK.trimmed('line')} <> ''").selectExpr(*columns_of(lines.flagged(SPARK)))


def _typed(d: Dialect) -> str:
    """(doc_id, line_no, line, kind and whether a block of each state goes on with the line). What a line is found to be is made once, as columns."""
    if d.name == "spark":
        return _typed_spark(d)
    stripped = f"SELECT doc_id, line_no, line, gap, before_abstract, in_references, {d.strip('line')} AS s, {lines.heading_name(d, 'line')} AS n, coalesce(previous, '') AS previous, {d.strip('coalesce(previous, ' + d.text('') + ')')} AS p FROM @prose@"
    found = (
        f"SELECT *, {lines.heading_of(d, 's', 'n')} AS head, {lines.heading_of(d, 's', 'n', 'before_abstract')} AS head_here, {d.rx('s', lines.FIGURE)} AS figure, {d.rx('s', lines.TABLE)} AS is_table,"
        f" {lines.is_code(d, 'line')} AS code, {lines.is_note(d, 's')} AS note FROM ({stripped})"
    )
    marked = f"SELECT *, {lines.equation_of(d, 's', '(figure OR is_table OR head)')} AS equation FROM ({found})"
    classed = f"SELECT *, {lines.class_of(d, 's', 'head_here', 'figure', 'is_table', 'in_references', 'code', 'equation', 'note')} AS kind FROM ({marked})"
    return (
        f"SELECT doc_id, line_no, line, kind, {lines.caption_goes_on(d, 'p', 's', '(head_here OR figure OR is_table OR in_references)', 'gap')} AS caption,"
        f" equation, code, NOT head AND NOT {lines.starts_reference(d, 'previous', 'line')} AS reference, {lines.continues_paragraph(d, 'previous', 'line', 'kind')} AS prose FROM ({classed})"
    )


def _typed_spark(d: Dialect) -> str:
    """The same over stripped lines that are columns, so that what costs little is asked of them first."""
    stripped = f"SELECT doc_id, line_no, line, gap, before_abstract, in_references, {d.trimmed('line')} AS s, coalesce({d.trimmed('previous')}, '') AS p FROM @prose@"
    named = f"SELECT *, CASE WHEN {d.rx('s', lines.MARKDOWN)} THEN {d.strip(d.extract('s', lines.MARKDOWN, 2))} ELSE s END AS n FROM ({stripped})"
    found = (
        f"SELECT *, {lines.heading_of(d, 's', 'n')} AS head, before_abstract AND {d.ends('n', '?')} AND {lines.heading_of(d, 's', 'n', 'true')} AS asks, {d.rx('s', lines.FIGURE)} AS figure, {d.rx('s', lines.TABLE)} AS is_table,"
        f" ({d.starts('s', '```')} OR ({d.starts('line', '    ')} AND s <> '')) AS code, {lines.note_of(d, 's')} AS note FROM ({named})"
    )
    marked = f"SELECT *, (head OR asks) AS head_here, {lines.equation_of(d, 's', '(figure OR is_table OR head)')} AS equation FROM ({found})"
    classed = f"SELECT *, {lines.class_of(d, 's', 'head_here', 'figure', 'is_table', 'in_references', 'code', 'equation', 'note')} AS kind FROM ({marked})"
    return (
        f"SELECT doc_id, line_no, s AS line, kind, {lines.caption_goes_on(d, 'p', 's', '(head_here OR figure OR is_table OR in_references)', 'gap')} AS caption,"
        f" equation, code, NOT head AND NOT {lines.reference_of(d, 'p', 's')} AS reference, {lines.paragraph_goes_on(d, 'p', 's', 'kind')} AS prose FROM ({classed})"
    )


_GOES_ON = "CASE {s} WHEN 'figure' THEN {x}.caption WHEN 'table' THEN {x}.caption WHEN 'equation' THEN {x}.equation WHEN 'code' THEN {x}.code WHEN 'reference' THEN {x}.reference WHEN 'paragraph' THEN {x}.prose WHEN 'unknown' THEN {x}.prose ELSE false END"


def _numbered(d: Dialect) -> str:
    """(doc_id, line_no, line, state, block): a block goes on as long as the rule of its state holds."""
    if d.name == "spark":
        on = _GOES_ON.format(s="@s.state", x="x")
        state, block = f"CASE WHEN {on} THEN @s.state ELSE x.kind END", f"CASE WHEN {on} THEN @s.block ELSE @s.block + 1 END"
        fold = folded(
            "ls",
            "named_struct('state', '', 'block', 0)",
            f"named_struct('state', {state}, 'block', {block})",
            f"array(named_struct('line_no', x.line_no, 'line', x.line, 'state', {state}, 'block', {block}))",
            "STRUCT<line_no: BIGINT, line: STRING, state: STRING, block: INT>",
        )
        return (
            f"typed AS ({_typed(d)}), papers_ AS (SELECT doc_id, array_sort(collect_list(struct(line_no, line, kind, caption, equation, code, reference, prose))) AS ls FROM typed GROUP BY doc_id),"
            f" numbered AS (SELECT doc_id, e.line_no, e.line, e.state, e.block FROM (SELECT doc_id, explode({fold}) AS e FROM papers_))"
        )
    on = _GOES_ON.format(s="f.state", x="t")
    return (
        f"typed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS rn FROM ({_typed(d)})),"
        " fold AS (SELECT doc_id, rn, line_no, line, kind AS state, 1 AS block FROM typed WHERE rn = 1 UNION ALL"
        f" SELECT t.doc_id, t.rn, t.line_no, t.line, CASE WHEN {on} THEN f.state ELSE t.kind END, f.block + CASE WHEN {on} THEN 0 ELSE 1 END FROM fold f JOIN typed t ON t.doc_id = f.doc_id AND t.rn = f.rn + 1),"
        " numbered AS (SELECT doc_id, line_no, line, state, block FROM fold)"
    )


def _blocks(d: Dialect) -> str:
    stripped = d.strip("line")
    if d.name == "spark":  # lines are stripped already; they are collected once
        joined = lambda sep: f"array_join(transform(ls, e -> e.line), {d.text(sep)})"
        number = "format_string('b%06d', block)"
        section = "last(own, true) OVER (PARTITION BY doc_id ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    else:
        joined = lambda sep: f"string_agg({stripped}, {d.text(sep)} ORDER BY line_no)"
        number = "printf('b%06d', block)"
        section = "last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    grouped = (
        f"grouped AS (SELECT doc_id, block, min(state) AS state, {joined(NL)} AS by_line, {joined(' ')} AS by_blank, min(line_no) AS line_start, max(line_no) AS line_end, count(*) AS n_lines, max(length({stripped})) AS longest FROM numbered GROUP BY doc_id, block),"
    )
    if d.name == "spark":
        grouped = (
            "gathered AS (SELECT doc_id, block, min(state) AS state, array_sort(collect_list(struct(line_no, line))) AS ls, min(line_no) AS line_start, max(line_no) AS line_end, count(*) AS n_lines, max(length(line)) AS longest FROM numbered GROUP BY doc_id, block),"
            f" grouped AS (SELECT *, {joined(NL)} AS by_line, {joined(' ')} AS by_blank FROM gathered),"
        )
    return (
        f"{grouped}"
        f" named AS (SELECT doc_id, block, line_start, CASE WHEN state = 'reference' THEN line_start + n_lines - 1 ELSE line_end END AS line_end,"
        f" CASE WHEN state = 'heading' THEN {lines.heading_name(d, 'by_line')} WHEN state IN ('figure', 'table', 'equation', 'code') THEN by_line ELSE by_blank END AS source,"
        f" CASE WHEN state IN ('paragraph', 'unknown') THEN CASE WHEN longest <= 2 OR {lines.is_note(d, 'by_blank')} THEN 'unknown' ELSE 'paragraph' END ELSE state END AS kind,"
        f" CASE WHEN state = 'heading' THEN {lines.section_of(d, 'by_line')} END AS own FROM grouped),"
        f" blocks AS (SELECT doc_id, block, {number} AS block_id, kind, {section} AS section, source, line_start, line_end FROM named)"
    )


def segmented(d: Dialect) -> str:
    """CTEs up to blocks (doc_id, block, block_id, kind, section, source, line_start, line_end)."""
    return f"{_numbered(d)}, {_blocks(d)}"


def over_blocks(select: str):
    """An operator over the prose lines of papers: a select over their blocks."""
    return Operator(lambda d: f"WITH {segmented(d)} {select if isinstance(select, str) else select(d)}")


segment = over_blocks("SELECT doc_id, block, block_id, kind, section, source, line_start, line_end FROM blocks")


# --- cleaned paragraphs ----------------------------------------------------------


def kept_lines(d: Dialect) -> str:
    """CTE kept (doc_id, line_no, line): without noise before the abstract, with split headings joined."""
    first = lambda x: f"first({x}, true)" if d.name == "spark" else f"first_value({x} IGNORE NULLS)"
    ahead = "OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    number = d.rx("line", r"^[0-9]+(?:\.[0-9]+)*$")
    if d.name == "spark":
        # what follows a line is what came last when lines are gone through from the end: a frame up to the end would be read anew for every line
        back = "OVER (PARTITION BY doc_id ORDER BY line_no DESC ROWS BETWEEN UNBOUNDED PRECEDING AND {})"
        ahead = back.format("1 PRECEDING")
        squeezed = f"SELECT doc_id, line_no, {d.trimmed('line')} AS line FROM (SELECT doc_id, line_no, CASE WHEN {d.has('line', '  ')} THEN {d.sub('line', '[ ]{2,}', ' ')} ELSE line END AS line FROM @lines@)"
        return (
            f"squeezed AS ({squeezed}),"
            f" placed AS (SELECT *, min(CASE WHEN line = 'Abstract' THEN line_no END) {back.format('UNBOUNDED FOLLOWING')} AS abstract FROM squeezed),"
            f" front AS (SELECT doc_id, line_no, line FROM placed WHERE NOT (coalesce(line_no < abstract, false) AND {lines.is_noise(d, 'line')})),"
            f" ahead AS (SELECT *, last(nullif(line, ''), true) {ahead} AS following, last(CASE WHEN line <> '' THEN line_no END, true) {ahead} AS following_no FROM front),"
            f" split AS (SELECT *, coalesce({number} AND {lines.is_heading_text(d, 'following')} AND NOT {d.rx('following', '^(?:Figure|Table)[ ]+[0-9]+')}, false) AS joins FROM ahead),"
            " reached AS (SELECT *, max(CASE WHEN joins THEN following_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM split),"
            " kept AS (SELECT doc_id, line_no, CASE WHEN joins THEN concat(line, ' ', following) ELSE line END AS line FROM reached WHERE coalesce(line_no > reach, true))"
        )
    return (
        f"squeezed AS (SELECT doc_id, line_no, {d.strip(d.sub('line', '[ ]{2,}', ' '))} AS line FROM @lines@),"
        f" placed AS (SELECT *, min(CASE WHEN line = 'Abstract' THEN line_no END) OVER (PARTITION BY doc_id) AS abstract FROM squeezed),"
        f" front AS (SELECT doc_id, line_no, line FROM placed WHERE NOT (coalesce(line_no < abstract, false) AND {lines.is_noise(d, 'line')})),"
        f" ahead AS (SELECT *, {first('nullif(line, ' + d.text('') + ')')} {ahead} AS following, {first('CASE WHEN line <> ' + d.text('') + ' THEN line_no END')} {ahead} AS following_no FROM front),"
        f" split AS (SELECT *, coalesce({number} AND {lines.is_heading_text(d, 'following')} AND NOT {d.rx('following', '^(?:Figure|Table)[ ]+[0-9]+')}, false) AS joins FROM ahead),"
        " reached AS (SELECT *, max(CASE WHEN joins THEN following_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM split),"
        " kept AS (SELECT doc_id, line_no, CASE WHEN joins THEN concat(line, ' ', following) ELSE line END AS line FROM reached WHERE coalesce(line_no > reach, true))"
    )


def reflowed(d: Dialect) -> str:
    """CTE cleaned (doc_id, n_blocks, text): paragraphs folded, hyphens undone, one blank line between blocks."""
    w = "OVER (PARTITION BY doc_id ORDER BY line_no)"
    mark = d.text("\x1e")
    if d.name == "spark":
        joined = f"array_join(transform(array_sort(collect_list(struct(line_no, line))), e -> e.line), {mark})"
        document = f"array_join(transform(array_sort(collect_list(struct(island, block))), e -> e.block), {d.text(NL + NL)})"
    else:
        joined = f"string_agg(line, {mark} ORDER BY line_no)"
        document = f"string_agg(block, {d.text(NL + NL)} ORDER BY island)"
    prose = f"replace({d.sub('joined', '-' + chr(30) + r'(\p{Ll})', chr(92) + '1')}, {mark}, ' ')"
    prose = f"replace(replace({d.sub(prose, r'\s+([,.;:?!])', chr(92) + '1')}, '( ', '('), ' )', ')')"
    if d.name == "spark":  # what a line is found to be is made once, a line a row, and goes with its paragraph
        plain, opens = lines.opens_prose(d, "line", "md", "is_table")
        styled = f"CASE WHEN {d.has('joined', chr(30))} THEN {d.strip(prose)} WHEN md IS NOT NULL THEN md WHEN is_table THEN joined ELSE {d.strip(prose)} END"
        return (
            f"{kept_lines(d)}, told AS (SELECT *, {lines.markdown_of(d, 'line')} AS md, {lines.table_of(d, 'line')} AS is_table FROM (SELECT doc_id, line_no, {d.trimmed('line')} AS line FROM kept)),"
            f" may AS (SELECT *, {plain} AS plain, {opens} AS opens FROM told),"
            f" stepped AS (SELECT doc_id, line_no, line, md, is_table, plain AND coalesce(lag(opens) {w}, false) AS goes_on FROM may),"
            f" broken AS (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) {w} AS island FROM stepped),"
            f" folded AS (SELECT doc_id, island, max(md) AS md, max(is_table) AS is_table, {joined} AS joined FROM broken WHERE line <> '' GROUP BY doc_id, island),"
            f" styled AS (SELECT doc_id, island, {styled} AS block FROM folded),"
            f" cleaned AS (SELECT doc_id, count(*) AS n_blocks, {document} AS text FROM styled GROUP BY doc_id)"
        )
    return (
        f"{kept_lines(d)}, stepped AS (SELECT *, lag(line) {w} AS previous FROM kept),"
        f" broken AS (SELECT *, sum(CASE WHEN {lines.continues_prose(d, 'coalesce(previous, ' + d.text('') + ')', 'line')} THEN 0 ELSE 1 END) {w} AS island FROM stepped),"
        f" folded AS (SELECT doc_id, island, {joined} AS joined FROM broken WHERE line <> '' GROUP BY doc_id, island),"
        f" styled AS (SELECT doc_id, island, CASE WHEN {d.has('joined', chr(30))} THEN {d.strip(prose)} WHEN ({lines.markdown_heading(d, 'joined')}) IS NOT NULL THEN {lines.markdown_heading(d, 'joined')} WHEN {lines.is_table_line(d, 'joined')} THEN joined ELSE {d.strip(prose)} END AS block FROM folded),"
        f" cleaned AS (SELECT doc_id, count(*) AS n_blocks, {document} AS text FROM styled GROUP BY doc_id)"
    )


remove_noise = Operator(lambda d: f"WITH {kept_lines(d)} SELECT doc_id, line_no, line FROM front")
join_headings = Operator(lambda d: f"WITH {kept_lines(d)} SELECT doc_id, line_no, line FROM kept")
clean_paragraphs = Operator(lambda d: f"WITH {reflowed(d)} SELECT doc_id, n_blocks, text FROM cleaned")


# --- scoring and rendering ---------------------------------------------------------


def source_rows(d: Dialect, x: str) -> str:
    """The lines of a text that are not blank, as an array: what score() counts."""
    return d.filter(d.map(d.split(lines.normalize_whitespace(d, x), NL), "l", d.strip("l")), "l", "l <> ''")


def score(d: Dialect, x: str, rows: str) -> str:
    """How good a text source is; null where it has no text. rows: source_rows(), made once as a column."""
    noise = d.size(d.filter(rows, "l", lines.is_noise(d, "l")))
    has = lambda s, v: f"CASE WHEN {d.has(x, s)} THEN {v} ELSE 0 END"
    times = lambda s: f"({d.double(f'length({x}) - length(replace({x}, {d.text(s)}, {d.text(str())}))')} / {len(s)})"
    average = f"{d.double(d.total(rows, 'l', 'length(l)'))} / greatest(1, {d.size(rows)})"
    return (
        f"CASE WHEN {d.size(rows)} > 0 THEN least({d.double(f'length({x})')} / 1000, 80) + {has('Abstract', 10)} + {has('References', 10)} + {has('Introduction', 8)}"
        f" - {d.double('1.5')} * {noise} - 4 * ({times(chr(0xFFFD))} + {times('cid:')} + {times(chr(0))}) - 2 * {times(chr(12))} + least(({average}) / 4, 20) END"
    )


def rendered_blocks(d: Dialect) -> str:
    """CTE rendered (doc_id, block, kind, section, chunk). The normalised source is a column of its own, so that it is made once."""
    text = f"CASE WHEN kind = 'heading' THEN {assembly.heading_text(d, 's', d.text(''))} ELSE s END"
    return (
        f"normal AS (SELECT *, {assembly.archival(d, 'source')} AS s FROM blocks), texts_ AS (SELECT *, {text} AS t FROM normal),"
        f" rendered AS (SELECT doc_id, block, kind, section, {assembly.rendered(d, 't', 'kind', 'section')} AS chunk FROM texts_)"
    )


def _document(d: Dialect, table: str) -> str:
    """Chunks that are not blank are told inside the aggregate: as a filter below it the chunk would be made twice."""
    shown = f"{d.strip('chunk')} <> ''"
    if d.name == "spark":
        joined = f"array_join(transform(array_sort(collect_list(CASE WHEN {shown} THEN struct(block, chunk) END)), e -> e.chunk), {d.text(NL + NL)})"
    else:
        joined = f"string_agg(chunk, {d.text(NL + NL)} ORDER BY block) FILTER ({shown})"
    return f"SELECT doc_id, count(CASE WHEN {shown} THEN 1 END) AS n_blocks, concat({joined}, {d.text(NL)}) AS document FROM {table} GROUP BY doc_id HAVING count(CASE WHEN {shown} THEN 1 END) > 0"


assemble = over_blocks(lambda d: f", {rendered_blocks(d)} {_document(d, 'rendered')}")


def _study(d: Dialect) -> str:
    text = assembly.study(d, "source")
    front = "min(CASE WHEN coalesce(section, '') <> 'title' THEN block END) OVER (PARTITION BY doc_id)"
    return (
        f", fronted AS (SELECT *, {front} AS body FROM blocks),"
        f" shown AS (SELECT doc_id, block, {assembly.study_rendered(d, 't', 'kind', 'section')} AS chunk FROM (SELECT *, {text} AS t FROM fronted WHERE block >= body)),"
        " cut AS (SELECT *, max(CASE WHEN chunk = '## 參考文獻' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY block) AS ended FROM shown)"
    )


front_matter = over_blocks(
    lambda d: f", fronted AS (SELECT *, coalesce(min(CASE WHEN coalesce(section, '') <> 'title' THEN block END) OVER (PARTITION BY doc_id), 2147483647) AS body FROM blocks) SELECT doc_id, block_id, kind FROM fronted WHERE block < body"
)
study_blocks = over_blocks(lambda d: f"{_study(d)} SELECT doc_id, block, chunk FROM cut WHERE ended = 0 AND chunk IS NOT NULL")
study_document = over_blocks(lambda d: f"{_study(d)} {_document(d, '(SELECT * FROM cut WHERE ended = 0 AND chunk IS NOT NULL)')}")
