"""Translation text: masks, truncation and suspicion tests, prompts, as portable expressions."""

from __future__ import annotations

from .dialect import Dialect

# Types, limits and patterns of the translation stage.
TRANSLATABLE = ("heading", "paragraph")
PROTECTED_SPAN = r"`[^`]+`|https?://\S+|[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|\$[^$]+\$"
META_PREFIX = r"^(?:(?:以下是(?:修復後的)?(?:繁體中文)?翻譯：?|[Hh][Ee][Rr][Ee](?: [Ii][Ss]|'[Ss]) [Tt][Hh][Ee] (?:[Rr][Ee][Pp][Aa][Ii][Rr][Ee][Dd] )?(?:[Tt][Rr][Aa][Dd][Ii][Tt][Ii][Oo][Nn][Aa][Ll] [Cc][Hh][Ii][Nn][Ee][Ss][Ee] )?[Tt][Rr][Aa][Nn][Ss][Ll][Aa][Tt][Ii][Oo][Nn]:?)[\s\n]*)+"
INCOMPLETE = r"(?:[\(\[\{（［｛]$)|(?:^|[^\p{L}\p{N}_])(?:[Ee][Tt]|[Aa][Ll]|[Vv][Ss]|[Ff][Ii][Gg]|[Ee][Qq]|[Ss][Ee][Cc]|[Tt][Aa][Bb][Ll][Ee])\.?$"
SOURCE_STOPS = r"[.!?;:]"
#: PROTECTED_SPAN for Java: an address is tried from the first letter of a word on, or from where the last match ended, which finds the same.
PROTECTED_JAVA = r"`[^`]+`|https?://\S+|(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|\$[^$]+\$"
TARGET_STOPS = r"[。！？；：.!?]"
ERROR_MARK = r"\[TRANSLATION_ERROR:[^\]]+\]"
MASK = r"§PROTECTED_[0-9]+§"
LATIN = r"[A-Za-z]{4,}"


def strip_meta(d: Dialect, x: str) -> str:
    return d.strip(d.sub(d.strip(x), META_PREFIX))


def _truncated_spark(d: Dialect, source: str, translated: str, kind: str) -> str:
    """is_truncated(): what is asked of a draft is made once, and what costs little is asked first. The last word is looked for in the last 16 characters."""
    ends = f"WHEN {d.rx('right(t_, 16)', INCOMPLETE)} THEN true"
    stops = f"WHEN m_ < 120 AND {d.count('s_', SOURCE_STOPS)} >= 2 AND {d.count('t_', TARGET_STOPS)} = 0 THEN true"
    told = f"CASE WHEN n_ < 120 THEN false {ends} WHEN n_ >= 240 AND m_ < greatest(80, CAST(floor(n_ * CAST(0.22 AS DOUBLE)) AS BIGINT)) THEN true {stops} WHEN n_ >= 400 AND m_ < 120 THEN true ELSE false END"
    told = d.let("s_", d.strip(source), d.let("n_", "length(s_)", d.let("m_", "length(t_)", told)))
    told = d.let("t_", strip_meta(d, translated), f"CASE WHEN t_ = '' THEN true WHEN {kind} = 'heading' THEN false ELSE {told} END")
    return f"CASE WHEN NOT {d.in_(kind, TRANSLATABLE)} THEN false ELSE {told} END"


def is_truncated(d: Dialect, source: str, translated: str, kind: str) -> str:
    if d.name == "spark":
        return _truncated_spark(d, source, translated, kind)
    s, t = d.strip(source), f"({strip_meta(d, translated)})"
    n, m = f"length({s})", f"length({t})"
    return (
        f"CASE WHEN NOT {d.in_(kind, TRANSLATABLE)} THEN false WHEN {t} = '' THEN true WHEN {kind} = 'heading' THEN false WHEN {n} < 120 THEN false WHEN {d.rx(t, INCOMPLETE)} THEN true"
        f" WHEN {n} >= 240 AND {m} < greatest(80, CAST(floor({n} * CAST(0.22 AS DOUBLE)) AS BIGINT)) THEN true"
        f" WHEN {d.count(s, SOURCE_STOPS)} >= 2 AND {d.count(t, TARGET_STOPS)} = 0 AND {m} < 120 THEN true WHEN {n} >= 400 AND {m} < 120 THEN true ELSE false END"
    )


def latin_letters(d: Dialect, x: str) -> str:
    if d.name == "spark":
        return f"CAST(length({x}) - length({d.sub(x, LATIN)}) AS BIGINT)"
    return d.total(d.extract_all(x, LATIN), "w", "length(w)")


def latin_density(d: Dialect, x: str) -> str:
    return f"({d.double(latin_letters(d, x))} / greatest(1, length({x})))"


def is_suspicious(d: Dialect, source: str, translated: str, kind: str) -> str:
    t = translated
    if d.name == "spark":
        latin = f"({kind} = 'paragraph' AND length({t}) > 120 AND {latin_density(d, t)} >= CAST(0.18 AS DOUBLE) AND {d.count(t, LATIN)} >= 10)"
        return (
            f"({d.in_(kind, TRANSLATABLE)} AND ({d.strip(t)} = '' OR ({d.has(t, '[TRANSLATION_ERROR:')} AND {d.rx(t, ERROR_MARK)}) OR ({d.has(t, '§PROTECTED_')} AND {d.rx(t, MASK)}) OR ({d.has(t, chr(10) * 2)} AND {d.count(t, chr(10) * 2)} >= 4)"
            f" OR {latin} OR length({t}) > greatest(length({source}) * 4, 1600) OR {is_truncated(d, source, t, kind)}))"
        )
    return (
        f"({d.in_(kind, TRANSLATABLE)} AND ({d.strip(t)} = '' OR {d.rx(t, ERROR_MARK)} OR {d.rx(t, MASK)} OR {d.count(t, chr(10) * 2)} >= 4"
        f" OR ({kind} = 'paragraph' AND {d.count(t, LATIN)} >= 10 AND {latin_density(d, t)} >= CAST(0.18 AS DOUBLE) AND length({t}) > 120)"
        f" OR length({t}) > greatest(length({source}) * 4, 1600) OR {is_truncated(d, source, t, kind)}))"
    )


def protected_spans(d: Dialect, x: str) -> str:
    if d.name == "spark":
        return d.let("w_", x, f"CASE WHEN {_may_protect(d, 'w_')} THEN {d.extract_all('w_', PROTECTED_JAVA)} WHEN w_ IS NOT NULL THEN CAST(array() AS ARRAY<STRING>) END")
    return d.extract_all(x, PROTECTED_SPAN)


def _may_protect(d: Dialect, x: str) -> str:
    """Whether a text holds a sign that every protected span has."""
    return "(" + " OR ".join(d.has(x, s) for s in ("`", "http", "@", "$")) + ")"


def masked(d: Dialect, x: str) -> str:
    """Code spans, addresses and formulas become numbered masks, counted from 0 in order."""
    mark = "\x1e"
    if d.name == "spark":
        # a mark that the text itself holds is a cut, too
        pieces = d.split(d.sub("w_", PROTECTED_JAVA, mark), mark)
        numbered = f"array_join(transform({pieces}, (p, i) -> CASE WHEN i = 0 THEN p ELSE concat('§PROTECTED_', CAST(i - 1 AS STRING), '§', p) END), '')"
        return d.let("w_", x, f"CASE WHEN {_may_protect(d, 'w_')} OR {d.has('w_', mark)} THEN {numbered} ELSE w_ END")
    pieces = d.split(d.sub(x, PROTECTED_SPAN, mark), mark)
    return f"array_to_string(list_transform({pieces}, lambda p, i: CASE WHEN i = 1 THEN p ELSE concat('§PROTECTED_', CAST(i - 2 AS VARCHAR), '§', p) END), '')"


def restored(d: Dialect, text: str, spans: str) -> str:
    """Masks back to what they stand for, one after another."""
    if d.name == "spark":
        # in one pass over the text; one after another only where a span, or two masks that share a sign, could make a mask of their own
        number = "try_cast(substring_index(p, '§', 1) AS INT)"
        span = f"CASE WHEN startswith(p, concat({number}, '§')) THEN get(sp_, {number}) END"
        piece = f"CASE WHEN i = 0 THEN p ELSE coalesce(concat({span}, substring(p, length(CAST({number} AS STRING)) + 2)), concat('§PROTECTED_', p)) END"
        passed = f"array_join(transform(split(tx_, {d.pattern('§PROTECTED_(?=[0-9]+§)')}), (p, i) -> {piece}), '')"
        slow = "aggregate(transform(sp_, (s, i) -> struct(s, i)), tx_, (t, e) -> replace(t, concat('§PROTECTED_', CAST(e.i AS STRING), '§'), e.s))"
        apart = f"NOT exists(sp_, s -> contains(s, '§')) AND NOT {d.rx('tx_', '§PROTECTED_[0-9]+§PROTECTED_')}"
        return d.let("sp_", spans, d.let("tx_", text, f"CASE WHEN size(sp_) = 0 THEN tx_ WHEN size(sp_) = 1 THEN {slow} WHEN {apart} THEN {passed} ELSE {slow} END"))
    return f"list_reduce(list_transform({spans}, lambda s, i: [concat('§PROTECTED_', CAST(i - 1 AS VARCHAR), '§'), s]), lambda t, e: [replace(t[1], e[1], e[2])], [{text}])[1]"


def response_chunk(d: Dialect, kind: str, parts: str) -> str:
    """Answers to the chunks of a block joined: by a blank in a paragraph, else by a blank line."""
    clean = d.filter(d.map(parts, "p", d.strip("p")), "p", "p <> ''")
    return f"CASE WHEN {kind} = 'paragraph' THEN {d.join(clean, ' ')} ELSE {d.join(clean, chr(10) * 2)} END"


def guidance_line(d: Dialect, term: str, policy: str, translation: str) -> str:
    t, z = d.strip(term), d.strip(f"coalesce({translation}, '')")
    return (
        f"CASE WHEN {t} = '' OR {policy} = '' THEN NULL WHEN {policy} = 'preserve' THEN concat('- ', {t}, ' => preserve English') WHEN {z} <> '' THEN concat('- ', {t}, ' => ', {z})"
        f" ELSE concat('- ', {t}, ' => prefer consistent translation') END"
    )


def prompt(d: Dialect, text: str, kind: str, section: str, index: str, total: str, guidance: str) -> str:
    """The prompt for one chunk. Wording is ours; its parts and their order are fixed."""
    style = f"CASE {kind} WHEN 'heading' THEN 'short heading, keep the number' WHEN 'figure' THEN 'caption, keep numbers and names' WHEN 'table' THEN 'caption, keep numbers and names' ELSE 'faithful prose, keep terms and citations' END"
    chunk = f"CASE WHEN {total} > 1 THEN concat('part ', CAST({index} + 1 AS {'STRING' if d.name == 'spark' else 'VARCHAR'}), ' of ', CAST({total} AS {'STRING' if d.name == 'spark' else 'VARCHAR'})) ELSE 'complete' END"
    return f"concat_ws({d.text(chr(10))}, concat('Type: ', {kind}), concat('Section: ', coalesce(nullif({section}, ''), 'unknown')), concat('Chunk: ', {chunk}), concat('Style: ', {style}), {guidance}, concat('Passage: ', {text}))"
