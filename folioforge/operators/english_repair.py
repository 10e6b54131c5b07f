"""Repair of prose that extraction interrupted: a scan over the blocks of a text.

The scan moves on by one to four blocks, depending on what it finds, so it is
no window: each text is repaired on its own, in Arrow batches. Rules in order:
prose, a note, the rest of the prose; prose, a caption, the caption's end with
the rest of the prose in one block or in two; else neighbours that join.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..functions import repair as r
from ..functions.lines import PANELS
from ..sources.shipping import ship

_HEADING, _CAPTION, _URL, _MIXED = re.compile(r.HEADING), re.compile(r.CAPTION), re.compile(r.URLISH), re.compile(r.MIXED)
_CODE = re.compile("[0-9][A-Z]{2}")
_SMALL = frozenset("abcdefghijklmnopqrstuvwxyz")
#: No sign of metadata is longer.
_WIDTH = max(map(len, r.METADATA_WORDS))


def _metadata(b: str) -> bool:
    return any(w in b for w in r.METADATA_WORDS) or _CODE.search(b) is not None


def _kind(b: str) -> str:
    if _HEADING.match(b):
        return "heading"
    if _CAPTION.match(b):
        return "caption"
    return "metadata" if _metadata(b) else "prose"


def _merged(a: str, b: str) -> str:
    return a[:-1] + b if a.endswith("-") and b[:1].islower() else f"{a} {b}"


def _panels(b: str) -> bool:
    return any(p in b for p in PANELS)


class _Blocks(list):
    """Blocks of a text; what each is found to be is looked for once, and only where it is asked."""

    def __init__(self, blocks):
        super().__init__(blocks)
        self.kinds: list[str | None] = [None] * len(self)

    def kind(self, k: int) -> str:
        found = self.kinds[k]
        if found is None:
            found = self.kinds[k] = _kind(self[k])
        return found

    def plain(self, k: int) -> bool:
        return self.kind(k) == "prose" and not _URL.match(self[k])

    def joins(self, a: int, b: int) -> bool:
        return self.open(self[a], b) and self.plain(a) and self.plain(b)

    def open(self, now: str, b: int) -> bool:
        """Whether block b may go on with a prose text, by their ends."""
        return not now.endswith(":") and (self[b][0] in _SMALL or now.endswith("-"))

    def joined(self, at: int) -> tuple[str, int]:
        """Block `at` with all that go on with it, one after another, and the place behind them. Of the text so far only the start and the seam are looked at anew."""
        now, k = self[at], at + 1
        plain = None
        while k < len(self) and self.open(now, k):
            if plain is None:
                plain = self.plain(at)
            if not (plain and self.plain(k)):
                break
            seam = len(now)
            if now.endswith("-") and self[k][:1].islower():
                now = now[:-1] + self[k]
            else:
                now += " "
                now += self[k]
            near = now[max(0, seam - _WIDTH - 1) : seam + _WIDTH + 1]
            plain = not (_HEADING.match(now) or _CAPTION.match(now) or _metadata(near) or _URL.match(now))
            k += 1
        return now, k


def repaired(text: str | None) -> str:
    blocks = _Blocks([s for b in (text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n\n") if (s := b.strip())])
    out: list[str] = []
    at = 0
    while at < len(blocks):
        taken = None
        if at + 2 < len(blocks) and blocks.kind(at + 1) in ("metadata", "caption") and blocks.kind(at) not in ("heading", "caption"):
            now, note, after = blocks[at : at + 3]
            if blocks.kind(at + 1) == "metadata":
                if blocks.joins(at, at + 2):
                    taken = [_merged(now, after), note], 3
            elif now[-1] not in ".!?:":
                mixed = _MIXED.match(after) if _panels(after) else None
                if mixed:
                    taken = [_merged(now, mixed[2].strip()), _merged(note, mixed[1].strip())], 3
                elif at + 3 < len(blocks) and after[:1].islower() and _panels(after) and blocks.kind(at + 2) != "caption" and blocks.kind(at + 3) != "metadata":
                    taken = [_merged(now, blocks[at + 3]), _merged(note, after)], 4
        if taken is None:
            now, behind = blocks.joined(at)
            taken = [now], behind - at
        out += taken[0]
        at += taken[1]
    return "\n\n".join(_BEFORE_STOP.sub(r"\1", b).strip() for b in out) + "\n"


_BEFORE_STOP = re.compile(r"\s+([,.;:?!])")


def repair(text: Column) -> Column:
    ship(SparkSession.active())
    return F.pandas_udf(lambda s: pd.Series([repaired(t) for t in s]), "string")(text)


# --- front matter ---------------------------------------------------------------

# Addresses, words that begin an affiliation, words that separate affiliations without numbers.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PLACE = r"\b(?:[0-9]+\.?\s*)?(?:CMU|SMU|University|Institute|Vector|MPI|AREA|Science Park)\b"
PLACE_SPLIT = r"\s+(?=(?:CMU|SMU|University|MPI|AREA)\b)"
_NUMBER = re.compile(r"(?:^|(?<=\s))[0-9]+\.?\s+")
_LABELS = {"authors": "Authors: ", "affiliations": "Affiliations:\n- ", "emails": "Emails: "}


def _places(text: str) -> list[str]:
    """Affiliations of a text: the numbered ones if there are any, else cut before the words that begin one."""
    starts = [m.start() for m in _NUMBER.finditer(text)]
    parts = [text[a:z] for a, z in zip(starts, [*starts[1:], len(text)], strict=True)] if starts else re.split(PLACE_SPLIT, text)
    return [p.strip(" ,") for p in parts if p.strip(" ,")]


def title_paragraph(source: str, translated: str = "") -> dict[str, list[str]]:
    """Authors, affiliations and addresses of a paragraph of the title section.

    A draft of several lines with numbered affiliations says all by its lines; else the source is cut where the first affiliation begins."""
    emails = re.findall(EMAIL, translated or source)
    if "\n" in translated:
        rows = [r.strip(" ,") for r in translated.split("\n") if r.strip(" ,")]
        plain = [r for r in rows if not re.search(EMAIL, r)]
        first = next((i for i, r in enumerate(plain) if re.match(r"[0-9]+\.?\s+", r)), None)
        if first is not None:
            names = next(((i, r) for i, r in enumerate(plain) if not re.match(r"[0-9]+\.?\s+", r)), None)
            kept = [r for i, r in enumerate(plain) if i >= first and (names is None or i != names[0])]
            told = [e for r in rows for e in re.findall(EMAIL, r)]
            return {"authors": [names[1] if names else translated], "affiliations": kept, "emails": told or emails}
    rest = re.sub(EMAIL, "", source).strip()
    m = re.search(PLACE, rest)
    names = (rest[: m.start()] if m else rest).strip(" ,")
    return {"authors": [names] if names else [translated] if translated else [], "affiliations": _places(rest[m.start() :].strip(" ,")) if m else [], "emails": emails}


def front_matter(title: str | None, paragraphs: list[tuple[str, str]]) -> list[str]:
    """The head of a study document: title, authors, affiliations and addresses, the last two each once, in order. paragraphs: (source, draft)."""
    found: dict[str, list[str]] = {k: [] for k in _LABELS}
    for source, draft in paragraphs:
        for k, v in title_paragraph(source, draft).items():
            found[k] += v
    found |= {k: list(dict.fromkeys(found[k])) for k in ("affiliations", "emails")}
    shown = [f"{label}{(chr(10) + '- ' if k == 'affiliations' else ' ').join(found[k])}" for k, label in _LABELS.items() if found[k]]
    return ([f"# {title}"] if title else []) + shown


def title_parts(text_col: str) -> Column:
    """A struct of authors, affiliations and emails of a paragraph, each joined by semicolons."""

    ship(SparkSession.active())

    def parts(s):
        return pd.DataFrame([{k: ";".join(v) for k, v in title_paragraph(t or "").items()} for t in s], columns=["authors", "affiliations", "emails"])

    parts.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(parts, "authors string, affiliations string, emails string")(text_col)
