"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Generators with high recall propose overlapping spans of four kinds: e-mail
addresses, IP addresses, card numbers and telephone numbers. Base candidates
have the strict forms of base_spans() and always stay. Further candidates are
looser: telephone numbers without a plus sign, card numbers in groups set off
by dots or underscores, IPv6 addresses, e-mail addresses with "at" and "dot"
spelled out. Boosted trees see format features (lengths, digit counts, groups,
separators, checksums, what stands on either side) and context features (cue
words before the span) and give a calibrated probability; a span is kept from
the threshold on that reaches the wanted precision on held-out rows. Kept
spans that overlap base spans or likelier spans of the same kind go.

The model is fitted here, on rows built by rule with a fixed seed (training
tables hold no labels for spans).

Linear scans only: an e-mail address is sought from its "@", digit runs are
matched without backtracking. Null text counts as empty. Offsets are code
points, ends exclusive. Further columns are not read; repeated rows give
repeated results.
"""

from __future__ import annotations

import bisect
import functools
import ipaddress
import itertools
import random
import re
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .boosting import Boosted, Calibrated, threshold
from .common import ship

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]  # start, end, kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d)
        if i % 2:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str | None) -> list[Span]:
    """Strict spans, leftmost and not overlapping within a kind; what fails its test is dropped whole."""
    if not text:
        return []
    out = _emails(text) if "@" in text else []
    first = _DIGIT.search(text)
    if first:
        at = max(0, first.start() - 1)  # nothing before holds a digit
        for m in _IP.finditer(text, first.start()):
            if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text, first.start()):
            if m.end() - m.start() >= 14:
                digits = _digits(m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        if text.find("+", at) >= 0:
            for m in _PHONE.finditer(text, at):
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=_order)


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _order(s: Span):
    return s[0], KINDS.index(s[2]), s[1]


# --- further candidates -------------------------------------------------------------

_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+])(?:\(?0?[0-9]{2,4}\)?[\x20./-]{1,2}){1,3}[0-9]{3,4}(?:[\x20.-][0-9]{2,4}){0,2}(?![0-9A-Za-z])|(?<![0-9A-Za-z+.])(?:00|0)[0-9]{8,13}(?![0-9A-Za-z])|(?<![0-9A-Za-z+.])[0-9]{10}(?![0-9A-Za-z])|(?<![0-9A-Za-z+.])0[0-9](?:[\x20.-][0-9]{2}){4}(?![0-9A-Za-z])")
_LOOSE_CARD = re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[._/\x20-]{1,3}[0-9]{4}){3}(?:[._/\x20-]{1,3}[0-9]{1,3})?(?![0-9A-Za-z])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){1,7}(?::[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{1,4}){0,6}|[0-9A-Fa-f]{1,4})(?![0-9A-Za-z:])")
_SPELLED = re.compile(r"(?i)(?<![A-Za-z0-9._%+-])[a-z0-9_%+-]{1,40}(?:\.[a-z0-9_%+-]{1,40}){0,3}\x20?(?:[\[({<]\x20?at\x20?[\])}>]|\x20at\x20)\x20?[a-z0-9-]{1,40}(?:\x20?(?:[\[({<]\x20?dot\x20?[\])}>]|\x20dot\x20|\.)\x20?[a-z0-9-]{1,20}){1,4}(?![A-Za-z0-9-])")
_CUES = {
    "email": ("mail", "contact", "write", "reach", "address", "correo", "courriel", "adresse"),
    "ip": ("ip", "host", "server", "address", "login", "from", "client"),
    "card": ("card", "visa", "credit", "payment", "tarjeta", "carte", "karte", "account"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "contact", "telefon", "llam", "appel", "ring"),
}
_AGAINST = ("order", "invoice", "version", "isbn", "page", "serial", "ref", "id", "sku", "date", "score", "build", "token", "total", "chapter", "section", "parcel", "ticket")


def candidates(text: str | None) -> list[Span]:
    """Overlapping spans of high recall, without the base ones."""
    if not text:
        return []
    out: list[Span] = []
    first = _DIGIT.search(text)
    if first:
        at = max(0, first.start() - 1)
        out += [(m.start(), m.end(), "phone") for m in _LOOSE_PHONE.finditer(text, at)]
        out += [(m.start(), m.end(), "card") for m in _LOOSE_CARD.finditer(text, at)]
    if "::" in text or text.count(":") > 2:
        out += [(m.start(), m.end(), "ip") for m in _IPV6.finditer(text)]
    # the spelled-out form needs a bracket or both words near one another
    if "dot" in text.lower() or re.search(r"(?i)[\[({<]\x20?at\x20?[\])}>]", text):
        out += [(m.start(), m.end(), "email") for m in _SPELLED.finditer(text)]
    return sorted(set(out), key=_order)


def features(text: str, span: Span) -> list[float]:
    start, end, kind = span
    s = text[start:end]
    before, after = text[max(0, start - 48) : start], text[end : end + 12]
    words = re.findall(r"[^\W\d_]+", before.lower())[-5:]
    digits = _digits(s)
    groups = re.findall("[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    separators = re.sub("[0-9A-Za-z]", "", s)
    try:
        six = ":" in s and bool(ipaddress.IPv6Address(s))
    except ValueError:
        six = False
    head = before[-1:]
    return [
        float(KINDS.index(kind)),
        float(len(s)),
        float(len(digits)),
        float(len(groups)),
        float(min(sizes)),
        float(max(sizes)),
        float(sizes[-1]),
        float(len(set(separators))),
        float(len(separators)),
        float("(" in s),
        float("/" in s),
        float(s.count(".")),
        float(s.count(" ")),
        float(s.count("-")),
        float(s[:1] == "0"),
        float(luhn(digits)) if 12 <= len(digits) <= 19 else -1.0,
        float(six),
        float(s.count(":")),
        float(bool(re.search(r"(?i)[\[({<]\x20?(?:at|dot)\x20?[\])}>]", s))),
        float(bool(re.search(r"(?i)\x20dot\x20", s))),
        float(bool(re.search(r"(?i)(?:com|org|net|edu|de|fr|es|io|info|co|uk)$", s))),
        float(any(w.startswith(c) for w in words for c in _CUES[kind])),
        float(any(w.startswith(c) for w in words[-2:] for c in _CUES[kind])),
        float(any(w.startswith(c) for w in words for c in _AGAINST)),
        float(bool(re.match(r"(?:19|20)[0-9]{2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)?[0-9]{2}", s))),
        float(head.isalnum() or head in "$€£#_="),
        float(head in "\"'=:"),
        float(after[:1].isalnum() or after[:1] in "%_="),
        float(len(re.findall("[0-9]", before))),
        float(len(re.findall("[0-9]", after))),
    ]


# --- rows to fit on --------------------------------------------------------------------


def _sample(rng: random.Random) -> tuple[str, list[Span], bool]:
    """A text with one candidate, built by rule; whether it is personal data."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("etaoinshrdlucmfw") for _ in range(rng.randint(2, 9)))
    kind = rng.choice(KINDS)
    good = rng.random() < 0.5
    cue = rng.choice(_CUES[kind]) if good and rng.random() < 0.8 else rng.choice((rng.choice(_AGAINST), word(), word()))
    if not good and rng.random() < 0.25:
        cue = word()
    sep = rng.choice(" -.")
    if kind == "phone":
        if good:
            body = rng.choice((f"({n(3)}) {n(3)}-{n(4)}", sep.join((n(3), n(3), n(4))), f"0{n(2)}{sep}{n(4)}{sep}{n(4)}", "0" + sep.join((n(1), n(2), n(2), n(2), n(2)))[0:], f"00{n(2)} {n(3)} {n(3)} {n(3)}", n(10)))
        else:
            body = rng.choice((f"20{n(2)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} {n(4)}", f"{n(3)} {n(3)} {n(3)}", f"{n(4)} {n(4)}", n(10), f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.20{n(2)}", f"{n(2)}.{n(4)}/{n(4)}", f"{n(3)}-{n(3)}", f"{n(4)}-{n(4)} {n(4)}"))
    elif kind == "card":
        groups = [n(4) for _ in range(4)]
        want = good or rng.random() < 0.1
        while luhn("".join(groups)) != want:
            groups[-1] = n(4)
        body = rng.choice((" - ", ".", "_", "  ", "/")).join(groups)
    elif kind == "ip":
        h = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(1, 4)))
        if good:
            body = rng.choice((":".join(h() for _ in range(8)), f"{h()}:{h()}::{h()}", f"fe80::{h()}:{h()}:{h()}:{h()}", f"2001:db8::{h()}"))
        else:
            body = rng.choice((f"{n(2)}:{n(2)}:{n(2)}", f"{n(2)}:{n(2)}", f"{n(1)}::{n(1)}", f"ab::cd::{n(2)}", ":".join(h() for _ in range(rng.randint(3, 6)))))
    else:
        if good:
            at, dot = rng.choice(((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", "."), (" at ", " dot ")))
            body = f"{word()}{rng.choice(('', '.' + word(), n(2)))}{at}{word()}{rng.choice(('', '', dot + word()))}{dot}{rng.choice(('com', 'org', 'net', 'edu', 'de', 'fr', 'es'))}"
        else:
            body = rng.choice((f"{word()} at {word()}.{word().capitalize()}", f"{word()} at {word()} dot {word()}", f"looked at {word()}.{word()} {word()}", f"{word()} at the dot {word()}"))
    lead = " ".join(word() for _ in range(rng.randint(0, 6)))
    text = f"{lead} {cue}{rng.choice((': ', ' ', ' is ', ' no. '))}{body}{rng.choice((' ', '. ', ', ', '\n', ' (', '; '))}{' '.join(word() for _ in range(rng.randint(0, 5)))}"
    start = text.index(body)
    return text, [(start, start + len(body), kind)], good


@functools.lru_cache(maxsize=1)
def model(rows: int = 6000, seed: int = 11, precision: float = 0.99) -> tuple[Calibrated, dict[str, float]]:
    """(calibrated trees, threshold of each kind). Fitted once, on the driver, in about two seconds."""
    rng = random.Random(seed)
    x, y, kind = [], [], []
    while len(x) < rows:
        text, spans, good = _sample(rng)
        base = _Taken(base_spans(text))
        for c in candidates(text):
            if base.hits(c):
                continue
            same = any(c[2] == k and c[0] <= a + 1 and c[1] >= b - 1 and c[1] - c[0] <= b - a + 2 for a, b, k in spans)
            x.append(features(text, c))
            y.append(float(good and same))
            kind.append(c[2])
    x, y, kind = np.array(x), np.array(y), np.array(kind)
    part = np.arange(len(x)) % 5
    fitted = Calibrated(Boosted(trees=90, depth=4).fit(x[part < 3], y[part < 3])).calibrate(x[part == 3], y[part == 3])
    held = part == 4
    prob = fitted.prob(x[held])
    return fitted, {k: max(0.5, threshold(prob[kind[held] == k], y[held][kind[held] == k], precision)) for k in KINDS}


class _Taken:
    """Spans sorted by start, with the furthest end up to each: whether another overlaps one of them is one look-up, however many they are."""

    def __init__(self, spans: list[Span]):
        self.starts = [s[0] for s in spans]
        self.reach = list(itertools.accumulate((s[1] for s in spans), max))

    def hits(self, c: Span) -> bool:
        at = bisect_left(self.starts, c[1])
        return at > 0 and self.reach[at - 1] > c[0]


Model = tuple[Calibrated, dict[str, float]]


def find(texts: list[str | None], fitted: Model | None = None) -> tuple[list[list[Span]], list[list[Span]]]:
    """(base spans, all spans) of each text. fitted: model(), which is made here if it is not given."""
    base = [base_spans(t) for t in texts]
    open_: list[tuple[int, Span]] = []
    rows: list[list[float]] = []
    for i, t in enumerate(texts):
        more = candidates(t)
        taken = _Taken(base[i]) if more else None
        for c in more:
            if not taken.hits(c):
                open_.append((i, c))
                rows.append(features(t, c))
    every = [list(b) for b in base]
    if rows:
        trees, least = fitted or model()
        prob = trees.prob(np.array(rows))
        kept: dict[tuple[int, str], list[tuple[int, int]]] = {}
        for k in np.argsort(-prob, kind="stable").tolist():
            i, c = open_[k]
            if prob[k] < least[c[2]]:
                continue
            own = kept.setdefault((i, c[2]), [])
            at = bisect.bisect_left(own, (c[0], c[1]))  # kept disjoint, so neighbours suffice
            if (at and own[at - 1][1] > c[0]) or (at < len(own) and own[at][0] < c[1]):
                continue
            own.insert(at, (c[0], c[1]))
            every[i].append(c)
    return base, [sorted(e, key=_order) for e in every]


def shown(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in spans)


def _shared(df: DataFrame):
    """The model, fitted once on the driver and broadcast: a few thousand numbers."""
    ship(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(model())


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans): counts and text form of base spans, and all spans."""
    held = _shared(df)
    src = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at : at + 512]
                base, every = find([t if isinstance(t, str) else None for t in part["text"]], held.value)
                counts = {f"n_{k}": [sum(s[2] == k for s in x) for x in base] for k in KINDS}
                yield pd.DataFrame({"id": part["id"].to_numpy(), **counts, "base": [shown(x) for x in base], "spans": [shown(x) for x in every]})

    return src.mapInPandas(run, f"id {src.schema['id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def redact(df: DataFrame, text_col: str = "text", marks: dict[str, str] | None = None) -> DataFrame:
    """df with the spans of text_col replaced by a mark of their kind; overlapping spans become one mark, that of the first."""
    held = _shared(df)
    marks = marks or {k: f"<{k.upper()}>" for k in KINDS}

    def one(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for a, z, k in spans:
            if a >= at:
                out += [text[at:a], marks[k]]
            at = max(at, z)
        return "".join([*out, text[at:]])

    def run(texts: pd.Series) -> pd.Series:
        rows = [t if isinstance(t, str) else None for t in texts]
        return pd.Series([t if not s else one(t, s) for t, s in zip(rows, find(rows, held.value)[1], strict=True)], dtype=object)

    from pyspark.sql import functions as F

    return df.withColumn(text_col, F.pandas_udf(run, "string")(df[text_col]))
