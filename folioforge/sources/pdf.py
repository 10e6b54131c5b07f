"""Text of simple PDF files: objects, content streams, text operators.

Only unfiltered streams and chains of FlateDecode are read; a stream with any
other filter, or one that does not decode, is skipped. Text operators: Tj, ',
", TJ (a shift of -120 or less is a blank); Td, TD, T* and Tm begin a line, BT
and ET end a paragraph. One file gives one text; files never meet.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .portions import portions
from .shipping import ship

_OBJECT = re.compile(rb"[0-9]+\s+[0-9]+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"^(.*?)stream\r?\n(.*?)\r?\n?endstream", re.S)
_FILTER = re.compile(rb"/Filter\s*(?:\[([^\]]*)\]|(/[A-Za-z0-9]+))")
_TOKEN = re.compile(rb"\s+|%[^\r\n]*|/[^\s()<>\[\]{}/%]*|<<|>>|[\[\]{}]|<[0-9A-Fa-f\s]*>|\(|[-+]?[0-9]*\.?[0-9]+|[^\s()<>\[\]{}/%]+|.", re.S)
# Escapes of PDF strings.
_ESCAPES = {b"n": "\n", b"r": "\r", b"t": "\t", b"b": "\b", b"f": "\f", b"(": "(", b")": ")", b"\\": "\\"}


def literal(data: bytes, at: int) -> tuple[str, int]:
    """The string whose opening parenthesis is at `at`; (text, place behind it)."""
    out, depth, i, n = [], 1, at + 1, len(data)
    while i < n:
        c = data[i : i + 1]
        i += 1
        if c == b"\\":
            m = re.compile(rb"[0-7]{1,3}").match(data, i)
            if m:
                out.append(chr(int(m[0], 8) & 255))
                i = m.end()
            elif data[i : i + 2] == b"\r\n":
                i += 2
            elif data[i : i + 1] in (b"\n", b"\r"):
                i += 1
            else:
                out.append(_ESCAPES.get(data[i : i + 1], data[i : i + 1].decode("latin-1")))
                i += 1
            continue
        depth += (c == b"(") - (c == b")")
        if not depth:
            break
        out.append(c.decode("latin-1"))
    return "".join(out), i


def tokens(data: bytes) -> Iterator[tuple[str, object]]:
    at = 0
    while at < len(data):
        m = _TOKEN.match(data, at)
        t = m[0]
        at = m.end()
        if t == b"(":
            text, at = literal(data, m.start())
            yield "string", text
        elif t[:1] == b"<" and t not in (b"<", b"<<"):
            digits = re.sub(rb"\s", b"", t[1:-1])
            yield "string", bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("latin-1")
        elif t in (b"[", b"]"):
            yield "array", t == b"["
        elif re.fullmatch(rb"[-+]?[0-9]*\.?[0-9]+", t):
            yield "number", float(t)
        elif t.strip() and t[:1] not in (b"/", b"%"):
            yield "operator", t.decode("latin-1")


def stream_text(data: bytes) -> str:
    out: list[str] = []
    held: list[object] = []
    inside = None
    for kind, v in tokens(data):
        if kind == "array":
            if v:
                inside = []
            elif inside is not None:
                held.append(inside)
                inside = None
        elif kind in ("string", "number"):
            (held if inside is None else inside).append(v)
        else:
            strings = [h for h in held if isinstance(h, str)]
            if v in ("BT", "ET"):
                out.append("\n\n")
            elif v in ("Td", "TD", "T*", "Tm"):
                out.append("\n")
            elif v == "Tj" and strings:
                out.append(strings[-1])
            elif v in ("'", '"') and strings:
                out.append("\n" + strings[-1])
            elif v == "TJ":
                for item in next((h for h in reversed(held) if isinstance(h, list)), []):
                    out.append(item if isinstance(item, str) else " " if item <= -120 else "")
            held = []
    lines = [" ".join(x.split()) for x in "".join(out).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def content_streams(data: bytes) -> Iterator[bytes]:
    for m in _OBJECT.finditer(data):
        s = _STREAM.search(m[1])
        if not s:
            continue
        f = _FILTER.search(s[1])
        chain = re.findall(rb"/([A-Za-z0-9]+)", (f[1] or f[2]) if f else b"")
        body = s[2]
        try:
            for name in chain:
                if name not in (b"FlateDecode", b"Fl"):
                    raise ValueError(name)
                body = zlib.decompress(body)
        except (ValueError, zlib.error):
            continue
        if b"BT" in body and (b"Tj" in body or b"TJ" in body):
            yield body


def text_of(data: bytes | None) -> str:
    return "\n\n".join(t for t in map(stream_text, content_streams(data or b"")) if t)


def token_counts(data: bytes | None) -> dict[str, int]:
    """Tokens of a file's content streams by kind."""
    out = {"string": 0, "number": 0, "operator": 0}
    for body in content_streams(data or b""):
        for kind, _ in tokens(body):
            if kind in out:
                out[kind] += 1
    return out


def count_tokens(df: DataFrame, id_col: str = "path", content_col: str = "content") -> DataFrame:
    """(id, n_strings, n_numbers, n_operators) of rows with PDF bytes."""
    ship(df.sparkSession)
    src = df.select(df[id_col].alias("id"), df[content_col].cast("binary").alias("content"))

    def run(batches):
        for b in (p for whole in batches for p in portions(whole)):
            got = [token_counts(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([g[k] for g in got], pa.int64()) for k in ("string", "number", "operator")]], ["id", "n_strings", "n_numbers", "n_operators"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_strings long, n_numbers long, n_operators long")


def extract(df: DataFrame, id_col: str = "path", content_col: str = "content") -> DataFrame:
    """(id, text) of rows with PDF bytes, such as spark.read.format("binaryFile") gives."""
    ship(df.sparkSession)
    src = df.select(df[id_col].alias("id"), df[content_col].cast("binary").alias("content"))

    def run(batches):
        for b in (p for whole in batches for p in portions(whole)):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([text_of(x) for x in b.column(1).to_pylist()], pa.string())], ["id", "text"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text string")
