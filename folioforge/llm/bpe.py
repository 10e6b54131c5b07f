"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of tokens, and many pre-tokens share a queue.
Every neighbouring pair that the rank table can join lies in the bucket of its rank.  A two-level bitmap marks the
ranks whose buckets hold positions: find-first-set on the upper level picks a
group of 256 ranks, find-first-set on the lower one picks the rank.  A merge
pushes the at most two new pairs and leaves the old ones in place; an entry
whose position no longer carries its rank is stale and is skipped when popped.
A pre-token of n bytes thus takes O(n log n) however long it is, where a scan
for the minimum takes O(n^2).

Results: null text counts as empty, empty text has no ids.  Only the id and
text columns are read, so further columns of any name are ignored.  Repeated
rows give repeated results.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship

#: Code points with the Unicode property White_Space (fixed values).
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0                　")
#: A blank or line feed that white space follows: there a cut could split a run of white space wrongly.
UNSAFE = re.compile(r"[ \n]\s")
#: Single blanks and line feeds between other characters.
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
NONE = 1 << 30


#: Stands before, between and after the pre-tokens of a queue; no pair with it is in a table.
EDGE = (1 << 20) - 1
#: Bytes of pre-tokens that share a queue (a longer pre-token has one of its own).
QUEUE = 1 << 16
#: Characters of texts whose unknown pre-tokens are merged together (a longer text stands alone).
TOGETHER = 1 << 19

_BIT = [1 << i for i in range(256)]


class Ranks:
    """The rank table, and from it which two neighbouring tokens make which token."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= EDGE:
            raise ValueError(f"ranks must be under {EDGE}")
        self.whole = ranks
        self.byte = np.array([*(ranks[bytes([i])] for i in range(256)), EDGE])
        self.join = {ranks[t[:k]] << 20 | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.words = (max(ranks.values()) >> 8) + 1
        # the rank of two bytes; 256 stands for an edge
        self.two = np.full(257 * 257, NONE)
        for t, r in ranks.items():
            if len(t) == 2:
                self.two[t[0] * 257 + t[1]] = r


def _drained(heap: list[int]) -> Iterator[int]:
    while heap:
        yield heappop(heap)


def merge(pieces: list[bytes], ranks: Ranks) -> list[bytes]:
    """The ids of each pre-token, as little-endian unsigned 32-bit integers: lowest rank first, leftmost first among equals.

    All pre-tokens lie in one linked list with edges between them, so a rank is looked for once for all of them. A
    bucket is emptied in order of position until a merge brings up a lower rank, which then comes first."""
    get = ranks.join.get
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    n = int(size.sum()) + len(pieces) + 1
    edges = np.concatenate([[0], np.cumsum(size + 1)])
    inner = np.ones(n, bool)
    inner[edges] = False
    start = np.full(n, 256)
    start[inner] = np.frombuffer(b"".join(pieces), np.uint8)
    first = np.append(ranks.two[start[:-1] * 257 + start[1:]], NONE)
    at = np.flatnonzero(first != NONE)
    at = at[np.argsort(first[at], kind="stable")]
    rank, cut_at = np.unique(first[at], return_index=True)
    cuts, order = [*cut_at.tolist(), len(at)], at.tolist()
    buckets: dict[int, list[int]] = {r: order[a:z] for r, a, z in zip(rank.tolist(), cuts, cuts[1:], strict=False)}
    token, pair = ranks.byte[start].tolist(), first.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n))
    upper, lower = 0, [0] * ranks.words
    held: dict[int, list[int]] = {}  # what is left of buckets that a lower rank came before, as heaps
    for r in buckets:
        lower[r >> 8] |= _BIT[r & 255]
        upper |= 1 << (r >> 8)
    while upper:
        w = (upper & -upper).bit_length() - 1
        word = lower[w]
        r = w << 8 | (word & -word).bit_length() - 1
        bucket = buckets.pop(r)
        lower[w] = word = word & (word - 1)
        if not word:
            upper &= upper - 1
        if r in held:
            rest = held.pop(r)
            for i in bucket:
                heappush(rest, i)
            source = _drained(rest)
        else:
            bucket.sort()
            rest, source = None, iter(bucket)
        low, left = r, r << 20
        for i in source:
            if pair[i] != r:
                continue  # stale
            j = after[i]
            after[i] = k = after[j]
            before[k] = i
            token[i], token[j] = r, -1
            pair[j] = NONE
            p = before[i]
            pair[i] = new = get(left | token[k], NONE)
            if new != NONE:
                if new in buckets:
                    buckets[new].append(i)
                else:
                    buckets[new] = [i]
                    v = new >> 8
                    lower[v] |= _BIT[new & 255]
                    upper |= 1 << v
                if new < low:
                    low = new
            pair[p] = new = get(token[p] << 20 | r, NONE)
            if new != NONE:
                if new in buckets:
                    buckets[new].append(p)
                else:
                    buckets[new] = [p]
                    v = new >> 8
                    lower[v] |= _BIT[new & 255]
                    upper |= 1 << v
                if new < low:
                    low = new
            if low < r:
                rest = list(source) if rest is None else rest  # sorted, so a heap
                if rest:
                    held[r], buckets[r] = rest, []
                    lower[w] |= _BIT[r & 255]
                    upper |= 1 << w
                break
    out = np.array(token)
    out = out[out >= 0].astype("<u4")
    ends, raw = (np.flatnonzero(out == EDGE) * 4).tolist(), out.tobytes()
    return [raw[a + 4 : z] for a, z in zip(ends, ends[1:], strict=False)]


class _Remembered(dict):
    """What was met before, in two generations of at most `most` entries; the older one goes when the younger is full."""

    def __init__(self, most: int):
        self.most = most
        self.old: dict = {}

    def recall(self, key: str):
        got = self.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.keep(key, got)
        return got

    def keep(self, key: str, value):
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def cut(text: str) -> tuple[str, list[str], str]:
    """(first run, further runs without their leading blank, white space at the end).

    A pre-token pattern that takes at most one blank before a word never reaches
    over a single blank or line feed between two other characters, so the runs
    can be encoded one by one and remembered.
    """
    end = len(text)
    while end and text[end - 1] in WHITE:
        end -= 1
    body = text[:end]
    if UNSAFE.search(body):
        runs = [r[1:] if i and r[0] == " " else r for i, r in enumerate(SAFE_CUT.split(body))]
    else:
        runs = body.replace("\n", " \n").split(" ")
    return runs[0], runs[1:], text[end:]


class Codec:
    def __init__(self, path: str, pattern: str, pieces: int = 300_000, runs: int = 200_000):
        import regex

        with open(path, "rb") as f:
            whole = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = Ranks(whole)
        self.tokens: list[bytes] = [b""] * (max(whole.values()) + 1)
        for token, rank in whole.items():
            self.tokens[rank] = token
        self._find = regex.compile(pattern).findall
        self._pieces = _Remembered(pieces)
        self._runs = _Remembered(runs)

    def _merged(self, pieces: list[str]) -> dict[str, bytes]:
        """Pre-tokens that nothing is remembered of."""
        out, waiting, raws, size = {}, [], [], 0

        def empty():
            for p, ids in zip(waiting, merge(raws, self.ranks), strict=True):
                out[p] = self._pieces.keep(p, ids)
            waiting.clear()
            raws.clear()

        for p in pieces:
            raw = p.encode()
            whole = self.ranks.whole.get(raw)
            if whole is not None:
                out[p] = self._pieces.keep(p, struct.pack("<I", whole))
                continue
            if waiting and size + len(raw) > QUEUE:
                empty()
                size = 0
            waiting.append(p)
            raws.append(raw)
            size += len(raw)
        if waiting:
            empty()
        return out

    def _encoded(self, strings: list[str]) -> dict[str, bytes]:
        """Strings, each cut by the pattern alone -> ids."""
        found = [self._find(x) for x in strings]
        ids, new = {}, []
        recall = self._pieces.recall
        for p in set(chain.from_iterable(found)):
            got = recall(p)
            if got is None:
                new.append(p)
            else:
                ids[p] = got
        ids.update(self._merged(new))
        one = ids.__getitem__
        return {x: one(f[0]) if len(f) == 1 else b"".join(map(one, f)) for x, f in zip(strings, found, strict=True)}

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, held, size = [], [], 0
        for text in texts:
            text = text or ""
            if held and size + len(text) > TOGETHER:
                out += self._together(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        return out + self._together(held)

    def _together(self, texts: list[str]) -> list[bytes]:
        parts = [cut(t) for t in texts]
        ids, new, recall = {}, [], self._runs.recall
        for run in set(chain.from_iterable(rest for _, rest, _ in parts)):
            got = recall(run)
            if got is None:
                new.append(run)
            else:
                ids[run] = got
        spelled = [run if run[:1] == "\n" else " " + run for run in new]
        made = self._encoded(list({*spelled, *(x for first, _, tail in parts for x in (first, tail))}))
        for run, x in zip(new, spelled, strict=True):
            ids[run] = self._runs.keep(run, made[x])
        one = ids.__getitem__
        return [made[first] + b"".join(map(one, rest)) + made[tail] for first, rest, tail in parts]

    def encode(self, text: str | None) -> bytes:
        """Ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process; its memory stays bounded."""
    return Codec(path, pattern)


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """(path of the rank file, pre-token pattern) of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def bpe_encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, ids binary): ids as little-endian unsigned 32-bit integers; with decode also `decoded` binary, from the ids."""
    ship(df.sparkSession)
    src = df.select(df[id_col].alias("id"), *[df[c] for c in keep], df[text_col].cast("string").alias("text"))
    at = len(keep) + 1
    names = ["id", *keep, "ids", "decoded"][: at + 1 + decode]

    def run(batches):
        c = codec(path, pattern)
        for b in _slices(batches):
            ids = c.encode_all(b.column(at).to_pylist())
            cols = [*b.columns[:at], pa.array(ids, pa.binary())]
            if decode:
                cols.append(pa.array([c.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:at])
    return src.mapInArrow(run, f"{fields}, ids binary" + ", decoded binary" * decode)


def bpe_decode(df: DataFrame, path: str, pattern: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) of little-endian unsigned 32-bit ids; null counts as empty."""
    ship(df.sparkSession)
    src = df.select(df[id_col].alias("id"), df[ids_col].alias("ids"))

    def run(batches):
        c = codec(path, pattern)
        for b in _slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or b"") for x in b.column(1).to_pylist()], pa.binary())], ["id", "decoded"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, decoded binary")
