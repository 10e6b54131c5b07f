"""Token ids as flat unsigned files with 64-bit document offsets.

Layout of a folder: part-NNNNN.bin holds the ids of the documents of one range
of keys, back to back, as little-endian unsigned integers (16 bits where every
id of the vocabulary fits, else 32); part-NNNNN.idx holds n+1 unsigned 64-bit
offsets into it, counted in ids; part-NNNNN.key holds n signed 64-bit keys and
a bitmap byte each (1: key is null).  Parts follow one another in ascending
key order.  The base of a part, the ids of all parts before it, is a prefix
sum over the part totals: one number for each part, never one for each row.

Recovery: a task writes under a name of its own attempt and moves the file to
its place at the end, so a task run anew replaces equal bytes.

Rows: null text counts as empty (it still gets the end id), rows with equal
keys follow the hash of their text, null keys come first, repeated rows are
written as often as they come, further columns are not read.
"""

from __future__ import annotations

import functools
import os
import string
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import WHITE, _slices, cut
from .common import fresh_path, saved, ship


class LibraryCodec:
    """The tokenizers library, run over what a text holds between safe cuts (see bpe.cut).

    A byte-level pre-tokenizer never joins what such a cut parts, so the ids of
    the runs, one after another, are those of the whole text. Runs met before
    are remembered, in two generations of bounded size; all new ones of some
    rows go through the library as one text and are told apart by their bytes.
    """

    def __init__(self, path: str, remembered: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.width = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.n_bytes[i] = len(added[i].encode()) if i in added else len(token)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.remembered = remembered
        self.special = tuple(added.values())
        self.tails: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids if text else [], self.width)

    def _learn(self, runs: list[str]) -> None:
        texts = [r if r[:1] == "\n" else " " + r for r in runs]
        line = "".join(texts)
        ids = self._ids(line)
        ends = np.cumsum(self.n_bytes[ids])
        sizes = map(len, texts) if line.isascii() else (len(t.encode()) for t in texts)
        stops = np.searchsorted(ends, np.cumsum(np.fromiter(sizes, np.int64, len(texts))), "left") + 1
        raw, start = ids.tobytes(), 0
        for run, stop in zip(runs, (stops * self.width.itemsize).tolist(), strict=True):
            self.young[run] = raw[start:stop]
            start = stop

    def _tail(self, signs: str) -> bytes:
        got = self.tails.get(signs)
        if got is None:
            if len(self.tails) > 20_000:
                self.tails.clear()
            got = self.tails[signs] = self._ids(signs).tobytes()
        return got

    def _meet(self, fresh: list[str]) -> None:
        """Learn new runs. Signs behind a letter or digit are a pre-token of their own, so a word is learned once for all signs that follow it."""
        line = "\n".join(fresh)
        special = [a for a in self.special if a in line]
        plain: set[str] = set()
        made = []
        for r in fresh:
            stem = r.rstrip(string.punctuation)
            if len(stem) == len(r) or not ((z := stem[-1:]).isalpha() or z.isdecimal()) or special and any(a in r for a in special):
                plain.add(r)
                continue
            made.append((r, stem))
            if stem not in self.young:
                if (got := self.old.get(stem)) is None:
                    plain.add(stem)
                else:
                    self.young[stem] = got
        if plain:
            self._learn(list(plain))
        for r, stem in made:
            self.young[r] = self.young[stem] + self._tail(r[len(stem) :])

    def encode(self, texts: list[str | None], end_id: int | None = None) -> list[bytes]:
        """The ids of each text in the width of the file, with end_id appended."""
        if len(self.young) > self.remembered:
            self.young, self.old = {}, self.young
        parts = []
        for t in texts:
            first, runs, tail = cut(t) if t else ("", [], "")
            after_feed = first[:1] not in WHITE and first != ""
            if after_feed:  # a line feed before it is a token of its own, so it can be remembered like the others
                runs.insert(0, "\n" + first)
            parts.append((after_feed, first, runs, tail))
        # what these texts need, looked up once for all of them: most words come back, and a small table is near at hand
        need = set().union(*(runs for _, _, runs, _ in parts))
        held = dict(zip(need, map(self.young.get, need), strict=True))
        fresh = []
        missing = [r for r, got in held.items() if got is None]
        for r in missing:
            if (got := self.old.get(r)) is None:
                fresh.append(r)
            else:
                self.young[r] = got
        if fresh:
            self._meet(fresh)
        for r in missing:
            held[r] = self.young[r]
        end = b"" if end_id is None else np.array([end_id], self.width).tobytes()
        out = []
        for after_feed, first, runs, tail in parts:
            ids = b"".join(map(held.__getitem__, runs))
            ids = ids[self.width.itemsize :] if after_feed else self._ids(first).tobytes() + ids
            out.append(ids + (self._ids(tail).tobytes() if tail else b"") + end)
        return out


@functools.lru_cache(maxsize=2)
def library_codec(path: str) -> LibraryCodec:
    return LibraryCodec(path)


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _put(store, target: str, pieces) -> None:
    own = f"{target}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        for p in pieces:
            f.write(p)
    store.move(own, target)


class _Writer:
    """One part, written as it comes; only offsets and keys stay in memory."""

    def __init__(self, folder: str, part: int):
        self.store, self.top = _store(folder)
        self.name = f"{self.top}/part-{part:05d}"
        self.own = f"{self.name}.bin.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.own)
        self.sizes: list[int] = []
        self.keys: list[int | None] = []

    def add(self, keys: list, rows: list[bytes], width: int) -> None:
        self.out.write(b"".join(rows))
        self.sizes += [len(r) // width for r in rows]
        self.keys += keys

    def close(self) -> tuple[int, int]:
        self.out.close()
        offsets = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.uint64)]).astype("<u8")
        null = np.array([k is None for k in self.keys], np.uint8)
        _put(self.store, f"{self.name}.idx", [offsets.tobytes()])
        _put(self.store, f"{self.name}.key", [np.array([k or 0 for k in self.keys], "<i8").tobytes(), null.tobytes()])
        self.store.move(self.own, f"{self.name}.bin")
        return len(self.keys), int(offsets[-1])


def write_tokens(df: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, key_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> list[tuple[int, int, int]]:
    """Write all rows in ascending key order; returns (part, base, rows) of each part, which is the folder's manifest."""
    spark = df.sparkSession
    ship(spark)
    store, top = _store(folder)
    store.create_dir(top, recursive=True)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = df.select(df[key_col].cast("long").alias("key"), df[text_col].cast("string").alias("text"))
    src = src.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie").select("key", "text")

    def run(batches):
        codec, part, writer = library_codec(tokenizer), TaskContext.get().partitionId(), None
        for b in _slices(batches, 64):
            writer = writer or _Writer(folder, part)
            writer.add(b.column(0).to_pylist(), codec.encode(b.column(1).to_pylist(), end_id), codec.width.itemsize)
        if writer:
            rows, ids = writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "n_rows": [rows], "n_ids": [ids]})

    done = saved(src.mapInArrow(run, "part long, n_rows long, n_ids long"), "token-parts").collect()  # a row for each part
    manifest, base = [], 0
    for r in sorted(done, key=lambda r: r.part):
        manifest.append((r.part, base, r.n_rows))
        base += r.n_ids
    _put(store, f"{top}/manifest.csv", ["".join(f"{p},{b},{r}\n" for p, b, r in manifest).encode()])
    return manifest


def _reader(folder: str, name: str, kind):
    """A function of (first, last) for the items of a file in that range: memory-mapped where the file lies in a mounted folder, else read by range."""
    store, top = _store(folder)
    if store.type_name == "local":
        path = f"{top}/{name}"
        items = np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
        return lambda a, z: items[a:z]
    file, width = store.open_input_file(f"{top}/{name}"), np.dtype(kind).itemsize

    def read(a: int, z: int) -> np.ndarray:
        file.seek(a * width)
        return np.frombuffer(file.read((z - a) * width), kind)

    return read


def read_tokens(spark: SparkSession, folder: str, manifest: list[tuple[int, int, int]], width: str = "<u2", step: int = 512) -> DataFrame:
    """(key, start, n_tokens, ids binary as little-endian unsigned 32 bits) of every document, from the files."""
    ship(spark)
    schema = "key long, start long, n_tokens long, ids binary"
    if not manifest:
        return spark.createDataFrame([], schema)
    # (part, base, rows, first row, last) of at most 64 pieces a part; the manifest has a line for each part
    todo = [(p, b, r, at, min(at + max(step, -(-r // 64)), r)) for p, b, r in manifest for at in range(0, r, max(step, -(-r // 64)))]
    jobs = spark.createDataFrame(todo, "part long, base long, rows long, first long, last long").repartition(min(len(todo), max(len(manifest), spark.sparkContext.defaultParallelism)))

    def run(batches):
        for batch in batches:
            for j in batch.to_pylist():
                name = f"part-{j['part']:05d}"
                n = j["rows"]
                offsets, ids = _reader(folder, f"{name}.idx", "<u8"), _reader(folder, f"{name}.bin", width)
                raw = _reader(folder, f"{name}.key", "u1")
                for at in range(j["first"], j["last"], step):
                    to = min(at + step, j["last"])
                    o = offsets(at, to + 1).astype(np.int64)
                    keys, null = raw(8 * at, 8 * to).view("<i8"), raw(8 * n + at, 8 * n + to)
                    held = np.ascontiguousarray(ids(int(o[0]), int(o[-1])), "<u4")
                    ends = (o - o[0]) * 4
                    if ends[-1] < 1 << 31:  # else the offsets of one array do not reach
                        raws = pa.BinaryArray.from_buffers(pa.binary(), to - at, [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(held)])
                    else:
                        raws = pa.array([held[a:z].tobytes() for a, z in zip((o[:-1] - o[0]).tolist(), (o[1:] - o[0]).tolist(), strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(keys), pa.int64(), mask=np.asarray(null) != 0), pa.array(o[:-1] + j["base"], pa.int64()), pa.array(np.diff(o), pa.int64()), raws],
                        ["key", "start", "n_tokens", "ids"],
                    )

    return jobs.mapInArrow(run, schema)


def crc32(data: bytes) -> int:
    return zlib.crc32(data)


def token_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "tokens")
