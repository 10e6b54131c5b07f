"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

Words are runs of letters and digits or of other signs. A word of the
vocabulary (the `words` words of most training documents, of at least `least`:
the size of the model) stands for itself, any other for its class of shape; repetition inside a text (a word
equal to the one before it, a word pair met before in the text) adds words of
its own. Every word has a sparse random index vector; its word vector is the
sum of the index vectors of the words around it in the training documents,
scaled by the logarithm of its rarity. A document is the mean of its words'
vectors next to the mean of their index vectors. A two-layer numpy network
maps that to a logit; a temperature fitted on training rows it has not seen
makes it a probability.

Only the text enters a score: never label, language, source or id.

Fitting takes a bounded sample of the labelled rows of the training folds: at
most `most` rows, in the order of a hash of their id, and at most `most_bytes`
of text; a row that would pass the second bound is left out whole. An id that
stands in several rows gives one of them. Scoring runs over all rows and whole texts.
Null text counts as empty; empty texts get a score too. Rows with a null id
have no label; their fold is that of the empty text, so they are held out.
Further columns are not read; repeated rows are scored alike.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _slices
from .common import saved, ship

_WORD = re.compile(r"[^\W_]+|[^\w\s]+|_+")
DIM = 64
#: Words that are no words of a text (fixed order).
CLASSES = ("<lower>", "<title>", "<caps>", "<number>", "<mixed>", "<sign>", "<long>", "<same>", "<again>", "<line>", "<empty>")
N = len(CLASSES)


def _shape(word: str) -> int:
    if len(word) > 24:
        return 6
    if word.isdigit():
        return 3
    if not word[0].isalnum():
        return 5
    if word.islower():
        return 0
    if len(word) > 1 and word.isupper():
        return 2
    if word.istitle():
        return 1
    return 4


class _Ids(dict):
    def __init__(self, vocabulary: dict[str, int], most: int = 300_000):
        super().__init__()
        self.vocabulary, self.most = vocabulary, most

    def __missing__(self, word: str) -> int:
        got = self.vocabulary.get(word)
        if got is None:
            got = _shape(word)
        if len(word) <= 32:
            if len(self) >= self.most:
                self.clear()
            self[word] = got
        return got


def _counts(text: str | None, ids: _Ids) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers in order, numbers of the words that repetition adds)."""
    words = _WORD.findall(text or "")
    if not words:
        return np.array([CLASSES.index("<empty>")]), np.empty(0, np.int64)
    got = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    marks = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)  # equality inside this text only
    same = int((marks[1:] == marks[:-1]).sum())
    pairs = marks[1:] * np.uint64(0x9E3779B97F4A7C15) + marks[:-1]
    again = len(pairs) - len(np.unique(pairs)) if len(pairs) else 0
    extra = np.repeat([CLASSES.index("<same>"), CLASSES.index("<again>"), CLASSES.index("<line>")], [same, again, text.count("\n")])
    return got, extra


def index_vector(word: str, dim: int = DIM, ones: int = 6) -> np.ndarray:
    """Sparse, ternary, from a hash of the word alone."""
    out = np.zeros(dim, np.float32)
    raw = hashlib.blake2b(word.encode(), digest_size=4 * ones).digest()
    for k in range(ones):
        x = int.from_bytes(raw[4 * k : 4 * k + 4], "little")
        out[x % dim] += 1.0 if x >> 31 else -1.0
    return out


class QualityModel:
    def __init__(self, vocabulary: dict[str, int], vectors: np.ndarray, mean: np.ndarray, scale: np.ndarray, layers: list[np.ndarray], temperature: float):
        self.vocabulary, self.vectors, self.mean, self.scale, self.layers, self.temperature = vocabulary, vectors, mean, scale, layers, temperature
        self.key = hashlib.sha256(vectors.tobytes() + b"".join(x.tobytes() for x in layers)).hexdigest()

    def pooled(self, texts: list[str | None]) -> np.ndarray:
        ids = _ids(self.key, self)
        out = np.empty((len(texts), self.vectors.shape[1] + 1), np.float32)
        for i, t in enumerate(texts):
            got, extra = _counts(t, ids)
            every = np.concatenate([got, extra])
            number, times = np.unique(every, return_counts=True)
            out[i, :-1] = times.astype(np.float32) @ self.vectors[number] / len(got)
            out[i, -1] = np.log1p(len(got))
        return out

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2[0]

    def score(self, texts: list[str | None]) -> np.ndarray:
        z = self.logit(self.pooled(texts)).astype(np.float64) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@functools.lru_cache(maxsize=4)
def _ids_of(key: str):
    return {}


def _ids(key: str, model: QualityModel) -> _Ids:
    held = _ids_of(key)
    if "ids" not in held:
        held["ids"] = _Ids(model.vocabulary)
    return held["ids"]


def word_vectors(texts: list[str], words: int = 6000, least: int = 5, reach: int = 2, dim: int = DIM) -> tuple[dict[str, int], np.ndarray]:
    """(vocabulary, vectors): context vectors by random indexing, beside the index vectors."""
    seen: dict[str, int] = {}
    for t in texts:
        for w in set(_WORD.findall(t)):
            seen[w] = seen.get(w, 0) + 1
    kept = sorted((w for w, c in seen.items() if c >= least), key=lambda w: (-seen[w], w))[:words]
    vocabulary = {w: N + i for i, w in enumerate(kept)}
    names = [*CLASSES, *kept]
    index = np.stack([index_vector(w, dim) for w in names])
    size = len(names)
    ids = _Ids(vocabulary)
    context = np.zeros((size, dim), np.float32)
    documents = np.zeros(size)
    for at in range(0, len(texts), 64):
        left, right = [], []
        for t in texts[at : at + 64]:
            got, extra = _counts(t, ids)
            documents[np.unique(np.concatenate([got, extra]))] += 1
            for d in range(1, reach + 1):
                left += [got[:-d], got[d:]]
                right += [got[d:], got[:-d]]
        if left:
            pair, times = np.unique(np.concatenate(left) * size + np.concatenate(right), return_counts=True)
            a, b = pair // size, pair % size
            starts = np.flatnonzero(np.diff(a, prepend=-1))
            context[a[starts]] += np.add.reduceat(index[b] * times[:, None].astype(np.float32), starts, axis=0)
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-6)
    index /= np.maximum(np.linalg.norm(index, axis=1, keepdims=True), 1e-6)  # the signs of a word may cancel out
    rare = np.log1p(len(texts) / (1 + documents)).astype(np.float32)[:, None] + 0.1
    return vocabulary, np.concatenate([context * rare, index * rare, np.eye(size, N, dtype=np.float32) * rare], 1)


def _train(x: np.ndarray, y: np.ndarray, hidden: int, rounds: int, decay: float, seed: int) -> list[np.ndarray]:
    r = np.random.default_rng(seed)
    w = [r.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), r.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for t in range(1, rounds + 1):
        h = np.maximum(x @ w[0] + w[1], 0)
        p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3][0], -30, 30)))
        e = (p - y) / len(y)
        back = e[:, None] * w[2] * (h > 0)
        grads = [x.T @ back + decay * w[0], back.sum(0), h.T @ e + decay * w[2], np.array([e.sum()])]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] -= 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return [a.astype(np.float32) for a in w]


def fit(texts: list[str | None], labels: list[int], words: int = 6000, hidden: int = 24, rounds: int = 250, decay: float = 1e-3, seed: int = 7) -> QualityModel:
    """Every fifth row calibrates, the others train. Without rows of both labels the score is their share (1/2 without rows)."""
    texts = [t or "" for t in texts]
    y = np.array(labels, np.float64)
    vocabulary, vectors = word_vectors(texts, words)
    width = vectors.shape[1] + 1
    model = QualityModel(vocabulary, vectors, np.zeros(width, np.float32), np.ones(width, np.float32), [np.zeros((width, 1), np.float32), np.zeros(1, np.float32), np.zeros(1, np.float32), np.zeros(1, np.float32)], 1.0)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2)
        model.layers[3] = np.array([np.log(share / (1 - share))], np.float32)
        return model
    x = model.pooled(texts)
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-3
    held = np.arange(len(y)) % 5 == 4
    if held.all() or not 0 < y[~held].sum() < (~held).sum():
        held[:] = False
    z = ((x - model.mean) / model.scale).astype(np.float64)
    model.layers = _train(z[~held], y[~held], hidden, rounds, decay, seed)
    if held.any():
        logit = model.logit(x[held]).astype(np.float64)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
        loss = [np.logaddexp(0, np.where(y[held] > 0, -1, 1) * logit / t).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fold(col):
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 5


def fit_from(documents: DataFrame, labels: DataFrame, most: int = 6000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_bytes: int = 64 << 20) -> QualityModel:
    """Fit on at most `most` labelled rows outside fold 0, those with the least hash of the id, of at most `most_bytes` together; that much text comes to the driver."""
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
        .where("id IS NOT NULL AND label IS NOT NULL")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .where(fold(F.col("id")) != 0)
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    # `most` rows of two numbers
    rows = documents.select(documents[id_col].alias("id"), F.coalesce(documents[text_col].cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    rows = saved(rows.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("id", "label", "t.text"), "labelled")
    sizes = rows.select("id", F.octet_length("text").alias("n"), F.xxhash64("id").alias("h")).collect()
    taken, room = [], most_bytes
    for r in sorted(sizes, key=lambda r: (r.h, str(r.id))):
        if r.n <= room:
            room -= r.n
            taken.append(r.id)
    if len(taken) < len(sizes):
        rows = rows.where(F.col("id").isin(taken))
    found = sorted(((r.id, r.text, int(r.label > 0)) for r in rows.collect()), key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0])))
    return fit([r[1] for r in found], [r[2] for r in found])


def score(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score double) of every row."""
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)  # about 140 numbers for each of the model's words, 3 MB for 6,000
    src = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches):
        for b in _slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held.value.score(b.column(1).to_pylist()))], ["id", "score"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, score double")


def keep_good(df: DataFrame, model: QualityModel, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of df whose score is at least `least`, with all their columns."""
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches):
        for b in _slices(batches):
            yield b.filter(pa.array(held.value.score(b.column(at).to_pylist()) >= least))

    return df.mapInArrow(run, df.schema)
