"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: majorities of the bits of word shingles' hashes, see
fingerprint(); one word of 64 bits, or several. Distinct ones are dealt into
blocks and compared within a block tile by tile: numpy exclusive-or and bit
counts over 1,024 x 1,024 fingerprints, where a tile pair is skipped if the
population counts of its sides differ beyond the radius (rows of a block are
sorted by population count) or if all its rows already are in one class.

near_duplicates(): fingerprints of 64 bits link within `radius` bits. Blocks are
choices of bit ranges: of m ranges a link leaves m - radius unchanged at least, so
each choice of m - radius ranges is a key, and a link shares one key at least. m
is taken from the number of fingerprints (see ranges()): with more ranges the
keys are longer and a block stays small, but there are more of them. Pairs met
by a row grow with the corpus between two such steps and fall at each, instead of
growing in proportion to it.

drop_near_duplicates(): texts whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more. Candidates come from fingerprints of 512 bits whose
radius lies well beyond that similarity (see radius_for). Blocks are the least
hashes of a text's shingles under eight hash functions: two texts agree in one of
them with the probability of their similarity, so one link in 400,000 at 0.8
shares no block, and texts that share no shingle never meet. A block over `most`
rows is split by the seven others first. Then the sets themselves decide: within
each class of candidates the tiles are gone through again, and classes are united
only by a pair whose sets of shingles (XXH64 of each) have the similarity, nearest
fingerprints first. Only the sets of one text of each set move, and only of
those that have a candidate; classes over `most` rows or `most_bytes` of sets are
dealt by their least hashes, then cut.

In both, a block still over `most` rows is cut into chunks and every pair of
chunks becomes a task of its own. A task returns a spanning forest of its links
(fewer rows than it read), never all pairs. Classes come from components(). What
is joined by a fingerprint or a class is dealt to many parts of it, so a third of
all rows may share one.

Null text counts as empty, and all texts without a word share fingerprint 0,
which links like any other. Rows with a null id get the class of their
fingerprint; classes are named by the smallest id that is not null. Equal rows
come back as often as they came. Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import _slices
from .common import free_names, saved, ship, spread_join
from .components import components
from .simhash import masks, ranges

TILE = 1024


def shingle_hashes(text: str | None, width: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included: A-Z lower-cased, words between white space (U+0020, U+0009 to U+000D), `width` words joined by a space, or all of them if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[a:z], seed) for a, z in pairs), np.uint64, len(words) - width + 1)


def majority(hashes: np.ndarray) -> np.uint64:
    """64 bits, each set if it is set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        votes += np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0]


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    hashes = shingle_hashes(text, width, seed)
    return int(majority(hashes)) if len(hashes) else 0


def mixed_bits(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash function k of the hashes (the finisher of splitmix64 over a step of its own)."""
    with np.errstate(over="ignore"):
        z = hashes + np.uint64((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


WORDS, TABLES = 8, 8


def wide_fingerprint(text: str | None, width: int = 5, seed: int = 42) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(512 bits as words, least hashes, hash of the set, its size): over the set of shingles, so repeats inside a text do not count."""
    hashes = np.unique(shingle_hashes(text, width, seed))
    node = xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), seed)
    if not len(hashes):
        return np.zeros(WORDS, np.uint64), np.zeros(TABLES, np.uint64), node, 0
    bits = np.array([majority(mixed_bits(hashes, k)) for k in range(1, WORDS + 1)], np.uint64)
    return bits, np.array([mixed_bits(hashes, 1000 + k).min() for k in range(TABLES)], np.uint64), node, len(hashes)


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sets as arrays without repeats."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(len(x) + len(y) - both, 1)


def radius_for(similarity: float, bits: int = 64 * WORDS, spare: float = 6.0) -> int:
    """Differing bits up to which texts of a Jaccard similarity are candidates: the mean for sets of equal size, the farthest (bits differ with the angle between them), and `spare` standard deviations more, as ties of very small sets (four shingles against five) lie over the mean."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * p + spare * math.sqrt(bits * p * (1 - p)))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp long): the 64 bits of each row."""
    ship(df.sparkSession)
    src = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches):
        for b in _slices(batches):
            bits = np.array([fingerprint(t, width, seed) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bits.view(np.int64))], ["id", "fp"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, fp long")


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent[:] = up


def _unite_checked(parent: np.ndarray, rows: np.ndarray, cols: np.ndarray, apart: np.ndarray, sets: list[np.ndarray], similarity: float) -> None:
    """Unite the classes of those pairs whose sets have the similarity.

    Nearest pairs first, one of each class in the first round and twice as many in each further one, so that
    most pairs are in one class before their turn and every other one is checked."""
    order = np.argsort(apart, kind="stable")
    rows, cols, each = rows[order], cols[order], 1
    while True:
        own = parent[rows]
        left = own != parent[cols]
        rows, cols, own = rows[left], cols[left], own[left]
        if not len(rows):
            return
        by = np.argsort(own, kind="stable")
        place = np.arange(len(by))
        first = np.concatenate([[True], np.diff(own[by]) != 0])
        turn = by[place - np.maximum.accumulate(np.where(first, place, 0)) < each]
        for x, y in zip(rows[turn].tolist(), cols[turn].tolist(), strict=True):
            if jaccard(sets[x], sets[y]) < similarity:
                continue
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        _roots(parent)
        rows, cols = np.delete(rows, turn), np.delete(cols, turn)
        each *= 2


def classes_of(bits: np.ndarray, radius: int, chunk: np.ndarray | None = None, stats: dict | None = None, sets: list[np.ndarray] | None = None, similarity: float = 0.0) -> np.ndarray:
    """For each of the fingerprints (rows of one or more words, sorted by population count) the index of the first one of its class.

    With chunk, only rows of different chunks are compared. With sets, a pair links only if its sets have the similarity too."""
    bits = bits.reshape(len(bits), -1)
    n = len(bits)
    parent = np.arange(n)
    if n < 2:
        return parent
    count = np.bitwise_count(bits).sum(1, dtype=np.int16)
    size = None if sets is None else np.array([len(x) for x in sets])
    for a in range(0, n, TILE):
        za = min(a + TILE, n)
        for b in range(a, n, TILE):
            zb = min(b + TILE, n)
            if int(count[b]) - int(count[za - 1]) > radius:
                break  # sorted: all later tiles differ more
            pa_, pb = parent[a:za], parent[b:zb]
            if chunk is None and pa_.min() == pa_.max() == pb.min() == pb.max():
                continue
            if stats is not None:
                stats["tiles"] = stats.get("tiles", 0) + 1
            apart = np.zeros((za - a, zb - b), np.uint16)
            for w in range(bits.shape[1]):
                apart += np.bitwise_count(bits[a:za, None, w] ^ bits[None, b:zb, w])
            near = apart <= radius
            if chunk is not None:
                near &= chunk[a:za, None] != chunk[None, b:zb]
            if sets is not None:
                low, high = np.minimum(size[a:za, None], size[None, b:zb]), np.maximum(size[a:za, None], size[None, b:zb])
                near &= low >= similarity * high
                rows, cols = np.nonzero(np.triu(near, 1) if a == b else near)
                _unite_checked(parent, rows + a, cols + b, apart[rows, cols], sets, similarity)
                continue
            if a == b:
                np.fill_diagonal(near, False)
            rows, cols = np.nonzero(near.any(1))[0], np.nonzero(near.any(0))[0]
            if not len(rows):
                continue
            near = near[np.ix_(rows, cols)]
            rows, cols = rows + a, cols + b
            while True:  # least root over the links of this tile pair, until nothing moves
                low_rows = np.minimum(parent[rows], np.where(near, parent[cols][None, :], n).min(1))
                low_cols = np.minimum(parent[cols], np.where(near, low_rows[:, None], n).min(0))
                before = parent.copy()
                np.minimum.at(parent, parent[rows], low_rows)
                np.minimum.at(parent, parent[cols], low_cols)
                _roots(parent)
                if np.array_equal(before, parent):
                    break
    return parent


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of one key after another; rows come sorted by the first column."""
    held: list[np.ndarray] | None = None
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        edges = np.flatnonzero(np.diff(cols[0])) + 1
        bounds = [0, *edges.tolist()]
        for a, z in zip(bounds, bounds[1:], strict=False):
            yield [c[a:z] for c in cols]
        held = [c[bounds[-1] :] for c in cols]
    if held is not None and len(held[0]):
        yield held


def _tasks(dealt: DataFrame, most: int, most_bytes: int = 64 << 20) -> DataFrame:
    """dealt (block, node long, bits binary) -> (task, chunk, node, bits): blocks of two rows or more, one task each; those over `most` rows are cut into chunks, each pair of which is a task.

    With a column n_bytes, of what a row will bring to its task, blocks over `most_bytes` of it are cut too."""
    full = F.count("*") / most
    if "n_bytes" in dealt.columns:
        full = F.greatest(full, F.sum("n_bytes") / most_bytes)
    size = dealt.groupBy("block").agg(F.ceil(full).cast("int").alias("chunks"), F.count("*").alias("n")).where("n > 1").select("block", "chunks")
    dealt = spread_join(dealt, size, ["block"], "node")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.select("node", "bits", "block", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    return dealt.select(
        F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other"), F.col("own") == F.col("other")).alias("task"),
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("chunk"),
        "node",
        "bits",
    )


def _forest(tasks: DataFrame, radius: int, similarity: float = 0.0) -> DataFrame:
    """tasks (task, chunk, node, bits) -> (a, b): of each task a spanning forest of its links, as stars around the least node of each class. With a column shingles (binary, the set as unsigned 64-bit integers) a link is a pair whose sets have the similarity."""
    more = ["shingles"] if "shingles" in tasks.columns else []
    dealt = tasks.withColumn("count", _population("bits")).repartition("task").sortWithinPartitions("task", "count", "node").select("task", "node", "chunk", "bits", *more)

    def run(batches):
        for _, node, chunk, raw, *held in _by_key(batches):
            if len(node) < 2:
                continue
            apart = chunk[0] >= 0
            sets = [np.frombuffer(x, "<u8") for x in held[0]] if held else None
            root = classes_of(np.frombuffer(b"".join(raw), "<u8").reshape(len(raw), -1), radius, chunk if apart else None, sets=sets, similarity=similarity)
            least = node.copy()
            np.minimum.at(least, root, node)
            least = least[root]
            mine = np.flatnonzero(node != least)
            if len(mine):
                yield pa.RecordBatch.from_arrays([pa.array(node[mine]), pa.array(least[mine])], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _population(bits: str):
    """Set bits of a binary column of whole words."""
    return F.expr(f"aggregate(sequence(0, CAST(octet_length({bits}) DIV 8 AS INT) - 1), 0, (s, k) -> s + bit_count(CAST(conv(hex(substring({bits}, 8 * k + 1, 8)), 16, -10) AS BIGINT)))")


def links(distinct: DataFrame, radius: int = 4, most: int = 50_000, parts: int | None = None) -> DataFrame:
    """(a, b): a spanning forest, block by block, of the links between distinct fingerprints `fp`. parts: the number of bit ranges, by default from the number of fingerprints."""
    m = parts or ranges(distinct.count(), radius)
    key = [F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(x).cast("long"))) for t, x in enumerate(masks(m, radius))]
    return _forest(_tasks(distinct.select(F.col("fp").alias("node"), _little(F.col("fp")).alias("bits"), F.explode(F.array(*key)).alias("block")).select("block", "node", "bits"), most), radius)


def _little(col):
    """A long as eight bytes, the lowest first."""
    byte = lambda k: F.lpad(F.hex(F.shiftrightunsigned(col, 8 * k).bitwiseAND(F.lit(255))), 2, "0")
    return F.unhex(F.concat(*[byte(k) for k in range(8)]))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42, radius: int = 4) -> DataFrame:
    """(id, fp, component): of each row its fingerprint and the smallest id of its class."""
    prints = saved(fingerprints(df, id_col, text_col, width, seed), "fingerprints")
    distinct = saved(prints.groupBy("fp").agg(F.min("id").alias("id")), "distinct")
    found = saved(components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp"), "classes")
    # a fingerprint without links is a class of its own; only linked ones meet by class
    rooted = saved(distinct.join(found, "fp"), "rooted")
    named = rooted.groupBy("root").agg(F.min("id").alias("component"))
    linked = spread_join(rooted, named, ["root"], "fp").select("fp", "component")
    label = saved(distinct.join(linked, "fp", "left").select("fp", F.coalesce("component", "id").alias("component")), "labels")
    return spread_join(prints, label, ["fp"], "id").select("id", "fp", "component")


def wide_fingerprints(df: DataFrame, keys: list[str], text_col: str, width: int = 5, seed: int = 42) -> DataFrame:
    """(keys, node long, bits binary, least array<long>, n_bytes long) of each row; node is a hash of the set of shingles, n_bytes what the set takes."""
    ship(df.sparkSession)
    src = df.select(*keys, df[text_col].cast("string").alias("text"))
    at = len(keys)

    def run(batches):
        for b in _slices(batches):
            made = [wide_fingerprint(t, width, seed) for t in b.column(at).to_pylist()]
            bits = [x.astype("<u8").tobytes() for x, _, _, _ in made]
            node = np.array([x for _, _, x, _ in made], np.uint64).view(np.int64)
            least = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1) * TABLES, pa.int32()), pa.array(np.concatenate([x for _, x, _, _ in made] or [np.empty(0, np.uint64)]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(node), pa.array(bits, pa.binary()), least, pa.array([8 * x for *_, x in made], pa.int64())], [*keys, "node", "bits", "least", "n_bytes"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:at])
    return src.mapInArrow(run, f"{fields}, node long, bits binary, least array<long>, n_bytes long")


def similar_links(distinct: DataFrame, radius: int, most: int = 20_000) -> DataFrame:
    """distinct (node, bits, least) -> (a, b): links of nodes within the radius that share one of their least hashes."""
    rows = distinct.select("node", "bits", "least", F.posexplode("least").alias("t", "m")).select("node", "bits", "least", "t", F.xxhash64("t", "m").alias("block"))
    size = rows.groupBy("block").agg(F.count("*").alias("n")).where("n > 1")
    # a link inside a large block agrees in one of the other hashes too
    other = F.expr("filter(transform(least, (x, k) -> CASE WHEN k <> t THEN xxhash64(block, k, x) END), y -> y IS NOT NULL)")
    blocks = F.when(F.col("n") > most, other).otherwise(F.array("block"))
    dealt = spread_join(rows, size, ["block"], "node").select(F.explode(blocks).alias("block"), "node", "bits")
    return _forest(_tasks(saved(dealt, "dealt"), most), radius)


def shingle_sets(df: DataFrame, text_col: str, width: int = 5, seed: int = 42) -> DataFrame:
    """df with the column of texts replaced by shingles (binary): the set of their hashes, ascending, as unsigned 64-bit integers."""
    ship(df.sparkSession)
    keys = [c for c in df.columns if c != text_col]
    src = df.select(*keys, df[text_col].cast("string").alias("text"))

    def run(batches):
        for b in _slices(batches):
            sets = [np.unique(shingle_hashes(t, width, seed)).astype("<u8").tobytes() for t in b.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(sets, pa.binary())], [*keys, "shingles"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(run, f"{fields}, shingles binary")


def checking_tasks(members: DataFrame, most: int = 20_000, most_bytes: int = 64 << 20) -> DataFrame:
    """members (node, root, bits, least, n_bytes) of classes of candidates, a table -> (node, tasks array<(task, chunk)>): where the set of each has to be. A class is one task; one over `most` rows or `most_bytes` is dealt by its least hashes and cut."""
    size = members.groupBy("root").agg(((F.count("*") > most) | (F.sum("n_bytes") > most_bytes)).alias("large"))
    blocks = F.when(F.col("large"), F.expr("transform(least, (x, k) -> xxhash64(root, k, x))")).otherwise(F.array("root"))
    dealt = spread_join(members, size, ["root"], "node").select(F.explode(blocks).alias("block"), "node", "bits", "n_bytes")
    return _tasks(saved(dealt, "dealt"), most, most_bytes).groupBy("node").agg(F.collect_list(F.struct("task", "chunk")).alias("tasks"))


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, seed: int = 42, similarity: float = 0.8, most: int = 20_000, most_bytes: int = 64 << 20
) -> DataFrame:
    """The rows of df that stay, with all their columns: of each class of texts of that similarity, taken over all links, the one with the least id (null ids last, then by a hash of the text)."""
    none, key, tie, nth = free_names(df.columns, "none", "id", "tie", "nth")
    # the id as two plain keys, so that the semi-join and the window share one exchange of the texts
    src = df.withColumns({none: df[id_col].isNull(), key: F.coalesce(df[id_col].cast("string"), F.lit("")), tie: F.xxhash64(df[text_col])})
    keys, radius = [none, key, tie], radius_for(similarity)
    plain = [F.col("row.none").alias(none), F.col("row.key").alias(key), F.col("row.tie").alias(tie)]
    row = F.struct(F.col(none).alias("none"), F.col(id_col).alias("id"), F.col(key).alias("key"), F.col(tie).alias("tie"))
    prints = saved(wide_fingerprints(src.select(row.alias("row"), F.col(text_col).alias("text")), ["row"], "text", width, seed), "fingerprints")
    distinct = saved(prints.groupBy("node").agg(F.min("row").alias("row"), F.first("bits").alias("bits"), F.first("least").alias("least"), F.first("n_bytes").alias("n_bytes")), "distinct")
    loose = saved(components(similar_links(distinct.select("node", "bits", "least"), radius, most)), "candidates")
    members = saved(distinct.join(loose, "node").select(*plain, "node", "root", "bits", "least", "n_bytes"), "members")
    # only now the texts: they meet the tasks they have to be in, so that their sets move once
    due = members.select(*keys, "node", "bits").join(checking_tasks(members, most, most_bytes), "node")
    texts = src.select(*keys, F.col(text_col).alias("text")).join(due, keys).select("node", "bits", "tasks", "text")
    tasks = shingle_sets(texts, "text", width, seed).select(F.explode("tasks").alias("at"), "node", "bits", "shingles").select("at.task", "at.chunk", "node", "bits", "shingles")
    found = saved(components(_forest(tasks, radius, similarity)), "classes")
    best = distinct.select("node", "row").join(found, "node", "left")
    stay = best.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("row").alias("row")).select(*plain)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(tie))
    return src.join(stay, keys, "left_semi").withColumn(nth, first).where(F.col(nth) == 1).select(*df.columns)
