import re

import numpy as np
import xxhash

from folioforge.llm import simhash_dedup as sd
from folioforge.llm.simhash import ranges
from folioforge.llm.q_simhash_dedup import op4_simhash_dedup


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def plain_classes(rows, radius=4):
    """(id, text) -> {(id, text): (fingerprint, smallest id)}"""
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k is None, k or 0), f"{f:016x}", least.get(find(i))) for i, ((k, _), f) in enumerate(zip(rows, fps, strict=True)))


def plain_groups(texts, width=5, similarity=0.8):
    """The group of each text, from the shingles of all pairs."""
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    group = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if group[i] != group[j] and (x == y or len(x & y) >= similarity * len(x | y)):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def shown(df):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id) for r in df.collect())


def test_classes_equal_brute_force():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    bits = [int(b) for b in base]
    for b in base:  # chains of near fingerprints
        x = int(b)
        for _ in range(int(r.integers(0, 60))):
            for k in r.integers(0, 64, int(r.integers(1, 4))):
                x ^= 1 << int(k)
            bits.append(x)
    bits = np.array(sorted(set(bits), key=lambda x: (x.bit_count(), x)), np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None]) <= 4
    want = np.arange(len(bits))
    while True:
        new = np.where(near, want[None], len(bits)).min(1)
        if (new == want).all():
            break
        want = new
    old, sd.TILE = sd.TILE, 64
    try:
        stats = {}
        assert (sd.classes_of(bits, 4, stats=stats) == want).all()
        tiles = -(-len(bits) // 64)
        assert stats["tiles"] < tiles * (tiles + 1) // 2  # population counts let some be skipped
    finally:
        sd.TILE = old


def test_large_blocks_are_cut_and_lose_nothing(spark):
    r = np.random.default_rng(5)
    x = r.integers(0, 1 << 62, 1, dtype=np.int64)[0]
    fps = sorted({int(x)} | {int(x ^ (1 << int(a)) ^ (1 << int(b))) for a, b in r.integers(0, 62, (120, 2)) if a != b})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    from folioforge.llm.components import components

    for most in (7, 50_000):
        got = components(sd.links(df, 4, most=most)).collect()
        assert {g.node for g in got} == set(fps) and len({g.root for g in got}) == 1


def _copies(r, n):
    """Texts of which some are copies of others with some words changed."""
    made = [[f"w{r.integers(0, 5000)}" for _ in range(int(r.integers(1, 120)))] for _ in range(n)]
    for _ in range(n):
        t = list(made[int(r.integers(0, n))])
        for _ in range(int(r.integers(0, 6))):
            t[int(r.integers(0, len(t)))] = "changed"
        made.append(t)
    return [" ".join(t) for t in made]


def test_similar_texts_by_brute_force_with_split_blocks(spark):
    texts = _copies(np.random.default_rng(9), 60) + ["", None, "one two", "One  two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = plain_groups(texts)
    assert 40 < len(set(group)) < len(texts) - 10
    for most, most_bytes in ((4, 64 << 20), (20_000, 500), (20_000, 64 << 20)):
        assert sorted(r.doc_id for r in sd.drop_near_duplicates(df, most=most, most_bytes=most_bytes).collect()) == sorted(set(group)), most


def test_checked_classes_equal_brute_force():
    """Chains of texts whose neighbours are just over or under the similarity; every failing pair of a tile is checked."""
    r = np.random.default_rng(4)
    texts = []
    for c in range(12):
        words = [f"c{c}w{k}" for k in range(60)]
        for step in range(30):
            texts.append(" ".join(words))
            for _ in range(int(r.integers(1, 4))):
                words[int(r.integers(0, 60))] = f"s{c}x{step}x{r.integers(0, 9)}"
    group = plain_groups(texts)
    assert 12 < len(set(group)) < 250
    prints = [sd.wide_fingerprint(t) for t in texts]
    order = sorted(range(len(texts)), key=lambda i: int(np.bitwise_count(prints[i][0]).sum()))
    bits = np.array([prints[i][0] for i in order])
    sets = [np.unique(sd.shingle_hashes(texts[i], 5, 42)) for i in order]
    old = sd.TILE
    try:
        for sd.TILE in (50, 1024):
            root = sd.classes_of(bits, sd.radius_for(0.8), sets=sets, similarity=0.8)
            got, want = {}, {}
            for k, i in enumerate(order):
                got.setdefault(root[k], set()).add(i)
                want.setdefault(group[i], set()).add(i)
            assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in want.values()}
    finally:
        sd.TILE = old


def test_candidates_hold_every_similar_pair(spark):
    """Against exact Jaccard similarity on all pairs: those of 0.8 and more share a block and lie within the radius."""
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    docs = list(dict.fromkeys(docs)) + ["a b c d e f g h", "a b c d e f g h i"]
    sets = [set(sd.shingle_hashes(t, 5, 42).tolist()) for t in docs]
    prints = [sd.wide_fingerprint(t) for t in docs]
    bits, least = np.array([p[0] for p in prints]), np.array([p[1] for p in prints])
    radius, found = sd.radius_for(0.8), 0
    for i in range(len(docs)):
        apart = np.bitwise_count(bits[i] ^ bits[:i]).sum(1)
        linked = (apart <= radius) & (least[i] == least[:i]).any(1)
        for j in range(i):
            both = len(sets[i] & sets[j]) if linked[j] or apart[j] < 200 else 0
            similar = both / (len(sets[i]) + len(sets[j]) - both) >= 0.8
            assert linked[j] or not similar, (i, j)
            found += similar
    assert found >= 4


def test_any_number_of_bit_ranges_gives_the_same_classes(spark):
    from folioforge.llm.components import components

    r = np.random.default_rng(2)
    fps = {int(x) for x in r.integers(-(1 << 62), 1 << 62, 80)}
    for x in list(fps):
        fps |= {x ^ sum(1 << int(k) for k in set(r.integers(0, 63, int(r.integers(1, 6))).tolist())) for _ in range(3)}
    df = spark.createDataFrame([(f,) for f in sorted(fps)], "fp long")
    out = []
    for parts in (5, 6, 7):
        classes = {}
        for g in components(sd.links(df, 4, parts=parts)).collect():
            classes.setdefault(g.root, set()).add(g.node)
        out.append({frozenset(c) for c in classes.values()})
    assert out[0] == out[1] == out[2] and len(out[0]) > 30
    assert [ranges(n, 4) for n in (10**3, 10**8, 10**10, 10**12)] == [5, 6, 7, 8]


def test_query_and_edge_rows(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(1, long), (2, long.replace("w3 ", "W3  ")), (3, long + " tail"), (4, None), (5, ""), (6, " \t\n"), (7, "two words"), (8, "Two\nwords"), (9, "other text of five words"), (None, "no id at all here"), (9, "other text of five words"), (12, "x" * 50_000)]
    spark.createDataFrame([(k, t, "a", 0) for k, t in rows], "doc_id long, text string, fp string, id int").write.parquet(f"{tmp_path}/documents.parquet")
    assert shown(op4_simhash_dedup(spark, str(tmp_path))) == plain_classes(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op4_simhash_dedup(spark, str(tmp_path)).collect() == []


def test_real_rows(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert shown(op4_simhash_dedup(spark, d)) == plain_classes(rows)


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    """Every written table is files of many tasks, so classes that a task already named are written once, and a round shows that it was the last one."""
    from folioforge.llm import components as c

    written = []
    monkeypatch.setattr(c, "saved", lambda df, name, f=c.saved: written.append(name) or f(df, name))
    for links, tables in (([(5, 1), (1, 9), (7, 2), (3, 3), (5, 1)], 1), ([(4, 1), (4, 2), (6, 2), (8, 7)], 5), ([(k, k + 1) for k in range(40)], None), ([], 1)):
        written.clear()
        got = {r.node: r.root for r in c.components(spark.createDataFrame(links, "a long, b long")).collect()}
        want = {n: n for x in links if x[0] != x[1] for n in x}
        for _ in want:
            for a, b in links:
                if a != b:
                    want[a] = want[b] = min(want[a], want[b])
        assert got == want and (tables is None or len(written) == tables), (links, written)
    two = spark.createDataFrame([(1, -1, k, bytes([k == 5] * 8)) for k in (9, 5, 3)], "task long, chunk int, node long, bits binary")
    assert sorted(map(tuple, sd._forest(two, 64).collect())) == [(5, 3), (9, 3)]
