import base64
import hashlib
import re
from collections import Counter

import tiktoken

import corpus_pipeline as cp
from folioforge.llm import bpe, pii, quality

from .test_mixing import filled
from .test_simhash_dedup import plain_groups

PATH, PATTERN = bpe.vocabulary()
ORACLE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}, special_tokens={})


def key(doc_id):
    return int(hashlib.md5(("null" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)


def brute(spark, d):
    docs = [r.asDict() for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    model = quality.fit_from(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    docs = [x for x in docs if model.score([x["text"]])[0] >= 0.3]
    group = plain_groups([x["text"] for x in docs])
    find = group.__getitem__

    least = {}
    for i, x in enumerate(docs):
        least[find(i)] = min(least.get(find(i), x["doc_id"]), x["doc_id"])
    docs = [x for x in docs if x["doc_id"] in set(least.values())]
    marks = {k: f"<{k.upper()}>" for k in pii.KINDS}
    for x in docs:
        out, at = "", 0
        for a, z, k in pii.find([x["text"]])[1][0]:
            if a >= at:
                out += x["text"][at:a] + marks[k]
            at = max(at, z)
        x["text"] = out + x["text"][at:]
    size = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x["text"]))
    sizes = Counter()
    for x in docs:
        sizes[x["source"]] += size(x)
    target = filled(dict(sizes))
    result = Counter()
    for s in sizes:
        budget = round(target[s])
        epochs = budget // sizes[s]
        rest, prior = budget - epochs * sizes[s], 0
        for x in sorted((x for x in docs if x["source"] == s), key=lambda x: key(x["doc_id"])):
            times = epochs + (2 * (rest - prior) >= size(x))
            prior += size(x)
            ids = ORACLE.encode_ordinary(x["text"])
            if times:
                result[x["doc_id"], x["lang"], s, len(x["text"]), len(ids), b"".join(i.to_bytes(4, "little") for i in ids), True] += times
    return result


def test_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    got = Counter((r.doc_id, r.lang, r.source, r.n_chars, r.n_tokens, bytes(r.ids), r.round_trip) for r in cp.run(spark, d).collect())
    assert got == brute(spark, d) and len(got) > 50


def test_stages_keep_columns_and_bear_edge_rows(spark, tmp_path):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(20)), "en", f"s{i % 3}", 5, "more") for i in range(20)]
    rows += [(3, rows[3][1], "en", "s0", 5, "more"), (None, None, None, None, None, None), (99, "", "en", None, 0, ""), (100, "x" * 50_000, "en", "s1", 1, "")]
    own = ["__id", "__none", "__tie", "__nth", "__part", "__source", "__times", "__edge", "__epochs", "__copy", "node", "Least"]
    rows = [(*r, *[f"{c} {k}" for c in own]) for k, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __extra string, " + ", ".join(f"`{c}` string" for c in own))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    counts = []
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
        assert all(r[c].startswith(f"{c} ") for r in docs.collect() for c in own)
        counts.append(docs.count())
    assert counts[0] == 24 and counts[1] == 22  # the repeated row goes, and one of the two without words
    assert cp.STAGES[-1][1](spark, docs, str(tmp_path)).where("NOT round_trip").count() == 0


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
