import zlib

import numpy as np

from folioforge.llm import quality
from folioforge.llm.q_quality import op7_quality_score


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    for v in np.unique(score):
        at = score == v
        rank[at] = (score < v).sum() + (at.sum() + 1) / 2
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [r for r in op7_quality_score(spark, d).collect()]
    assert len(got) == 10_000 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in label]
    s, y = np.array([r.score for r in held]), np.array([label[r.doc_id] for r in held])
    print("AUC", auc(s, y), "accuracy", ((s >= 0.3) == y).mean(), "rejected good", (s[y == 1] < 0.3).sum(), "kept bad", (s[y == 0] >= 0.3).sum(), len(y))
    assert auc(s, y) > 0.97
    assert ((s >= 0.3) == y).mean() > 0.95


def test_edge_rows(spark, tmp_path):
    rows = [(i, ("good plain words here " * (i % 7 + 1)) if i % 3 else "### $$$ %%% " * 9, "en") for i in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (None, "no id", "x"), (102, "w" * 60_000, "x"), (3, "again", "x"), (3, "again", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, score string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 3 > 0)) for i in range(60)] + [(5, 1), (7, None), (None, 0), (999, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = op7_quality_score(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, op7_quality_score(spark, str(tmp_path)).collect()))
    good = [r.score for r in got if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 3 and r.doc_id != 3]
    bad = [r.score for r in got if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 3 == 0 and r.doc_id != 3]
    assert min(good) > max(bad)


def test_one_label_no_label_no_rows(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/a/labels.parquet")
    assert len(op7_quality_score(spark, f"{tmp_path}/a").collect()) == 2
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/b/labels.parquet")
    assert op7_quality_score(spark, f"{tmp_path}/b").collect() == []


def test_keep_good_keeps_columns(spark):
    model = quality.fit(["good words"] * 8 + ["%%% ###"] * 8, [1] * 8 + [0] * 8)
    df = spark.createDataFrame([(1, "good words", 2.5), (2, "%%% ###", None)], "doc_id long, text string, extra double")
    assert [tuple(r) for r in quality.keep_good(df, model).collect()] == [(1, "good words", 2.5)]


def plain_score(model, text):
    """A document's score word by word, without numpy's tables."""
    import re

    words = re.findall(r"[^\W_]+|[^\w\s]+|_+", text or "")
    shape = lambda w: 6 if len(w) > 24 else 3 if w.isdigit() else 5 if not w[0].isalnum() else 0 if w.islower() else 2 if len(w) > 1 and w.isupper() else 1 if w.istitle() else 4
    numbers = [model.vocabulary.get(w, shape(w)) for w in words] or [10]
    extra = [7] * sum(a == b for a, b in zip(words, words[1:], strict=False)) + [9] * (text or "").count("\n") if words else []
    pairs = list(zip(words, words[1:], strict=False))
    extra += [8] * (len(pairs) - len(set(pairs)))
    x = sum(model.vectors[k].astype(float) for k in numbers + extra) / len(numbers)
    x = (np.append(x, np.log1p(len(numbers))) - model.mean) / model.scale
    w1, b1, w2, b2 = model.layers
    return 1 / (1 + np.exp(-float((np.maximum(x @ w1 + b1, 0) @ w2 + b2[0]) / model.temperature)))


def test_scores_equal_a_plain_version(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = quality.fit_from(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = op7_quality_score(spark, d).collect()
    assert len(got) == len(texts) and len({r.score for r in got}) > 100
    for r in got:
        want = plain_score(model, texts[r.doc_id])
        assert abs(r.score - want) < 1e-3, r
        if 1e-6 < want < 1 - 1e-6:
            logit = lambda p: np.log(p / (1 - p))
            assert abs(logit(r.score) - logit(want)) < 0.01, r
        assert r.predicted == int(r.score >= 0.3)


def test_the_sample_is_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i} " * (1000 if i == 3 else 1)) for i in range(40)] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda texts, y: seen.append(texts))
    quality.fit_from(docs, labels)
    quality.fit_from(docs, labels, most=10)
    quality.fit_from(docs, labels, most_bytes=200)
    training = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    assert len(seen[0]) == len(training) and len(seen[1]) == 10 and sum(len(t) for t in seen[2]) <= 200 and len(seen[2]) > 15


def test_a_word_whose_signs_cancel_out(monkeypatch):
    monkeypatch.setattr(quality, "index_vector", lambda w, dim=64, ones=6: np.zeros(dim, np.float32) if w == "void" else np.ones(dim, np.float32))
    model = quality.fit(["good void words"] * 12 + ["%%% void"] * 12, [1] * 12 + [0] * 12)
    assert np.isfinite(model.vectors).all() and np.isfinite(model.score(["void", "good words", None])).all()
