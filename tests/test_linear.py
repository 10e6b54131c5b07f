"""What must not grow with the square of a text, or with the size of a batch."""

import random
import time

import pyarrow as pa
import pytest

from folioforge.functions import assembly, repair, translation, validation
from folioforge.functions.dialect import DUCK, SPARK
from folioforge.operators import english_repair, providers, segment


def test_masks_are_restored_in_one_pass(spark):
    n = 60_000
    rows = [(" ".join(f"word §PROTECTED_{k}§" for k in range(n)), [f"u{k}@x.org" for k in range(n)])]
    df = spark.createDataFrame(rows, "t string, s array<string>").selectExpr(f"{translation.restored(SPARK, 't', 's')} AS r")
    df.limit(0).collect()
    began = time.time()
    assert df.head().r == " ".join(f"word u{k}@x.org" for k in range(n))
    assert time.time() - began < 40  # one after another: some 90 GB of text to be searched


def test_masks_that_touch_or_hide_in_spans(spark):
    rng = random.Random(3)
    spans = ["`a`", "$b$", "http://x§", "`§PROTECTED_0§`", "c@d.org", "`§`"]
    bits = ["§PROTECTED_0§", "§PROTECTED_1§", "§PROTECTED_01§", "PROTECTED_1§", "§PROTECTED_", "1", "§", "x ", "§PROTECTED_7§", "§PROTECTED_99999999999§"]
    rows = [("".join(rng.choices(bits, k=rng.randint(0, 7))), rng.choices(spans, k=rng.randint(0, 4))) for _ in range(800)]

    def want(t, ss):
        for i, s in enumerate(ss):
            t = t.replace(f"§PROTECTED_{i}§", s)
        return t

    got = spark.createDataFrame(rows, "t string, s array<string>").selectExpr("t", "s", f"{translation.restored(SPARK, 't', 's')} AS r").collect()
    assert [(r.t, r.s) for r in got if r.r != want(r.t, r.s)] == []


def test_a_batch_is_asked_in_portions():
    batch = pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(5000)]), pa.array(["x" * (5000 if k % 100 else 300_000) for k in range(5000)])], ["id", "text"])
    parts = list(providers.portions(batch))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert max(p.num_rows for p in parts) <= 1000 and all(p.nbytes < 2_000_000 for p in parts)
    assert [p.num_rows for p in providers.portions(batch.slice(0, 0))] == []


def test_prose_is_joined_block_by_block():
    text = "\n\n".join(["A start of prose that goes on", *["and a part of it with some more words " * 4] * 6000])
    began = time.time()
    out = english_repair.repaired(text)
    assert out.count("and a part") == 24_000 and "\n\n" not in out
    assert time.time() - began < 20  # with the whole text read anew at each block: minutes


def test_what_follows_a_line_is_no_frame_up_to_the_end():
    assert "UNBOUNDED FOLLOWING) AS following" not in segment.kept_lines(SPARK) and "1 FOLLOWING" not in segment.kept_lines(SPARK)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(5)
    bits = ["word", "Words", "-", "- ", "\n", "\r\n", "\r", "  ", " ", "\t", "a", "ab", "XY", "12", "3.5%", "(7)", ".", "?", ":", "User {v1}", "{ v 2 }", "{v", "文", "中文字", "a.b@c.org", "@", "`code`", "$x$", "https://q.r/s", "Figure 1", "Table 2: ", "# ", "University", "Equal contribution", "2019", "é", "😀", "𝐱", "ab-\ncd", "e-\n f", " ", "​", "\f", "*", "=", "^", "|", "[1]", "Abstract", "References", "1 Intro", "A B"]
    return [("".join(rng.choices(bits, k=rng.randint(0, 14))), "".join(rng.choices(bits, k=rng.randint(0, 14)))) for _ in range(1500)]


FORMS = {
    "words": lambda d: d.join(validation.lowercase_words(d, "a"), ","),
    "joined": lambda d: validation.joined_words(d, "a"),
    "reason": lambda d: validation.reason(d, "a", "b"),
    "archival": lambda d: assembly.archival(d, "a"),
    "masked": lambda d: translation.masked(d, "a"),
    "spans": lambda d: d.join(translation.protected_spans(d, "a"), "|"),
    "letters": lambda d: translation.latin_letters(d, "a"),
    "truncated": lambda d: translation.is_truncated(d, "a", "b", "'paragraph'"),
    "suspicious": lambda d: translation.is_suspicious(d, "a", "b", "'paragraph'"),
    "broken": lambda d: repair.is_suspicious(d, "a"),
    "kind": lambda d: repair.kind(d, "a"),
    "blocks": lambda d: d.join(repair.blocks(d, "a"), "|"),
}


@pytest.mark.parametrize("name", sorted(FORMS))
def test_forms_for_spark_say_what_the_sql_says(spark, odd_texts, name):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.register("t", pd.DataFrame([(k, a, b) for k, (a, b) in enumerate(odd_texts)], columns=["k", "a", "b"]))
    want = dict(con.execute(f"SELECT k, {FORMS[name](DUCK)} FROM t").fetchall())
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(odd_texts)], "k int, a string, b string")
    got = {r.k: r.v for r in rows.selectExpr("k", f"{FORMS[name](SPARK)} AS v").collect()}
    assert [(odd_texts[k], got[k], want[k]) for k in want if got[k] != want[k]][:3] == []
