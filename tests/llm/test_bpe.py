import base64
import hashlib
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import bpe
from folioforge.llm.q_bpe import op1_byte_bpe

PATH, PATTERN = bpe.vocabulary()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
ORACLE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.codec(PATH, PATTERN)


def ids(text):
    import numpy as np

    return np.frombuffer(CODEC.encode(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sé 中1!\n\t\r \x1c　#")), max_size=40))
def test_equals_the_library_on_white_space(text):
    assert ids(text) == ORACLE.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_round_trip_and_library(text):
    got = CODEC.encode(text)
    assert CODEC.decode(got) == text.encode()
    assert ids(text) == ORACLE.encode_ordinary(text)


def test_very_long_pre_tokens():
    r = random.Random(1)
    for text in ("a" * 5000, "".join(r.choice("abcé") for _ in range(20_000)), "ab" * 3000 + "c", "=" * 777):
        assert ids(text) == ORACLE.encode_ordinary(text)


def slowly(piece, ranks):
    """Join the pair of the lowest rank, the leftmost of equals, until no pair can be joined."""
    parts = [bytes([x]) for x in piece]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[x] for x in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_any_rank_table_and_shared_queues():
    """Ranks in any order: a merge may bring up a lower rank than its own, which then comes first."""
    r = random.Random(2)
    for _ in range(60):
        words = {bytes(r.choice(b"abc") for _ in range(r.randint(2, 5))) for _ in range(60)}
        tokens = [*(bytes([i]) for i in range(256)), *words]
        order = list(range(len(tokens)))
        r.shuffle(order)
        ranks = dict(zip(tokens, order))
        pieces = [bytes(r.choice(b"abcd") for _ in range(r.choice([1, 2, 5, 40]))) for _ in range(30)]
        got = bpe.merge(pieces, bpe.Ranks(ranks))
        assert [memoryview(g).cast("I").tolist() for g in got] == [slowly(p, ranks) for p in pieces]


def test_long_pre_token_whose_merges_bring_up_lower_ranks():
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"ab": 3, b"abc": 1}
    assert len(bpe.merge([b"abc" * 60_000], bpe.Ranks(ranks))[0]) == 4 * 60_000


def test_ranks_too_large_are_refused():
    with pytest.raises(ValueError):
        bpe.Ranks({bytes([i]): i for i in range(256)} | {b"ab": 1 << 20})


def test_small_caches_are_emptied_not_wrong():
    c = bpe.Codec(PATH, PATTERN, pieces=3, runs=2)
    text = "one two three four\nfive  six, seven\n\n eight "
    assert c.encode(text) == CODEC.encode(text)


def test_query_and_edge_rows(spark, tmp_path):
    rows = [(1, "Hello world", "x"), (2, None, "y"), (3, "", "z"), (1, "Hello world", "x"), (None, "z" * 70_000, "q")]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op1_byte_bpe(spark, str(tmp_path)).collect()
    assert len(got) == 5
    for r, text in ((r, {1: "Hello world", None: "z" * 70_000}.get(r.doc_id, "")) for r in got):
        want = b"".join(x.to_bytes(4, "little") for x in ORACLE.encode_ordinary(text))
        assert (r.n_tokens, r.ids_sha256) == (len(want) // 4, hashlib.sha256(want).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op1_byte_bpe(spark, str(tmp_path)).collect() == []


def test_decode_alone(spark):
    df = spark.createDataFrame([(1, bytearray(CODEC.encode("né 1"))), (2, None)], "id long, ids binary")
    assert {r.id: bytes(r.decoded) for r in bpe.bpe_decode(df, PATH, PATTERN).collect()} == {1: "né 1".encode(), 2: b""}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_real_rows(spark, sf):
    got = {r.doc_id: r for r in op1_byte_bpe(spark, f"/root/testdata/{sf}").collect()}
    for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect():
        want = b"".join(x.to_bytes(4, "little") for x in ORACLE.encode_ordinary(r.text))
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(want).hexdigest()
