import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioforge.llm import tokenfile
from folioforge.llm.q_tokenfile import op5_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = tokenfile.LibraryCodec(PATH, remembered=20)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'sé 中1!\n\t\r \x1c　#")), max_size=40), max_size=4))
def test_equals_the_library(texts):
    got = CODEC.encode(texts, 2)
    for t, g in zip(texts, got, strict=True):
        assert np.frombuffer(g, "<u2").tolist() == [*LIBRARY.encode(t, add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'é1².,!%\"€ \n_-)Ⅷ中")), max_size=30), max_size=4))
def test_signs_behind_words(texts):
    for t, g in zip(texts, CODEC.encode(texts), strict=True):
        assert np.frombuffer(g, "<u2").tolist() == LIBRARY.encode(t, add_special_tokens=False).ids


def test_special_string_in_a_text_is_what_the_library_makes_of_it():
    t = "one <|endoftext|> two a<|endoftext|>b c<|endoftext|> d<|endoftext|>, e"
    assert np.frombuffer(CODEC.encode([t])[0], "<u2").tolist() == LIBRARY.encode(t, add_special_tokens=False).ids


def want(rows):
    out, start = [], 0
    for key, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_and_edge_rows(spark, tmp_path):
    rows = [(5, "five five"), (1, None), (3, ""), (2, "x" * 30_000), (4, "b c\n\nd"), (None, "no key"), (7, "same"), (7, "same")]
    spark.createDataFrame([(k, t, 1.5) for k, t in rows], "doc_id long, text string, start double").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op5_token_files(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    assert got == want(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op5_token_files(spark, str(tmp_path)).collect() == []


def test_real_rows(spark):
    d = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect())
    assert sorted(tuple(r) for r in op5_token_files(spark, d).collect()) == want(rows)
