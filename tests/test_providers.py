"""Clients without a network, the store of answers, the modes of the English repair."""

import pytest

from folioforge.functions.dialect import SPARK
from folioforge.operators import crops, english_repair, pipeline, providers


@pytest.mark.parametrize(
    ("made", "address", "reply", "asked"),
    [
        (providers.client("http://h/v1/chat/completions", "m", "k", "openai"), "http://h/v1/chat/completions", {"choices": [{"message": {"content": "<BLOCK a>x</BLOCK a>"}}]}, "messages"),
        (providers.client("http://h/v1/completions", "m", "k", "openai"), "http://h/v1/completions", {"choices": [{"text": "<BLOCK a>x</BLOCK a>"}]}, "prompt"),
        (providers.client("http://h/api/generate", "m"), "http://h/api/generate", {"response": "<BLOCK a>x</BLOCK a>"}, "prompt"),
        (providers.client("http://h/models", "gemini-x", "k"), "http://h/models/gemini-x:generateContent", {"candidates": [{"content": {"parts": [{"text": "<BLOCK a>x</BL"}, {"text": "OCK a>"}]}}]}, "contents"),
    ],
)
def test_clients_ask_and_read(made, address, reply, asked, monkeypatch):
    seen = []
    monkeypatch.setattr(made, "post", lambda url, body, head: seen.append((url, body, head)) or reply)
    assert made.answer({"a": "text"}, {"a": "Guidance\nPassage: text"}) == {"a": "x"}
    url, body, _ = seen[0]
    assert url == address and asked in body and "Guidance" in str(body)
    monkeypatch.setattr(made, "post", lambda *a: {"choices": []})
    with pytest.raises(providers.ProviderError):
        made.answer({"a": "text"})


def test_no_endpoint_is_an_error():
    with pytest.raises(providers.ProviderError):
        providers.client("http://127.0.0.1:9/v1/completions", "m", made=None).answer({"a": "x"})


def test_the_choice_of_client_is_one_rule(spark):
    rows = [(n, m, u) for n in ("auto", "gemini", "ollama", "openai") for m in ("x", "gemini-2") for u in ("http://h", "http://h/api/generate")]
    got = spark.createDataFrame(rows, "n string, m string, u string").selectExpr("n", "m", "u", f"{providers.backend_of(SPARK, 'n', 'm', 'u')} AS b").collect()
    assert all(r.b == providers.backend(r.n, r.m, r.u) for r in got)


def test_a_run_that_was_lost_asks_only_for_the_rest(spark, tmp_path):
    store, log = str(tmp_path / "store"), tmp_path / "asked"

    def make(fail):
        class Logged:
            def answer(self, texts, prompts=None):
                if fail and any(t in fail for t in texts.values()):
                    raise SystemExit("the task dies")
                with log.open("a") as f:
                    f.writelines(f"{t}\n" for t in texts.values())
                return {k: t.upper() for k, t in texts.items()}

        return Logged

    rows = spark.createDataFrame([(i, f"text {i % 30}") for i in range(60)], "id long, text string")
    with pytest.raises(Exception):  # noqa: B017
        providers.answered(rows, make({"text 7"}), "id", "text", store, batches=6)
    first = len(spark.read.parquet(store).collect())
    got = providers.answered(rows, make(set()), "id", "text", store, batches=6).collect()
    assert {(r.id, r.answer) for r in got} == {(str(i), f"TEXT {i % 30}") for i in range(60)} and len(got) == 60
    stored = [r.key for r in spark.read.parquet(store).collect()]
    assert len(stored) == len(set(stored)) == 30 and first < 30
    log.unlink()
    providers.answered(rows, make(set()), "id", "text", store, batches=6).collect()
    assert not log.exists()


def test_modes_of_the_english_repair(spark, tmp_path):
    text = "# Title\n\nprose that is cut\n\n*Equal contribution\n\ngoes on here.\n\nA University of it"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    make = lambda: providers.RuleProvider(lambda t: "M " + t, poison="University")
    show = lambda mode: [(r.block, r.asked) for r in pipeline.repaired_english(df, make, str(tmp_path), mode).orderBy("doc_id", "place").collect()]
    joined = "prose that is cut goes on here."
    assert show("heuristic") == [("# Title", False), (joined, False), ("*Equal contribution", False), ("A University of it", False)]
    assert show("hybrid") == [("# Title", False), (joined, False), ("M *Equal contribution", True), ("A University of it", True)]
    assert show("full") == [("# Title", False), ("M prose that is cut", True), ("M *Equal contribution", True), ("M goes on here.", True), ("A University of it", True)]
    assert show("hybrid") == show("hybrid")
    with pytest.raises(ValueError):
        pipeline.repaired_english(df, make, str(tmp_path), "other")


def test_front_matter():
    one = english_repair.title_paragraph("Ann Author, Bo Writer University of Tests ann@x.org")
    assert one == {"authors": ["Ann Author, Bo Writer"], "affiliations": ["University of Tests"], "emails": ["ann@x.org"]}
    two = english_repair.title_paragraph("ignored", "Ann\n1 CMU, City\n2. Lab\nmore\nann@x.org, bo@x.org")
    assert two == {"authors": ["Ann"], "affiliations": ["1 CMU, City", "2. Lab", "more"], "emails": ["ann@x.org", "bo@x.org"]}
    assert english_repair.title_paragraph("A B 1 CMU 2 MPI")["affiliations"] == ["1 CMU", "2 MPI"]
    assert english_repair.title_paragraph("A B SMU MPI")["affiliations"] == ["SMU", "MPI"]
    assert english_repair.front_matter("T", [("A B SMU a@b.org", ""), ("C D SMU a@b.org", "")]) == ["# T", "Authors: A B C D", "Affiliations:\n- SMU", "Emails: a@b.org"]


def test_crops_are_files_and_failures_stay_alone(spark):
    class Picky(crops.BlankRenderer):
        def crop(self, content, page, box, dpi):
            if page == 2:
                raise ValueError
            return super().crop(content, page, box, dpi)

    rows = spark.createDataFrame([(1, b"x", 1, 0, 0, 36, 72), (2, b"x", 2, 0, 0, 5, 5), (3, None, 1, 5, 5, 5, 5)], "id long, content binary, page long, x0 long, y0 long, x1 long, y1 long")
    got = {r.id: r.png for r in crops.render_crops(rows, Picky).collect()}
    assert got[2] is None and bytes(got[1])[:8] == b"\x89PNG\r\n\x1a\n" and bytes(got[1])[16:24] == (72).to_bytes(4, "big") + (144).to_bytes(4, "big") and got[3] is not None
