from folioforge.operators import pipeline, providers
from folioforge.plans import catalog

SCHEMA = "doc_id long, block_id string, kind string, source string"
TERMS = "doc_id long, term string, policy string, source string, translation string"


def test_chunks_and_repairs_carry_their_first_eight_terms(spark, tmp_path):
    blocks = spark.createDataFrame([(1, "b1", "paragraph", "Large Language Models and t9 t8 t7 t6 t5 t4 t3 t2"), (2, "b1", "paragraph", "large language models")], SCHEMA)
    terms = spark.createDataFrame([(1, "large language models", "canonical_translation", "c", "大型語言模型"), (1, "absent", "preserve", "c", None)] + [(1, f"t{i}", "preserve", "c", None) for i in range(2, 10)], TERMS)
    make = lambda: providers.RuleProvider(guided=lambda text, prompt: prompt)
    got = {r.doc_id: r.translated for r in pipeline.translated_blocks(blocks, make, str(tmp_path / "a"), terms=terms).collect()}
    assert "- large language models => 大型語言模型" in got[1] and "- t8 => preserve English" in got[1] and "absent" not in got[1]
    assert got[1].count(" => ") == 8 and "- t9" not in got[1] and " => " not in got[2] and "Passage: large language models" in got[2]
    drafts = blocks.selectExpr("*", "'' AS translated")
    again = {r.doc_id: r.translated for r in pipeline.repaired_blocks(drafts, make, str(tmp_path / "b"), terms).collect()}
    assert again[1].count(" => ") == 8 and " => " not in again[2]


def test_prompts_reach_halved_requests():
    p = providers.RuleProvider(poison="bad", guided=lambda text, prompt: prompt)
    assert providers.ask(p, {"a": "x", "b": "bad", "c": "y"}, prompts={"a": "A", "b": "B", "c": "C"}) == {"a": "A", "b": "[TRANSLATION_ERROR:b]", "c": "C"}


def test_x13_runs_every_stage(spark):
    got = {r.kind: r for r in catalog.queries()["x13_block_pipeline"](spark, "/root/testdata/sf0.001").collect()}
    assert {"archival", "study", "source: extracted", "source: converted", "glossary: preserve", "glossary: canonical_translation", "paragraph"} <= got.keys()
    assert got["archival"].n == 200 and got["source: extracted"].n + got["source: converted"].n == 200 and min(got["source: extracted"].n, got["source: converted"].n) > 0
