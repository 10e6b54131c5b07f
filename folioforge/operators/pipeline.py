"""The block pipeline over a corpus, and runs of pages: stages as DataFrame -> DataFrame, tables where a provider answered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import assembly, lines, repair, translation
from ..functions.dialect import SPARK as D
from . import english_repair, glossary, planning, providers, segment


def _table(df: DataFrame, path: str, again: bool = False) -> DataFrame:
    """again: a run that starts anew writes it over."""
    df.write.mode("overwrite" if again else "errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def best_source(candidates: DataFrame) -> DataFrame:
    """candidates (doc_id, name, priority, raw) -> (doc_id, name, score, text): the best-scored source of each paper, its content cleaned; ties go to the lower priority."""
    scored = candidates.selectExpr("*", f"{segment.source_rows(D, 'raw')} AS rs").selectExpr("*", f"{segment.score(D, 'raw', 'rs')} AS score").drop("rs")
    # rows without a score have no order and so are not taken; as a filter the score would be made twice
    order = F.when(F.col("score").isNotNull(), F.struct("score", -F.col("priority")))
    best = scored.groupBy("doc_id").agg(F.max_by(F.struct("name", "score", "raw"), order).alias("b")).where("b IS NOT NULL").select("doc_id", "b.*")
    return best.selectExpr("doc_id", "name", "score", f"{lines.unwrap(D, 'raw')} AS text")


def prompted(texts: DataFrame, terms: DataFrame | None, text_col: str) -> DataFrame:
    """texts (doc_id, kind, section, chunk, total, ...) -> also prompt, with the first eight terms of the paper's glossary that the text holds."""
    if terms is None:
        rows = texts.withColumn("held", F.expr("CAST(array() AS ARRAY<STRUCT<low: STRING, policy: STRING, term: STRING, translation: STRING>>)"))
    else:
        entries = terms.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.lower("term").alias("low"), "policy", "term", "translation"))).alias("entries"))
        rows = texts.join(entries, "doc_id", "left").withColumn("held", F.expr(glossary.held_terms(text_col, "coalesce(entries, array())"))).drop("entries")
    guidance = f"array_join(transform(held, e -> {translation.guidance_line(D, 'e.term', 'e.policy', 'e.translation')}), {D.text(chr(10))})"
    return rows.withColumn("guidance", F.expr(f"nullif({guidance}, '')")).withColumn("prompt", F.expr(translation.prompt(D, text_col, "kind", "section", "chunk", "total", "guidance"))).drop("held", "guidance")


def translated_blocks(blocks: DataFrame, provider: Callable[[], providers.Provider], path: str, stored: DataFrame | None = None, terms: DataFrame | None = None) -> DataFrame:
    """blocks (doc_id, block_id, kind, source, ...) -> also translated. Protected kinds keep their source. stored (doc_id, block_id, translated): drafts that are complete are kept. terms: the glossary, whose terms go with each chunk.

    Spans are masked before and restored after; long texts go in chunks; requests and answers are tables under `path`, answers grow batch by batch and a run that starts again with the same path asks only for what is not there."""
    if stored is not None:
        blocks = blocks.join(stored.withColumnRenamed("translated", "draft"), ["doc_id", "block_id"], "left")
    else:
        blocks = blocks.withColumn("draft", F.lit(None).cast("string"))
    whole = f"draft IS NOT NULL AND {D.strip('draft')} <> '' AND NOT {translation.is_truncated(D, 'source', 'draft', 'kind')}"
    marked = blocks.selectExpr("*", f"CASE WHEN NOT {D.in_('kind', translation.TRANSLATABLE)} THEN source WHEN {whole} THEN draft END AS ready")
    # what is ready has no chunks; as a filter the test would be pushed below and made again for each of its uses
    masked = marked.selectExpr("doc_id", "block_id", "kind", "section" if "section" in blocks.columns else "CAST(NULL AS STRING) AS section", "ready", f"{translation.masked(D, 'source')} AS masked")
    cut = masked.selectExpr("doc_id", "block_id", "kind", "section", f"CASE WHEN ready IS NULL THEN {planning.packed(D, 'masked')} ELSE array() END AS c")
    chunks = cut.selectExpr("doc_id", "block_id", "kind", "section", "size(c) AS total", "posexplode(c) AS (chunk, text)").withColumn("id", F.concat_ws("__", "doc_id", "block_id", "chunk"))
    chunks = _table(prompted(chunks, terms, "text").select("id", "doc_id", "block_id", "chunk", "text", "prompt"), f"{path}/requests", again=True)
    answers = providers.answered(chunks, provider, "id", "text", f"{path}/answers", prompt_col="prompt")
    parts = chunks.select("id", "doc_id", "block_id", "chunk").join(answers, "id")
    joined = parts.groupBy("doc_id", "block_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "answer"))).alias("p")).selectExpr("doc_id", "block_id", "transform(p, e -> e.answer) AS p")
    out = marked.join(joined, ["doc_id", "block_id"], "left").withColumn("spans", F.expr(translation.protected_spans(D, "source"))).withColumn("said", F.expr(translation.response_chunk(D, "kind", "coalesce(p, array())")))
    return out.withColumn("translated", F.expr(f"coalesce(ready, {translation.restored(D, 'said', 'spans')})")).drop("draft", "ready", "p", "spans", "said")


def repaired_blocks(blocks: DataFrame, provider: Callable[[], providers.Provider], path: str, terms: DataFrame | None = None) -> DataFrame:
    """Only suspicious drafts are asked for again, with the terms of the glossary; an empty or failed answer keeps the draft. `still` tells whether the result is suspicious itself."""
    marked = blocks.selectExpr("*", f"{translation.is_suspicious(D, 'source', 'translated', 'kind')} AS suspicious").withColumn("id", F.concat_ws("__", "doc_id", "block_id"))
    asked = marked.where("suspicious").selectExpr("doc_id", "id", "kind", "section" if "section" in blocks.columns else "CAST(NULL AS STRING) AS section", "0 AS chunk", "1 AS total", "source")
    asked = _table(prompted(asked, terms, "source").select("id", "source", "prompt"), f"{path}/requests", again=True)
    answers = providers.answered(asked, provider, "id", "source", f"{path}/answers", prompt_col="prompt").where("answer <> '' AND NOT startswith(answer, '[TRANSLATION_ERROR:')")
    out = marked.join(answers.withColumnRenamed("answer", "repaired"), "id", "left").withColumn("translated", F.coalesce("repaired", "translated"))
    return out.selectExpr("*", f"{translation.is_suspicious(D, 'source', 'translated', 'kind')} AS still").drop("id")


def repaired_english(texts: DataFrame, provider: Callable[[], providers.Provider], path: str, mode: str = "hybrid") -> DataFrame:
    """texts (doc_id, text) -> (doc_id, place, block, asked): English blocks in order.

    hybrid: interrupted prose is put together by rule, then blocks that look broken go to the provider; full: all blocks
    but headings go, without the rule; heuristic: the rule alone. An empty or failed answer keeps the block. Answers are
    stored under `path` by content and mode, so a run that starts again asks only for what is not there."""
    if mode not in ("heuristic", "hybrid", "full"):
        raise ValueError(mode)
    rows = texts if mode == "full" else texts.select("doc_id", english_repair.repair(F.col("text")).alias("text"))
    rows = rows.selectExpr("doc_id", f"posexplode({repair.blocks(D, 'text')}) AS (place, block)")
    test = {"heuristic": "false", "hybrid": repair.is_suspicious(D, "block"), "full": f"NOT {repair.is_heading(D, 'block')}"}[mode]
    rows = rows.selectExpr("doc_id", "place", "block", f"{test} AS asked", f"{repair.kind(D, 'block')} AS kind")
    if mode == "heuristic":
        return rows.drop("kind")
    rows = _table(rows.withColumn("id", F.concat_ws("__", "doc_id", "place")), f"{path}/{mode}-blocks", again=True)
    prompt = f"concat_ws({D.text(chr(10))}, 'Mend what extraction broke, change nothing else.', concat('Kind: ', kind), concat('Passage: ', block))"
    answers = providers.answered(rows.where("asked").selectExpr("id", "block", f"{prompt} AS prompt"), provider, "id", "block", f"{path}/{mode}-answers", prompt_col="prompt")
    answers = answers.where("answer <> '' AND NOT startswith(answer, '[TRANSLATION_ERROR:')")
    return rows.join(answers, "id", "left").select("doc_id", "place", F.coalesce("answer", "block").alias("block"), "asked")


def documents(blocks: DataFrame, study: bool = False) -> DataFrame:
    """blocks with translated and repaired -> (doc_id, document) in Markdown."""
    if study:
        rows = blocks.selectExpr("doc_id", "block", "kind", "section", f"{assembly.study(D, 'source')} AS s", f"{assembly.preferred_study(D, 'repaired', 'translated')} AS p")
        rows = rows.selectExpr("doc_id", "block", "kind", "section", f"{assembly.study_choice(D, 's', 'p', 'kind')} AS t").selectExpr("doc_id", "block", f"{assembly.study_rendered(D, 't', 'kind', 'section')} AS chunk")
    else:
        rows = blocks.selectExpr("doc_id", "block", "kind", "section", f"{assembly.archival(D, 'source')} AS s", "coalesce(repaired, translated, '') AS draft").selectExpr("*", f"{assembly.archival(D, 'draft')} AS p")
        rows = rows.selectExpr("doc_id", "block", "kind", "section", f"{assembly.archival_choice(D, 's', 'p', 'kind')} AS t").selectExpr("doc_id", "block", f"{assembly.rendered(D, 't', 'kind', 'section')} AS chunk")
    # told inside the aggregate: as a filter below it the chunk would be made twice
    rows = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.trim("chunk") != "", F.struct("block", "chunk")))).alias("c")).where("size(c) > 0")
    return rows.selectExpr("doc_id", "concat(array_join(transform(c, e -> e.chunk), '\\n\\n'), '\\n') AS document")


def run_papers(candidates: DataFrame, provider: Callable[[], providers.Provider], folder: str, repaired_input: bool = False) -> dict[str, DataFrame]:
    """Sources of papers to archival and study documents; folder takes the tables. repaired_input: segment the repaired English text instead of the cleaned one."""
    spark = candidates.sparkSession
    best = _table(best_source(candidates), f"{folder}/best")
    cleaned = _table(segment.clean_paragraphs(spark, lines=segment.lines_of(best.select("doc_id", "text"))).select("doc_id", "text"), f"{folder}/cleaned")
    english = _table(cleaned.withColumn("text", english_repair.repair(F.col("text"))), f"{folder}/english")
    terms = _table(glossary.build(spark, lines=segment.lines_of(english)), f"{folder}/glossary")
    blocks = _table(segment.segment(spark, prose=segment.prose_of(segment.lines_of(english if repaired_input else cleaned))), f"{folder}/blocks")
    drafted = translated_blocks(blocks, provider, f"{folder}/answers", terms=terms)
    final = _table(repaired_blocks(drafted, provider, f"{folder}/repairs", terms), f"{folder}/final")
    return {"best": best, "cleaned": cleaned, "english": english, "glossary": terms, "blocks": blocks, "final": final, "archival": documents(final), "study": documents(final, study=True)}
