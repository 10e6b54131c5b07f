"""Calls to an outside model, kept behind one interface.

A provider answers a request of several keyed texts. call() runs it for rows
of a DataFrame in Arrow batches: requests of bounded size, retries with linear
back-off, halving of a request that keeps failing until single texts remain,
and an error mark where a single text fails. A text that fails never takes its
neighbours along and never fails the job. answered() keeps what it is told in a
store, slice by slice, so that nothing is asked for twice.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import Dialect
from ..sources.portions import portions
from ..sources.shipping import ship

# Block marks of requests and answers, fences around answers.
BLOCK = re.compile(r"<BLOCK\s+([^>]+)>\s*(.*?)\s*</BLOCK\s+\1>", re.S)
FENCE = re.compile(r"^```(?:json)?\s*|\s*```$")
ERROR = "[TRANSLATION_ERROR:{}]"
TASK = "Translate each block, keep its marks. Where a block has a Passage, translate that alone; the lines before it are guidance.\n"


class Provider(Protocol):
    def answer(self, texts: dict[str, str], prompts: dict[str, str] | None = None) -> dict[str, str]:
        """An answer for every key, or an exception. prompts: per key what to send for the text, with its guidance; only given where call() has a prompt column."""


class ProviderError(RuntimeError):
    pass


def parse_blocks(text: str) -> dict[str, str]:
    """Answers in block marks, keyed; an error if there are none."""
    found = BLOCK.findall(FENCE.sub("", text.strip()).strip())
    if not found:
        raise ProviderError(f"no block in the answer: {text[:400]}")
    return {k.strip(): v.strip() for k, v in found}


def missing(asked: dict[str, str], got: dict[str, str]) -> list[str]:
    return [k for k in asked if k not in got]


class RuleProvider:
    """Answers by a rule, or by `guided`, a rule of text and prompt; fails for texts that hold `poison`, and for the first `flaky` calls. For tests and dry runs."""

    def __init__(self, rule: Callable[[str], str] = lambda t: "譯：" + t, poison: str | None = None, flaky: int = 0, guided: Callable[[str, str], str] | None = None):
        self.rule, self.poison, self.flaky, self.guided = rule, poison, flaky, guided
        self.calls = 0

    def answer(self, texts, prompts=None):
        self.calls += 1
        if self.calls <= self.flaky:
            raise ProviderError("not yet")
        if self.poison and any(self.poison in t for t in texts.values()):
            raise ProviderError("refused")
        if self.guided:
            return {k: self.guided(t, (prompts or {}).get(k, "")) for k, t in texts.items()}
        return {k: self.rule(t) for k, t in texts.items()}


def _marked(texts: dict[str, str], prompts: dict[str, str] | None) -> str:
    return TASK + "\n\n".join(f"<BLOCK {k}>\n{t}\n</BLOCK {k}>" for k, t in (prompts or texts).items())


class _Http:
    """What the endpoints share: JSON by POST, temperature 0, answers in block marks. Errors become ProviderError."""

    def __init__(self, url: str, model: str, key: str = "", timeout: int = 180, most: int = 384):
        self.url, self.model, self.key, self.timeout, self.most = url, model, key, timeout, most

    def answer(self, texts, prompts=None):
        reply = self.post(self.address(), self.body(_marked(texts, prompts)), self.head())
        try:
            return parse_blocks(self.text(reply))
        except (KeyError, IndexError, TypeError) as e:
            raise ProviderError(f"no text in the answer: {str(reply)[:400]}") from e

    def post(self, url: str, body: dict, head: dict[str, str]) -> dict:
        import json
        from urllib import error, request

        try:
            with request.urlopen(request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"} | head), timeout=self.timeout) as r:
                return json.load(r)
        except (error.URLError, TimeoutError, ValueError) as e:
            raise ProviderError(str(e)[:400]) from e

    def address(self) -> str:
        return self.url

    def head(self) -> dict[str, str]:
        return {"Authorization": f"Bearer {self.key}"} if self.key else {}


class HttpProvider(_Http):
    """An OpenAI-compatible endpoint: chat, or plain completion where the address ends in /completions without /chat."""

    @property
    def chat(self) -> bool:
        return not self.url.rstrip("/").endswith("/completions") or self.url.rstrip("/").endswith("/chat/completions")

    def body(self, prompt):
        asked = {"messages": [{"role": "user", "content": prompt}]} if self.chat else {"prompt": prompt}
        return {"model": self.model, "temperature": 0, "max_tokens": self.most, "stream": False, **asked}

    def text(self, reply):
        first = reply["choices"][0]
        return first["message"]["content"] if self.chat else first["text"]


class OllamaProvider(_Http):
    """An Ollama endpoint (/api/generate)."""

    def body(self, prompt):
        return {"model": self.model, "prompt": prompt, "stream": False, "options": {"temperature": 0}}

    def text(self, reply):
        return reply["response"]


class GeminiProvider(_Http):
    """A Gemini endpoint: url is the address of the models, up to and without the model's name."""

    def __init__(self, url: str, model: str, key: str = "", timeout: int = 180, most: int = 4096):
        super().__init__(url, model, key, timeout, most)

    def address(self):
        return f"{self.url.rstrip('/')}/{self.model}:generateContent"

    def head(self):
        return {"x-goog-api-key": self.key}

    def body(self, prompt):
        return {"contents": [{"role": "user", "parts": [{"text": prompt}]}], "generationConfig": {"temperature": 0, "maxOutputTokens": self.most}}

    def text(self, reply):
        return "".join(p.get("text", "") for p in reply["candidates"][0]["content"]["parts"])


CLIENTS = {"openai": HttpProvider, "ollama": OllamaProvider, "gemini": GeminiProvider}


def backend(name: str = "auto", model: str = "", url: str = "") -> str:
    """Which kind of endpoint serves: by name, else by the model's or the address's form."""
    if name == "gemini" or model.startswith("gemini-"):
        return "gemini"
    return "ollama" if name == "ollama" or url.endswith("/api/generate") else "openai"


def backend_of(d: Dialect, name: str, model: str, url: str) -> str:
    """backend() as an expression, for tables of configurations."""
    return f"CASE WHEN {name} = 'gemini' OR {d.starts(model, 'gemini-')} THEN 'gemini' WHEN {name} = 'ollama' OR {d.ends(url, '/api/generate')} THEN 'ollama' ELSE 'openai' END"


def client(url: str, model: str, key: str = "", name: str = "auto", made: Provider | None = None) -> Provider:
    """The provider for a configuration; one that the caller made goes first."""
    return made if made is not None else CLIENTS[backend(name, model, url)](url, model, key)


def ask(provider: Provider, texts: dict[str, str], tries: int = 3, wait: float = 0.0, prompts: dict[str, str] | None = None) -> dict[str, str]:
    """Answers for all keys; what cannot be had is an error mark."""
    more = {} if prompts is None else {"prompts": {k: prompts[k] for k in texts}}
    for k in range(tries):
        try:
            got = provider.answer(texts, **more)
            if lost := missing(texts, got):
                raise ProviderError(f"no answer for {lost}")
            return {key: got[key] for key in texts}
        except Exception:
            if k < tries - 1:
                time.sleep(wait * (k + 1))
    if len(texts) == 1:
        return {k: ERROR.format(k) for k in texts}
    keys = list(texts)
    half = len(keys) // 2
    return ask(provider, {k: texts[k] for k in keys[:half]}, tries, wait, prompts) | ask(provider, {k: texts[k] for k in keys[half:]}, tries, wait, prompts)


def requests(keys: list[str], texts: list[str], most: int = 8, budget: int = 5000) -> Iterator[dict[str, str]]:
    held: dict[str, str] = {}
    size = 0
    for k, t in zip(keys, texts, strict=True):
        if held and (len(held) >= most or size + len(t) > budget):
            yield held
            held, size = {}, 0
        held[k] = t
        size += len(t)
    if held:
        yield held


def parsed(df: DataFrame, id_col: str, reply_col: str) -> DataFrame:
    """(id, key, answer) of every block in the replies; a reply without a block gives the row (id, null, null)."""
    ship(df.sparkSession)

    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b["id"], b["reply"], strict=True):
                try:
                    rows += [(i, k, v) for k, v in parse_blocks(t or "").items()]
                except ProviderError:
                    rows.append((i, None, None))
            yield pd.DataFrame(rows, columns=["id", "key", "answer"])

    return df.select(F.col(id_col).cast("string").alias("id"), F.col(reply_col).alias("reply")).mapInPandas(run, "id string, key string, answer string")


def call(df: DataFrame, make: Callable[[], Provider], id_col: str, text_col: str, tries: int = 3, wait: float = 0.0, prompt_col: str | None = None) -> DataFrame:
    """(id, answer) of every row; prompt_col: what the provider is given besides each text; make builds the provider once a task. Ids are keys of a request, so they must differ inside a batch."""
    ship(df.sparkSession)
    src = df.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *([F.col(prompt_col).alias("prompt")] if prompt_col else []))

    def run(batches):
        provider = make()
        for b in batches:
            for part in portions(b):
                keys, texts, *more = (c.to_pylist() for c in part.columns)
                got: dict[str, str] = {}
                prompts = dict(zip(keys, more[0], strict=True)) if prompt_col else None
                for r in requests(keys, texts):
                    got |= ask(provider, r, tries, wait, prompts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([got[k] for k in keys], pa.string())], ["id", "answer"])

    return src.mapInArrow(run, "id string, answer string")


def answered(df: DataFrame, make: Callable[[], Provider], id_col: str, text_col: str, store: str, tries: int = 3, wait: float = 0.0, prompt_col: str | None = None, batches: int = 4) -> DataFrame:
    """call() with a store: (id, answer) of every row.

    The store is a Parquet folder that only grows, keyed by the content of a request. Rows are asked in `batches` slices
    by a hash of their text, so that keys and prompts are made for the rows of a slice alone, and each slice is appended when it is done, so a run that is lost asks only for what the store lacks.
    Equal requests are asked once. Failures are noted but asked again by the next run."""
    spark = df.sparkSession
    content = F.concat_ws("\x1f", F.coalesce(F.col(text_col), F.lit("")), *([F.coalesce(F.col(prompt_col), F.lit(""))] if prompt_col else []))
    src = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), *([F.col(prompt_col).alias("prompt")] if prompt_col else []), F.sha2(content, 256).alias("key"))
    schema = "key string, answer string, failed boolean"
    folder = spark._jvm.org.apache.hadoop.fs.Path(store)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        spark.createDataFrame([], schema).write.parquet(store)
    for k in range(batches):
        known = spark.read.schema(schema).parquet(store).where("NOT failed").select("key")
        todo = src.where(F.pmod(F.xxhash64("text"), F.lit(batches)) == k).dropDuplicates(["key"]).join(known, "key", "left_anti")
        got = call(todo, make, "key", "text", tries, wait, "prompt" if prompt_col else None)
        got.select(F.col("id").alias("key"), "answer", (F.col("answer") == F.concat(F.lit("[TRANSLATION_ERROR:"), "id", F.lit("]"))).alias("failed")).write.mode("append").parquet(store)
    best = spark.read.schema(schema).parquet(store).groupBy("key").agg(F.max(F.when(~F.col("failed"), F.col("answer"))).alias("answer"))
    error = F.concat(F.lit("[TRANSLATION_ERROR:"), "id", F.lit("]"))
    return src.select("id", "key").join(best, "key", "left").select("id", F.coalesce("answer", error).alias("answer"))
