"""Operators as SQL over named inputs, @name@ in the text; rendered for Spark or for DuckDB."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.dialect import DUCK, SPARK, Dialect


class Operator:
    def __init__(self, template: Callable[[Dialect], str]):
        self.template = template

    def __call__(self, spark: SparkSession, **inputs: DataFrame) -> DataFrame:
        """The result over DataFrames; they are views under names of their own while the plan is made."""
        tag = uuid.uuid4().hex
        names = {k: f"{k}_{tag}" for k in inputs}
        for k, df in inputs.items():
            df.createOrReplaceTempView(names[k])
        try:
            return spark.sql(re.sub(r"@(\w+)@", lambda m: names[m[1]], self.template(SPARK)))
        finally:
            for n in names.values():
                spark.catalog.dropTempView(n)

    def sql(self) -> str:
        return re.sub(r"@(\w+)@", r"\1", self.template(DUCK))


def folded(items: str, zero: str, step: str, emit: str, kind: str, last: str | None = None, width: int = 256) -> str:
    """Spark SQL: a fold over an array column that puts out items of its own on the way.

    zero: the first state; step and emit: expressions over the state s and the item x for the next state and for an array
    of what is put out (kind: type of one); last: the same over the state at the end. The fold runs in chunks of `width`
    items, each with an output of its own, so what is copied grows with the items and not with their square."""
    inner = (
        f"aggregate(slice(items, k * {width} + 1, {width}), named_struct('s', a.s, 'done', CAST(array() AS ARRAY<{kind}>)),"
        f" (b, x) -> named_struct('s', {step.replace('@s', 'b.s')}, 'done', concat(b.done, {emit.replace('@s', 'b.s')})), b -> named_struct('s', b.s, 'done', array_append(a.done, b.done)))"
    )
    end = f"concat(flatten(a.done), {last.replace('@s', 'a.s')})" if last else "flatten(a.done)"
    whole = f"aggregate(sequence(0, greatest(0, size(items) - 1) DIV {width}), named_struct('s', {zero}, 'done', CAST(array() AS ARRAY<ARRAY<{kind}>>)), (a, k) -> {inner}, a -> {end})"
    return f"get(transform(array({items}), items -> {whole}), 0)"
