"""A model call inside SQL: as a function of a text, and as a table function that passes its rows through.

Texts are sent in batches from within the tasks. A failed batch is tried again as a whole, then row by row; what still fails gets its
message and stops nobody else. Retries and the rate are budgets of a task: they bound what a broken or slow endpoint costs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Row, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

Model = Callable[[list[str]], list[str]]
ANSWER = StructType([StructField("response", StringType()), StructField("error", StringType())])


@dataclass(frozen=True)
class Budget:
    """``batch`` texts a call, at most ``per_second`` calls (None: no bound), at most ``retries`` repeated calls a task, the first
    after ``pause`` seconds, each later one after twice as long, up to 32 times."""

    batch: int = 64
    per_second: float | None = None
    retries: int = 20
    pause: float = 0.1


class Caller:
    """Calls of one task."""

    def __init__(self, model: Model, budget: Budget):
        self.model, self.budget = model, budget
        self.left, self.pause, self.free_at = budget.retries, budget.pause, 0.0

    def _call(self, texts: list[str]) -> list[str]:
        if self.budget.per_second:
            now = time.monotonic()
            if now < self.free_at:
                time.sleep(self.free_at - now)
            self.free_at = max(now, self.free_at) + 1 / self.budget.per_second
        answers = self.model(texts)
        if len(answers) != len(texts):
            raise ValueError("answers and texts differ in number")
        return answers

    def _again(self) -> bool:
        if self.left <= 0:
            return False
        self.left -= 1
        time.sleep(self.pause)
        self.pause = min(2 * self.pause, 32 * self.budget.pause)
        return True

    def answer(self, texts: list[str | None]) -> list[tuple[str | None, str | None]]:
        """(response, error) of each text; a null text is not sent and has neither."""
        known = [k for k, t in enumerate(texts) if t is not None]
        out: list[tuple[str | None, str | None]] = [(None, None)] * len(texts)
        for first in range(0, len(known), self.budget.batch):
            some = known[first : first + self.budget.batch]
            for k, pair in zip(some, self._batch([texts[k] for k in some])):
                out[k] = pair
        return out

    def _batch(self, texts: list[str]) -> list[tuple[str | None, str | None]]:
        while True:
            try:
                return [(None if a is None else str(a), None) for a in self._call(texts)]
            except Exception as e:
                message = f"{type(e).__name__}: {e}"
                if len(texts) > 1:  # one text may spoil the batch
                    return [pair for t in texts for pair in self._batch([t])]
                if not self._again():
                    return [(None, message)]


def register_model(spark: SparkSession, name: str, model: Model, budget: Budget = Budget()) -> None:
    """Register ``name(text)``, which gives a struct of response and error, and the table function ``name_rows(TABLE(...), 'column')``,
    which gives every row of its table with ``response`` and ``error`` for the text in that column."""

    def answers(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        caller = Caller(model, budget)
        for some in texts:
            yield pd.DataFrame(caller.answer([None if pd.isna(t) else t for t in some]), columns=["response", "error"], dtype=object)

    spark.udf.register(name, F.pandas_udf(answers, ANSWER))

    class ModelRows:
        def __init__(self) -> None:
            self.caller, self.waiting = Caller(model, budget), []

        @staticmethod
        def analyze(rows: AnalyzeArgument, column: AnalyzeArgument) -> AnalyzeResult:
            if not rows.isTable or column.value not in rows.dataType.fieldNames():
                raise ValueError("give a table and the name of its text column")
            if {"response", "error"} & set(rows.dataType.fieldNames()):
                raise ValueError("the table has a column of the name response or error")
            return AnalyzeResult(StructType([*rows.dataType.fields, *ANSWER.fields]))

        def eval(self, row: Row, column: str) -> Iterator[tuple]:
            self.waiting.append((row, row[column]))
            if len(self.waiting) >= budget.batch:
                yield from self._flush()

        def terminate(self) -> Iterator[tuple]:
            yield from self._flush()

        def _flush(self) -> Iterator[tuple]:
            rows, self.waiting = self.waiting, []
            for (row, _), pair in zip(rows, self.caller.answer([t for _, t in rows])):
                yield (*row, *pair)

    spark.udtf.register(f"{name}_rows", F.udtf(ModelRows))
