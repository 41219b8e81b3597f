"""Model calls from SQL: all rows pass through, errors stay on their rows, budgets hold."""

from __future__ import annotations

import pytest

from hearthline.operators.model_call import Budget, Caller, register_model

ROWS = [(k, None if k % 11 == 0 else "bad" if k % 7 == 0 else f"text {k}") for k in range(60)]


def shout(texts):
    if "bad" in texts:
        raise RuntimeError("refused")
    return [t.upper() for t in texts]


def test_function_and_table_function(spark):
    register_model(spark, "shout", shout, Budget(batch=8, retries=2, pause=0.0))
    spark.createDataFrame(ROWS, "id int, body string").repartition(3).createOrReplaceTempView("requests")
    want = sorted((k, t, None if t in (None, "bad") else t.upper(), "RuntimeError: refused" if t == "bad" else None) for k, t in ROWS)
    for text in ("SELECT id, body, a.response, a.error FROM (SELECT *, shout(body) AS a FROM requests)", "SELECT * FROM shout_rows(TABLE(requests), 'body')"):
        assert sorted(map(tuple, spark.sql(text).collect()), key=lambda r: r[0]) == want
    assert spark.sql("SELECT * FROM shout_rows(TABLE(SELECT * FROM requests WHERE id < 0), 'body')").count() == 0
    with pytest.raises(Exception, match="text column"):
        spark.sql("SELECT * FROM shout_rows(TABLE(requests), 'other')").collect()
    with pytest.raises(Exception, match="response or error"):
        spark.sql("SELECT * FROM shout_rows(TABLE(SELECT body, 1 AS error FROM requests), 'body')").collect()


def test_budgets():
    calls = []

    def flaky(texts):
        calls.append(len(texts))
        if len(calls) < 4:
            raise OSError("busy")
        return texts

    assert Caller(flaky, Budget(retries=5, pause=0.0)).answer(["a"]) == [("a", None)] and len(calls) == 4
    broken = Caller(lambda t: 1 / 0, Budget(retries=3, pause=0.0))
    assert all(e.startswith("ZeroDivisionError") for _, e in broken.answer(list("abcdef"))) and broken.left == 0
    short = Caller(lambda t: t[:1], Budget(retries=0))
    assert short.answer(["a", "b"]) == [("a", None), ("b", None)]  # a wrong count is tried row by row
