"""Stored history against the merge of whole tables, the buckets it leaves alone, its plan, and loads lost half way."""

from __future__ import annotations

import glob
import random

import pytest

from hearthline.operators import scd
from hearthline.sources import stored_history as sh

KEYS = ["id", "region"]
STAMPS = [f"2026-0{m}-01 00:00:00" for m in range(1, 6)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def load(spark, pairs):
    return spark.createDataFrame([(k, f"r{k % 3}" if k is not None else None, v) for k, v in pairs], "id long, region string, v string")


def files(spark, name):
    at = spark.sql(f"DESCRIBE EXTENDED {name}_current").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    return {f for f in glob.glob(f"{at}/*/*.parquet")}


def bucket(path):
    return int(path.split("_bucket=")[1].split("/")[0])


def test_same_as_merge(spark):
    rng = random.Random(4)
    name, whole = "hist_same", None
    state = {k: "a" for k in range(60)}
    for at in STAMPS:
        for k in rng.sample(range(80), 6):
            state[k] = rng.choice("abc")
        pairs = [(k, v) for k, v in state.items() if rng.random() < 0.7] + [(None, "x"), (5, "p"), (5, "q"), (6, None)]
        df = load(spark, pairs)
        merged = scd.scd2_merge(df, whole, KEYS, at)
        whole = spark.createDataFrame(merged.collect(), merged.schema)
        before = files(spark, name) if spark.catalog.tableExists(f"{name}_current") else set()
        touched = sh.merge_load(spark, name, df, KEYS, at, buckets=8)
        after = files(spark, name)
        assert rows(sh.stored_history(spark, name).select(*whole.columns)) == rows(whole)
        assert {f for f in before if bucket(f) not in touched} <= after
        assert len(after) == len({bucket(f) for f in after})  # one file a bucket
    assert rows(sh.stored_as_of(spark, name, "2026-03-10 00:00:00").select(*whole.columns)) == rows(scd.scd2_as_of(whole, "2026-03-10 00:00:00"))
    assert not spark.catalog.tableExists(f"{name}_changes")


def test_few_changes_touch_few_buckets(spark):
    sh.merge_load(spark, "hist_few", load(spark, [(k, "a") for k in range(200)]), KEYS, STAMPS[0], buckets=16)
    before = files(spark, "hist_few")
    assert sh.merge_load(spark, "hist_few", load(spark, [(k, "a") for k in range(200)]), KEYS, STAMPS[1]) == []
    assert sh.merge_load(spark, "hist_few", load(spark, []), KEYS, STAMPS[1]) == []
    assert files(spark, "hist_few") == before
    touched = sh.merge_load(spark, "hist_few", load(spark, [(k, "b" if k == 7 else "a") for k in range(200)]), KEYS, STAMPS[2])
    assert len(touched) == 1
    assert {bucket(f) for f in before - files(spark, "hist_few")} == set(touched)


def test_history_is_not_exchanged(spark):
    sh.merge_load(spark, "hist_plan", load(spark, [(k, "a") for k in range(50)]), KEYS, STAMPS[0], buckets=8)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current = spark.table("hist_plan_current")
        new = sh._prepared(load(spark, [(1, "b")]), current, KEYS, 8)
        plan = sh.changes(new, current, KEYS, 8, STAMPS[1], touched=[3])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    above = plan[plan.index("Join") : plan.index("FileScan")].splitlines()
    assert "Bucketed: true" in plan
    right = above[max(i for i, x in enumerate(above) if "Sort" in x) :]
    assert not any("Exchange" in x for x in right)
    assert "PartitionFilters" in plan and "_bucket" in plan[plan.index("PartitionFilters") :].splitlines()[0]


@pytest.mark.parametrize("lost", ["before", "between"])
def test_lost_load_is_finished(spark, monkeypatch, lost):
    name, first, second = f"hist_lost_{lost}", [(k, "a") for k in range(30)], [(k, "b" if k % 4 == 0 else "a") for k in range(35)]
    sh.merge_load(spark, name, load(spark, first), KEYS, STAMPS[0], buckets=4)
    want = scd.scd2_merge(load(spark, second), scd.scd2_merge(load(spark, first), None, KEYS, STAMPS[0]), KEYS, STAMPS[1])
    apply, sql = sh._apply, spark.sql
    if lost == "before":  # nothing applied yet
        monkeypatch.setattr(sh, "_apply", lambda spark, name: [])
    else:  # applied, but not struck off
        monkeypatch.setattr(spark, "sql", lambda q, *a, **k: (_ for _ in ()).throw(RuntimeError("lost")) if q.startswith("DROP") else sql(q, *a, **k))
    try:
        sh.merge_load(spark, name, load(spark, second), KEYS, STAMPS[1])
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert spark.catalog.tableExists(f"{name}_changes") and sh._apply is apply
    sh.merge_load(spark, name, load(spark, second), KEYS, STAMPS[2])
    assert rows(sh.stored_history(spark, name).select(*want.columns)) == rows(want)


def test_columns(spark):
    sh.merge_load(spark, "hist_cols", load(spark, [(1, "a"), (2, "a")]), KEYS, STAMPS[0], buckets=4)
    wide = spark.createDataFrame([(1, "r1", "a", 5), (2, "r2", "a", None)], "id long, region string, v string, w int")
    sh.merge_load(spark, "hist_cols", wide, KEYS, STAMPS[1])
    got = {(r.id, r.w, r.is_current) for r in sh.stored_history(spark, "hist_cols").collect()}
    assert got == {(1, None, 0), (1, 5, 1), (2, None, 1)}
    with pytest.raises(ValueError, match="lacks"):
        sh.merge_load(spark, "hist_cols", load(spark, [(1, "a")]), KEYS, STAMPS[2])
    with pytest.raises(ValueError, match="kept by"):
        sh.merge_load(spark, "hist_cols", wide, ["id"], STAMPS[2])
