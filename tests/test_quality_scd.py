from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hearthline.functions.bands import quality_grade
from hearthline.operators import quality, scd

RUN = "2026-02-01 00:00:00"


def test_quarantine_example(spark):
    df = spark.createDataFrame([("001000000000000AAA", "Valid Name"), ("001000000000000BBB", ""), ("001", "Valid Name")], "Id string, Name string")
    df = quality.add_quarantine_columns(df, RUN)
    df = quality.validate_name_column(quality.validate_id_column(df, "Id"), "Name")
    bad = {r.Id: r.quarantine_reason for r in quality.filter_invalid_records(df).collect()}
    assert bad == {"001000000000000BBB": ["Invalid_Name"], "001": ["Invalid_Id"]}


def test_custom_validator_with_transform(spark):
    def no_blanks(df):
        return quality.validate_rules(df, {"blank": "Name NOT LIKE '% %'"})

    df = quality.add_quarantine_columns(spark.createDataFrame([("a b",), ("ab",), (None,)], "Name string"), RUN)
    assert quality.filter_invalid_records(df.transform(no_blanks)).count() == 2


def test_split_partitions_the_input(spark):
    df = spark.range(100).selectExpr("id", "IF(id % 7 = 0, NULL, id % 5) AS v")
    good, bad = quality.split_valid(df, {"v": "v > 1", "id": "id < 90"}, RUN)
    ids = sorted(r.id for r in good.collect()) + sorted(r.id for r in bad.collect())
    assert sorted(ids) == list(range(100)) and good.columns == df.columns


def test_expect_keeps_rows_and_null_is_a_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    kept, metrics = quality.expect(df, {"positive": "v > 0"})
    assert kept is df and [tuple(r) for r in metrics.collect()] == [("positive", 3, 2)]
    assert quality.expect_or_drop(df, {"positive": "v > 0"}).count() == 1


def test_expect_on_no_rows(spark):
    assert [tuple(r) for r in quality.expect(spark.createDataFrame([], "v int"), {"p": "v > 0"})[1].collect()] == [("p", 0, 0)]


def test_observe(spark):
    df, seen = quality.observe(spark.range(10).toDF("v"), {"small": "v < 8"})
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"total_records": 10, "small": 2}


def test_grades(spark):
    df = spark.createDataFrame([(95.0,), (90.0,), (80.0,), (70.0,), (69.99,)], "r double")
    assert [r[0] for r in df.select(quality_grade(F.col("r"))).collect()] == ["優秀", "良好", "普通", "要改善", "要緊急対応"]


def test_summary_of_empty_tables(spark):
    empty = spark.createDataFrame([], "v int")
    row = quality.quality_summary({"A": (empty, None)}).first()
    assert (row.total_records, float(row.pass_rate), float(row.quarantine_rate)) == (0, 0.0, 0.0)


def history(ntz, rows):
    return ntz(rows, "id int, v string, valid_from string, valid_to string, is_current int", ("valid_from", "valid_to"))


def case(spark, ntz):
    incoming = spark.createDataFrame([(1, "same"), (2, "new"), (3, "fresh")], "id int, v string")
    existing = history(ntz, [(1, "same", "2026-01-01", None, 1), (2, "old", "2026-01-01", None, 1), (4, "gone", "2026-01-01", None, 1), (2, "older", "2025-01-01", "2026-01-01", 0)])
    return incoming, existing


def test_scd2_case(spark, ntz):
    incoming, existing = case(spark, ntz)
    rows = sorted((r.id, r.v, str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current) for r in scd.scd2_merge(incoming, existing, ["id"], RUN).collect())
    assert rows == [
        (1, "same", "2026-01-01", "None", 1),
        (2, "new", "2026-02-01", "None", 1),
        (2, "old", "2026-01-01", "2026-02-01", 0),
        (2, "older", "2025-01-01", "2026-01-01", 0),
        (3, "fresh", "2026-02-01", "None", 1),
        (4, "gone", "2026-01-01", "None", 1),
    ]


def test_scd2_properties(spark, ntz):
    incoming, existing = case(spark, ntz)
    out = scd.scd2_merge(incoming, existing, ["id"], RUN)
    assert out.filter("is_current = 1").groupBy("id").count().filter("count <> 1").count() == 0
    overlap = out.alias("a").join(out.alias("b"), F.expr("a.id = b.id AND a.v <> b.v AND a.valid_from < coalesce(b.valid_to, TIMESTAMP_NTZ'9999-01-01') AND b.valid_from < coalesce(a.valid_to, TIMESTAMP_NTZ'9999-01-01')"))
    assert overlap.count() == 0
    again = scd.scd2_merge(incoming, out, ["id"], "2026-03-01 00:00:00")
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_scd2_first_run(spark):
    out = scd.scd2_merge(spark.createDataFrame([(1, "a")], "id int, v string"), None, ["id"], RUN).first()
    assert out.is_current == 1 and out.valid_to is None


def test_scd2_null_and_empty_differ(spark, ntz):
    incoming = spark.createDataFrame([(1, "")], "id int, v string")
    assert scd.scd2_merge(incoming, history(ntz, [(1, None, "2026-01-01", None, 1)]), ["id"], RUN).count() == 2


def test_scd2_track(spark, ntz):
    incoming = spark.createDataFrame([(1, "x", 9)], "id int, v string, w int")
    first = scd.scd2_merge(spark.createDataFrame([(1, "x", 1)], "id int, v string, w int"), None, ["id"], "2026-01-01 00:00:00")
    assert scd.scd2_merge(incoming, first, ["id"], RUN, track=["v"]).count() == 1
    assert scd.scd2_merge(incoming, first, ["id"], RUN).count() == 2


def test_scd2_new_column(spark, ntz):
    incoming = spark.createDataFrame([(1, "same", "x")], "id int, v string, extra string")
    out = scd.scd2_merge(incoming, history(ntz, [(1, "same", "2026-01-01", None, 1)]), ["id"], RUN)
    assert sorted((r.extra or "", r.is_current) for r in out.collect()) == [("", 0), ("x", 1)]


def test_change_parts(spark, ntz):
    incoming, existing = case(spark, ntz)
    current = scd.scd2_current(existing)
    assert [r.id for r in scd.changed_rows(incoming, current, ["id"]).collect()] == [2]
    assert [r.id for r in scd.new_rows(incoming, current, ["id"]).collect()] == [3]
    assert [r.id for r in scd.unchanged_rows(incoming, current, ["id"]).collect()] == [1]
    assert [r.id for r in scd.missing_rows(incoming, current, ["id"]).collect()] == [4]
    assert {r.status: r.row_count for r in scd.scd_diff(incoming, current, ["id"]).collect()} == dict.fromkeys(("changed", "new", "unchanged", "missing"), 1)


@pytest.mark.parametrize("at,expected", [("2025-06-01 00:00:00", ["older"]), ("2026-01-01 00:00:00", ["gone", "old", "same"]), ("2024-01-01 00:00:00", [])])
def test_as_of(spark, ntz, at, expected):
    assert sorted(r.v for r in scd.scd2_as_of(case(spark, ntz)[1], at).collect()) == expected
