"""One of several promoters wins, and a promoter that was lost leaves the earlier version live."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from hearthline.sources import versions


def test_concurrent_promoters(spark, tmp_path):
    base = f"{tmp_path}/t"
    versions.promote(spark, base, versions.stage(spark.range(1), base))
    seen = versions.latest(spark, base)
    staged = [versions.stage(spark.range(k), base) for k in range(2, 8)]

    def attempt(version):
        try:
            versions.promote(spark, base, version, seen)
            return version
        except versions.Conflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = [v for v in pool.map(attempt, staged) if v]
    assert len(won) == 1 and versions.latest(spark, base) == versions.Pointer(seen.seq + 1, won[0], seen.version)
    with pytest.raises(versions.Conflict):
        versions.promote(spark, base, staged[0], seen)
    assert versions.rollback(spark, base) == seen.version and versions.read_live(spark, base).count() == 1


def test_lost_promoter(spark, tmp_path):
    base = f"{tmp_path}/t"
    one, two = (versions.stage(spark.range(k), base) for k in (1, 2))
    versions.promote(spark, base, one)
    versions._create(spark, base, 2)  # took its number and was lost before it wrote
    assert versions.read_live(spark, base).count() == 1
    versions.promote(spark, base, two)
    assert versions.latest(spark, base).seq == 3 and versions.read_live(spark, base).count() == 2
    assert versions.rollback(spark, base) == one


def test_earlier_layout(spark, tmp_path):
    base = f"{tmp_path}/t"
    old = versions.stage(spark.range(3), base)
    spark.createDataFrame([(4, old, None)], versions.POINTER).write.parquet(f"{base}/_pointer_log")
    assert versions.read_live(spark, base).count() == 3
    versions.promote(spark, base, versions.stage(spark.range(5), base))
    assert versions.latest(spark, base).seq == 5 and versions.rollback(spark, base) == old


def test_catalog_view(spark):
    view = "default.swapped"
    tables = []
    for n in (2, 3):
        tables.append(versions.stage_table(spark.range(n), view))
        versions.promote_table(spark, view, tables[-1])
        assert spark.table(view).count() == n
    versions.promote_table(spark, view, tables[0])
    assert spark.table(view).count() == 2
    spark.sql(f"DROP VIEW {view}")
    for t in tables:
        spark.sql(f"DROP TABLE {t}")
