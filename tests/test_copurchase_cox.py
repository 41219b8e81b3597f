"""Co-purchase counts and proportional hazards against plain versions."""

from __future__ import annotations

import glob
import os
import random
import threading
from collections import Counter
from contextlib import suppress
from itertools import permutations

import numpy as np
import pytest

from hearthline.operators import copurchase as pairs, pair_counts
from hearthline.operators.copurchase import copurchase
from hearthline.operators.hazards import cox_probs, fit_cox


def plain_partners(rows, k):
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    counts = Counter(pair for items in baskets.values() for pair in permutations(items, 2))
    best = {}
    for (i, j), n in counts.items():
        best.setdefault(i, []).append((-n, j))
    return {(i, j, -n, r + 1) for i, own in best.items() for r, (n, j) in enumerate(sorted(own)[:k])}


@pytest.mark.parametrize("large,block", [(256, 2048), (4, 7), (1, 50), (12, 1000)])
def test_copurchase_equals_plain_version(spark, large, block):
    rng = random.Random(4)
    rows = [(b, rng.randrange(60)) for b in range(80) for _ in range(rng.randint(1, 9))]
    rows += [(1000 + b, rng.randrange(90)) for b in range(3) for _ in range(70)]
    rows += [(5000, i) for i in range(150)]  # a basket with a third of all rows
    rows += [(None, 3), (7, None), *rows[:30]]
    df = spark.createDataFrame(rows, "order_id long, product_id long")
    got = [tuple(r) for r in copurchase(df, 5, large=large, block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_partners(rows, 5)
    assert copurchase(df.limit(0), 5).collect() == []


@pytest.mark.parametrize("far", [1, 1 << 40, -(1 << 62) // 60])
def test_copurchase_of_accounts_lists_ordinary_baskets(spark, tmp_path, monkeypatch, far):
    """Baskets of 60 products are no matrix blocks, whose number grows with the square of the products; a product with more pairs
    than a task counts is dealt to several; ids may lie far apart."""
    from hearthline.plans import registry, sales  # noqa: F401  (importing registers the queries)

    rng = random.Random(5)
    bought = [(b, far * (i if i else 1)) for b in range(40) for i in [0, *rng.sample(range(60), 55 + b % 5)]]
    orders = spark.createDataFrame([(b, b) for b in range(40)], "o_orderkey long, o_custkey long")
    orders.selectExpr("*", "'F' AS o_orderstatus", "1D AS o_totalprice", "TIMESTAMP_NTZ'2000-01-01 00:00:00' AS o_orderdate", "'' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.createDataFrame(bought, "l_orderkey long, l_partkey long")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")

    def never(k):
        raise AssertionError("baskets of accounts were multiplied by blocks")

    monkeypatch.setattr(pairs, "_multiply", never)
    got = {tuple(r) for r in registry.run("r17_copurchase_by_account", spark, str(tmp_path)).collect()}
    assert got == plain_partners(bought, 10)
    dealt = copurchase(lines, 10, "l_orderkey", "l_partkey", cell=500).collect()
    assert {tuple(r) for r in dealt} == plain_partners(bought, 10) and len(dealt) == len(got)


def test_copurchase_shuffles_pairs_in_rounds(spark):
    """Lists dealt to every product take many times the purchases: shuffled at once they filled the disk."""
    rng = random.Random(6)
    bought = [(b, i) for b in range(60) for i in rng.sample(range(5000), 240)]
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    before = {p for d in folders for p in glob.glob(f"{d}/*/shuffle_*.data")}
    most, over = [0], threading.Event()

    def watch():
        while not over.wait(0.01):
            now = {p for d in folders for p in glob.glob(f"{d}/*/shuffle_*.data")} - before
            with suppress(FileNotFoundError):
                most[0] = max(most[0], sum(map(os.path.getsize, now)))

    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    got = {tuple(r) for r in copurchase(spark.createDataFrame(bought, "order_id long, product_id long"), 5, cell=1 << 13).collect()}
    over.set()
    watcher.join()
    assert got == plain_partners(bought, 5)
    assert 0 < most[0] < 2_000_000  # 3.5 million pairs


def test_ordinary_counts_give_all_pairs_of_marked_products_only(spark):
    """Products that no large basket holds meet no block: of their pairs the best are enough."""
    rng = random.Random(7)
    lists = [sorted(rng.sample(range(100), 30)) for _ in range(20)]
    rows = [(30, x, [i < 10 for i in x]) for x in lists]
    got = {tuple(r) for r in pair_counts.counted(spark.createDataFrame(rows, "size int, items array<long>, marks array<boolean>"), 3, 1 << 10).collect()}
    n = Counter(p for x in lists for p in permutations(x, 2))
    both = {(i, j, m) for (i, j), m in n.items() if i < 10 and j < 10}
    assert both <= got and max(Counter(i for i, _, _ in got - both).values()) <= 3 * -(-max(30 * sum(i in x for x in lists) for i in range(100)) // (1 << 10))
    assert {(i, j, m) for i, j, m, r in plain_partners([(b, i) for b, x in enumerate(lists) for i in x], 3)} <= got


def plain_cox(x, t, e):
    """Newton steps on Efron's likelihood, with loops over event times."""
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        w = np.exp(x @ beta)
        slope, curve, jumps = np.zeros(len(beta)), np.zeros((len(beta), len(beta))), []
        for at in sorted(set(t[e == 1])):
            risk, tied = t >= at, (t == at) & (e == 1)
            d, slope = tied.sum(), slope + x[tied].sum(0)
            for part in range(d):
                v = w * risk - part / d * w * tied
                mean = v @ x / v.sum()
                slope = slope - mean
                curve += (x * v[:, None]).T @ x / v.sum() - np.outer(mean, mean)
                jumps.append((at, 1 / v.sum()))
        step = np.linalg.solve(curve, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-10:
            break
    return beta, jumps


@pytest.mark.parametrize("days", [12, 100_000])
def test_cox_equals_plain_version(spark, days):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 2)) * [1.0, 40.0] + [3.0, 500.0]
    t = np.ceil(rng.exponential(days / np.exp(0.5 * x[:, 0] - 0.01 * x[:, 1] + 3)) * 5).clip(1, days * 10)
    e = (rng.random(150) < 0.7).astype(int)
    rows = [(*map(float, a), int(b), int(c)) for a, b, c in zip(x, t, e)] + [(None, 1.0, 3, 1)]
    df = spark.createDataFrame(rows, "a double, b double, duration_days int, event_lost int")
    model = fit_cox(df, ["a", "b"])
    beta, jumps = plain_cox(x - x.mean(0), t, e)
    assert model.fitted and np.allclose(list(model.coefficients.values()), beta, rtol=1e-6, atol=1e-9)
    level = sum(h for at, h in jumps if at <= 30)
    scored = cox_probs(model, df).collect()
    expected = np.exp(-level * np.exp((x - x.mean(0)) @ beta))
    assert np.allclose([r.survival_prob_30d for r in scored[:-1]], expected, atol=1e-6)
    assert scored[-1].survival_prob_30d is None and len(scored) == 151
    total = model.baseline.orderBy("duration").collect()
    assert np.isclose(total[-1].cumulative_hazard, sum(h for _, h in jumps), rtol=1e-6)


@pytest.mark.parametrize("rows", [
    [(1.0, 2.0, 5, 0), (2.0, 1.0, 4, 0)],  # no event
    [(1.0, 2.0, 5, 1), (1.0, 1.0, 4, 1)],  # a covariate that does not vary
    [(float(k), 2.0 * k, k % 7 + 1, 1) for k in range(20)],  # a combination
    [(float(k < 10), float(k % 3), 1 + k, int(k < 10)) for k in range(20)],  # complete separation
    [],
])
def test_cox_without_a_fit(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, duration_days int, event_lost int")
    model = fit_cox(df, ["a", "b"])
    assert not model.fitted
    assert [(r.survival_prob_30d, r.survival_fitted) for r in cox_probs(model, df).collect()] == [(1.0, False)] * len(rows)


@pytest.mark.parametrize("name", ["m7_cox_survival", "m9_held_out_quality"])
def test_fits_read_their_features_once(spark, name, monkeypatch):
    """A fit's steps read written features and do not join orders with their lines again."""
    from hearthline.plans import registry, sales

    plans = []

    def seen(df, *rest, **more):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return make(df, *rest, **more)

    owner, fit = (sales.hazards, "fit_cox") if name.startswith("m7") else (sales.modelling, "fit_classifier")
    make = getattr(owner, fit)
    monkeypatch.setattr(owner, fit, seen)
    assert registry.run(name, spark, "/root/testdata/sf0.001").count()
    assert plans and not any("l_orderkey" in p or "Join" in p for p in plans)
