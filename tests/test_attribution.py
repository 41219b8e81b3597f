"""Tree contributions against enumeration of all coalitions, and built-in scores against the library's own."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from hearthline.operators import attribution, evaluation, modelling

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3)).round(2)
    y = ((x[:, 0] > 0.2) & (x[:, 1] < 0.5) | (x[:, 2] * x[:, 0] > 0.8)).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, label int").coalesce(1)
    return modelling.fit_classifier(df, "label", NAMES, "gbt", maxIter=4, maxDepth=3, seed=1), df


def value_of(node, row, known):
    """The tree's value when only ``known`` features are: both branches by their shares at the others."""
    if node.left is None:
        return node.value
    if node.feature in known:
        return value_of(node.left if row[node.feature] <= node.threshold else node.right, row, known)
    return (node.left.cover * value_of(node.left, row, known) + node.right.cover * value_of(node.right, row, known)) / node.cover


def enumerated(trees, row):
    game = lambda s: sum(w * value_of(t, row, s) for w, t in trees)
    n, out = len(row), []
    for f in range(n):
        others = [k for k in range(n) if k != f]
        out.append(sum(factorial(s) * factorial(n - s - 1) / factorial(n) * (game({*c, f}) - game({*c})) for s in range(n) for c in combinations(others, s)))
    return out, game(set()), game(set(range(n)))


def test_contributions_equal_enumeration(fitted, spark):
    model, df = fitted
    trees = modelling.tree_nodes(model.stages[-1])
    rows = attribution.top_contributions(attribution.tree_contributions(model, df.limit(60))).collect()
    for r in rows:
        want, base, full = enumerated(trees, (r.a, r.b, r.c))
        got = [r.contributions[n] for n in NAMES]
        assert np.allclose(got, want, atol=1e-9) and abs(r.base_score - base) < 1e-9 and abs(r.base_score + sum(got) - full) < 1e-9
        best = sorted(zip([-abs(v) for v in got], NAMES))
        assert [r.risk_factor_1, r.risk_factor_2, r.risk_factor_3] == [n for _, n in best]
    odd = spark.createDataFrame([(None, 1.0, 2.0)], "a double, b double, c double")
    assert attribution.tree_contributions(model, odd).first().contributions is None


def test_built_in_score_equals_the_library(fitted):
    model, df = fitted
    own = [r.score for r in modelling.score(model, df).collect()]
    theirs = [r.p for r in model.transform(df).select(vector_to_array("probability")[1].alias("p")).collect()]
    assert np.allclose(own, theirs, atol=1e-9)
    logistic = modelling.fit_classifier(df, "label", NAMES, maxIter=10)
    theirs = [r.p for r in logistic.transform(df).select(vector_to_array("probability")[1].alias("p")).collect()]
    assert np.allclose([r.score for r in modelling.score(logistic, df).collect()], theirs, atol=1e-9)


@pytest.mark.parametrize("rows", [
    [(0.1, 0), (0.4, 1), (0.4, 0), (0.9, 1), (0.9, 1), (1.0, 0), (0.0, 1)],
    [(k % 17 / 17, (k * 7) % 5 % 2) for k in range(500)],
    [(0.5, 1)] * 200 + [(0.2, 0)] * 100,
])
def test_quality_equals_pairs(spark, rows):
    df = spark.createDataFrame([*rows, (None, 1), (0.3, None)], "p double, y int")
    got = evaluation.classifier_quality(df, "p", "y").first()
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    q = [(min(max(p, 1e-15), 1 - 1e-15), y) for p, y in rows]
    assert abs(got.auc - auc) < 1e-12 and (got.n_rows, got.n_positive) == (len(rows), len(pos))
    assert abs(got.log_loss + np.mean([np.log(p if y else 1 - p) for p, y in q])) < 1e-9
    bins = evaluation.calibration(df, "p", "y", 4).collect()
    assert sum(b.n_rows for b in bins) == len(rows) and abs(sum(b.n_rows * b.share_positive for b in bins) - len(pos)) < 1e-9


def test_quality_without_both_labels(spark):
    df = spark.createDataFrame([(0.5, 1)], "p double, y int")
    assert evaluation.classifier_quality(df, "p", "y").first().auc is None
    empty = evaluation.classifier_quality(df.limit(0), "p", "y").first()
    assert (empty.n_rows, empty.auc, empty.log_loss) == (0, None, None)
    train, rest = evaluation.split_by_hash(spark.range(1000), "id")
    assert 230 < rest.count() < 370 and train.count() + rest.count() == 1000
