"""What each feature adds to the score of boosted trees: path-dependent Shapley values as built-in expressions.

A leaf of a tree is a path of conditions. With the features of a path as players, a row reaches the leaf in a coalition's game with
the product, over the features outside it, of the share of training rows that take the path at the splits on that feature, and
over the features inside it, of whether the row itself takes them. That product game has a closed Shapley value per feature: a
weighted sum over the other features' elementary symmetric polynomials, which a path of k features states in k terms. Paths with
the same conditions on a feature share their flag columns, so a row costs one pass over the leaves, inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import comb

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from hearthline.operators.modelling import Node, tree_nodes


@dataclass(frozen=True)
class Leaf:
    """A leaf times its tree's weight. ``bounds`` has for each feature on the path the half-open range (low, high] that leads here,
    ``shares`` the part of training rows that follow the path at that feature's splits."""

    value: float
    bounds: dict[int, tuple[float, float]]
    shares: dict[int, float]


def leaves(weight: float, root: Node) -> list[Leaf]:
    """The root-to-leaf paths of a tree. The splits on one feature along a path become one range and one share."""
    out: list[Leaf] = []
    todo = [(root, {}, {})]
    while todo:
        node, bounds, shares = todo.pop()
        if node.left is None:
            out.append(Leaf(weight * node.value, bounds, shares))
            continue
        low, high = bounds.get(node.feature, (float("-inf"), float("inf")))
        for child, span in ((node.left, (low, min(high, node.threshold))), (node.right, (max(low, node.threshold), high))):
            share = shares.get(node.feature, 1.0) * child.cover / node.cover
            todo.append((child, bounds | {node.feature: span}, shares | {node.feature: share}))
    return out


def expected(all_leaves: Sequence[Leaf]) -> float:
    """The score of a row of which nothing is known."""
    return sum(leaf.value * reduce(lambda a, b: a * b, leaf.shares.values(), 1.0) for leaf in all_leaves)


def _shapley(leaf: Leaf, flags: dict[tuple[int, float, float], Column]) -> dict[int, Column]:
    """Per feature of the path the leaf's value x (flag - share) x the weighted sum over all coalitions of the other features. The
    polynomial prod(share_j + flag_j z) over the others has at z^s the sum over their coalitions of s members; flags are 0 or 1."""
    features = list(leaf.bounds)
    n = len(features)
    flag = {f: flags[(f, *leaf.bounds[f])] for f in features}
    out = {}
    for f in features:
        sizes: list[Column] = [F.lit(1.0)]
        for other in features:
            if other == f:
                continue
            grown = [c * leaf.shares[other] for c in sizes] + [F.lit(0.0)]
            sizes = [grown[0]] + [grown[s] + sizes[s - 1] * flag[other] for s in range(1, len(grown))]
        total = reduce(lambda a, b: a + b, [c / (n * comb(n - 1, s)) for s, c in enumerate(sizes)])
        out[f] = (flag[f] - leaf.shares[f]) * total * leaf.value
    return out


def tree_contributions(model: PipelineModel, df: DataFrame, out: str = "contributions", base: str = "base_score") -> DataFrame:
    """Every row with a map from feature to its contribution to the margin (the weighted sum of leaves, half the log odds) and the
    ``base`` that an unknown row has: base plus contributions is the margin. NULL where a feature is null or where a column of the
    given name is none of the model's. The model is fit_classifier's of kind gbt over continuous columns.

    Rows never meet each other, so nothing is shuffled. The expression has up to 2^depth terms a leaf: meant for the depths that
    boosted trees have, up to about 6.
    """
    columns = model.stages[0].getInputCols()
    paths = [leaf for weight, root in tree_nodes(model.stages[-1]) for leaf in leaves(weight, root)]
    spans = sorted({(f, *span) for leaf in paths for f, span in leaf.bounds.items()})
    named = {span: f"_in{k}" for k, span in enumerate(spans)}
    value = lambda f: F.col(columns[f]).cast("double")
    held = df.withColumns({name: ((value(f) > low) & (value(f) <= high)).cast("double") for (f, low, high), name in named.items()})
    flags = {span: F.col(name) for span, name in named.items()}
    parts: dict[int, list[Column]] = {f: [] for f in range(len(columns))}
    for leaf in paths:
        for f, c in _shapley(leaf, flags).items():
            parts[f].append(c)
    zero = F.lit(0.0)
    sums = {f"_add{f}": reduce(lambda a, b: a + b, cs, zero) for f, cs in parts.items()}
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    summed = held.select(*df.columns, *[c.alias(n) for n, c in sums.items()])
    pairs = [x for f, c in enumerate(columns) for x in (F.lit(c), F.col(f"_add{f}"))]
    return summed.select(*df.columns, F.when(whole, F.create_map(*pairs)).alias(out), F.lit(expected(paths)).alias(base))


def top_contributions(df: DataFrame, k: int = 3, contributions: str = "contributions", prefix: str = "risk_factor") -> DataFrame:
    """The k features with the largest absolute contribution, ties in name order, as ``risk_factor_1..k`` with ``.._value``."""
    entries = F.map_entries(contributions)
    ranked = F.array_sort(F.transform(entries, lambda e: F.struct((-F.abs(e["value"])).alias("rank"), e["key"].alias("name"), e["value"].alias("value"))))
    at = lambda i, c: F.get(F.col("_ranked"), F.lit(i))[c]
    named = {f"{prefix}_{i + 1}{tail}": at(i, c) for i in range(k) for tail, c in (("", "name"), ("_value", "value"))}
    return df.withColumn("_ranked", ranked).withColumns(named).drop("_ranked")
