"""Win and churn classifiers, raw scores, and the strongest factors per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F


def fit_classifier(features: DataFrame, label: str, columns: Sequence[str], kind: str = "logistic", **params: object) -> PipelineModel:
    """Logistic regression or gradient-boosted trees over numeric columns. Rows with a null feature or label teach nothing;
    the model scores them as NULL."""
    makers = {"logistic": LogisticRegression, "gbt": GBTClassifier}
    estimator = makers[kind](featuresCol="features", labelCol="label", **params)
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")
    data = features.select(*columns, F.col(label).cast("double").alias("label")).dropna()
    return Pipeline(stages=[assembler, estimator]).fit(data)


def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Every row with the probability of class 1 as a plain column, NULL where a feature is null. A built-in expression of the
    fitted weights or trees: no vectors and no function that generated code would have to ship."""
    columns = model.stages[0].getInputCols()
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    fitted = model.stages[-1]
    if isinstance(fitted, GBTClassificationModel):
        raw = 2 * margin(fitted, columns)
    else:
        raw = reduce(lambda a, b: a + b, [F.col(c).cast("double") * float(w) for c, w in zip(columns, fitted.coefficients)], F.lit(float(fitted.intercept)))
    return df.withColumn(out, F.when(whole, 1 / (1 + F.exp(-raw))))


@dataclass(frozen=True)
class Node:
    """A node of a fitted tree: a leaf with its value, or a split that sends values up to ``threshold`` left. ``cover`` is how many
    training rows reached it."""

    value: float
    cover: float
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None


def tree_nodes(model: GBTClassificationModel) -> list[tuple[float, Node]]:
    """Weight and root of every tree of a boosted model over continuous features."""

    def read(node) -> Node:
        value, cover = float(node.prediction()), float(node.impurityStats().count())
        if node.subtreeDepth() == 0:
            return Node(value, cover)
        split = node.split()
        return Node(value, cover, int(split.featureIndex()), float(split.threshold()), read(node.leftChild()), read(node.rightChild()))

    return [(float(w), read(tree._java_obj.rootNode())) for w, tree in zip(model.treeWeights, model.trees)]


def margin(model: GBTClassificationModel, columns: Sequence[str]) -> Column:
    """The weighted sum of the trees' leaves, half the log odds, as nested conditions."""

    def walk(node: Node) -> Column:
        if node.left is None:
            return F.lit(node.value)
        return F.when(F.col(columns[node.feature]).cast("double") <= node.threshold, walk(node.left)).otherwise(walk(node.right))

    return reduce(lambda a, b: a + b, [walk(root) * w for w, root in tree_nodes(model)])


def raw_score(vector: str | Column = "rawPrediction") -> Column:
    return vector_to_array(vector)[1]


def linear_terms(model: PipelineModel, columns: Sequence[str]) -> dict[str, float]:
    """Coefficients of a fitted logistic model by column."""
    return dict(zip(columns, [float(x) for x in model.stages[-1].coefficients]))


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return {c: float(row[c] or 0.0) for c in columns}


def top_factors(df: DataFrame, coefs: Mapping[str, float], means: Mapping[str, float], k: int = 3, prefix: str = "risk_factor") -> DataFrame:
    """The k columns with the largest absolute contribution coefficient x (value - mean), ties in name order,
    as ``risk_factor_1..k``. Everything stays in one array expression per row."""
    parts = F.array(
        *[
            F.struct(
                (-F.abs(F.lit(float(w)) * (F.coalesce(F.col(c).cast("double"), F.lit(float(means[c]))) - F.lit(float(means[c]))))).alias("rank"),
                F.lit(c).alias("name"),
            )
            for c, w in coefs.items()
        ]
    )
    ordered = F.array_sort(parts)
    return df.withColumn("_f", ordered).withColumns(
        {f"{prefix}_{i + 1}": F.get(F.col("_f"), F.lit(i))["name"] for i in range(k)}
    ).drop("_f")
