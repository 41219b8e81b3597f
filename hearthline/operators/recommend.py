"""Product recommendations per account."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window as W, functions as F

from hearthline.operators.dedupe import top_per_group


#: Lines that one task joins or sums, so that its memory does not grow with the table.
TASK_LINES = 1 << 20


def purchases(orders: DataFrame, lines: DataFrame, task_lines: int = TASK_LINES) -> DataFrame:
    """Distinct (account, product) pairs with the ordered quantity. The lines are counted while the plan is built: so many tasks
    join and sum them that each has about ``task_lines``."""
    n = max(lines.sparkSession.sparkContext.defaultParallelism, lines.count() // task_lines + 1)
    told = orders.select("order_id", "account_id").repartition(n, "order_id")
    joined = told.join(lines.select("order_id", "product_id", "quantity").repartition(n, "order_id"), "order_id")
    return joined.repartition(n, "account_id", "product_id").groupBy("account_id", "product_id").agg(F.sum("quantity").alias("quantity"))


def owners(bought: DataFrame, accounts: DataFrame) -> DataFrame:
    """Buying accounts with their segment and the number of products they own."""
    return bought.groupBy("account_id").agg(F.count("*").alias("owned")).join(accounts.select("account_id", "segment"), "account_id")


def cooccurrence(bought: DataFrame, accounts: DataFrame) -> DataFrame:
    """Share of a segment's buyers who bought the product.

    Counts go over (segment, product) instead of product pairs inside an order or account: the work stays
    linear in the purchases, however large one basket is.
    """
    buyers = owners(bought, accounts).groupBy("segment").agg(F.count("*").alias("buyers"))
    tagged = bought.select("account_id", "product_id").join(accounts.select("account_id", "segment"), "account_id")
    share = tagged.groupBy("segment", "product_id").agg(F.count("*").alias("product_buyers"))
    return share.join(buyers, "segment").select(
        "segment", "product_id", (F.col("product_buyers") / F.col("buyers")).alias("cooccurrence_score")
    )


def recommend(bought: DataFrame, accounts: DataFrame, n: int = 5) -> DataFrame:
    """The n best-scored products of each account's segment that the account has not bought, ranked.

    Among the first n + b products of a segment, an account with b purchases misses at least n (or all there are). So the places
    of its own products are taken from those numbers, and only the n first that are left ask for their product: rows grow with
    purchases, and behind them with n per account. Places past the end of the segment's list find no product, nor does the one
    place that a null product leaves empty, for which one more is asked. A place many accounts ask for is a many-to-one join
    key, which AQE splits when it grows large.
    """
    places = segment_places(cooccurrence(bought, accounts))
    who = bought.select("account_id", "product_id").join(accounts.select("account_id", "segment"), "account_id")
    taken = who.join(places.select("segment", "product_id", "place"), ["segment", "product_id"])
    taken = taken.groupBy("account_id", "segment").agg(F.collect_set("place").alias("taken"))
    first = F.sequence(F.lit(1), (F.col("owned") + n).cast("int"))
    left = F.slice(F.array_except(first, F.coalesce("taken", F.array().cast("array<int>"))), 1, n + 1)
    asked = owners(bought, accounts).join(taken, ["account_id", "segment"], "left").select(
        "account_id", "segment", F.explode(left).alias("place")
    )
    fresh = asked.join(places, ["segment", "place"])
    ranked = top_per_group(fresh, ["account_id"], [F.col("place")], n, rank="recommendation_rank")
    return ranked.select("account_id", "product_id", "cooccurrence_score", "recommendation_rank")


SLICE = 4096


def segment_places(scores: DataFrame) -> DataFrame:
    """Place of every product in its segment by falling score, then product id (an integer).

    A place is the number of products with a better score, plus those of the same score in earlier id slices,
    plus the position inside the slice. Each part is a window over a small group, although most products of a
    segment may share one score.
    """
    cell = F.floor(F.col("product_id") / SLICE)
    sliced = scores.withColumn("_slice", cell)
    slices = sliced.groupBy("segment", "cooccurrence_score", "_slice").agg(F.count("*").alias("n"))
    levels = slices.groupBy("segment", "cooccurrence_score").agg(F.sum("n").alias("n"))
    before = lambda w: F.sum("n").over(w) - F.col("n")
    better = levels.withColumn("_better", before(W.partitionBy("segment").orderBy(F.desc("cooccurrence_score")))).drop("n")
    level = ["segment", "cooccurrence_score"]
    earlier = slices.withColumn("_earlier", before(W.partitionBy(*level).orderBy("_slice"))).drop("n")
    position = F.row_number().over(W.partitionBy(*level, "_slice").orderBy("product_id"))
    place = F.col("_better") + F.col("_earlier") + F.col("_position")
    return (
        sliced.withColumn("_position", position)
        .join(earlier.join(better, level), [*level, "_slice"])
        .select("segment", "product_id", "cooccurrence_score", place.cast("int").alias("place"))
    )


def fit_cf(bought: DataFrame, rank: int = 8, iterations: int = 5, seed: int = 7) -> ALSModel:
    """Implicit-feedback factorisation of the (account, product) quantities; ids must be integers."""
    als = ALS(
        userCol="account_id", itemCol="product_id", ratingCol="quantity", implicitPrefs=True,
        rank=rank, maxIter=iterations, seed=seed, coldStartStrategy="nan",
    )
    return als.fit(bought.select(*[F.col(c).cast("int").alias(c) for c in ("account_id", "product_id")], F.col("quantity").cast("float").alias("quantity")))


def with_cf_score(recommendations: DataFrame, model: ALSModel, weight: float = 0.5, n: int = 5) -> DataFrame:
    """Add ``cf_score`` to the candidates and rank again by the weighted ``purchase_score``."""
    ids = recommendations.withColumns({c: F.col(c).cast("int") for c in ("account_id", "product_id")})
    scored = model.transform(ids).withColumnRenamed("prediction", "cf_score")
    cf = F.coalesce(F.nanvl(F.col("cf_score").cast("double"), F.lit(0.0)), F.lit(0.0))
    mixed = scored.withColumn("cf_score", cf).withColumn(
        "purchase_score", F.lit(weight) * F.col("cf_score") + F.lit(1 - weight) * F.col("cooccurrence_score")
    )
    return top_per_group(mixed.drop("recommendation_rank"), ["account_id"], [F.desc("purchase_score"), F.asc("product_id")], n, rank="recommendation_rank")
