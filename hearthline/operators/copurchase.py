"""Products bought together: exact pair counts over baskets, and the strongest partners of each product."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from hearthline.operators.dedupe import top_per_group
from hearthline.operators.pair_counts import counted
from hearthline.sources.staging import stage

#: Distinct products up to which a basket is sent to each of its products; larger ones are multiplied block by block.
LARGE = 256
#: Pairs of a product that one task counts.
CELL = 1 << 22
#: Products in a block of the product matrix.
BLOCK = 2048


def copurchase(
    baskets: DataFrame, k: int = 10, basket: str = "order_id", item: str = "product_id", large: int = LARGE, block: int = BLOCK, cell: int = CELL
) -> DataFrame:
    """The k products that share most baskets with each product: ``item``, ``partner_id``, ``baskets`` (how many they share) and
    ``rank`` (ties by partner). Repeated rows of a basket count once, null baskets or products not at all; products that
    share no basket with another have no row. ``item`` is an integer.

    The counts are the product of the basket x product matrix with itself. An ordinary basket goes as one sorted list to the tasks
    of its products, which count the partners in all lists (``pair_counts``): at most ``large`` for each bought row. Of a larger
    basket the pairs are never listed: its products fall into blocks, each pair of blocks is one task group that multiplies the two
    parts of the matrix over all large baskets, adds the counts that ordinary baskets gave the same pairs, and returns its k best
    partners per product. So a basket with a third of all rows is spread over (products / block)² groups. Pairs with a product
    that no larger basket holds need no block, and of them an ordinary count gives only the k best. Purchases and lists are
    written once to the shared folder; products in large baskets and the pairs of ordinary baskets are counted while the plan is built.
    """
    bought = stage(baskets.select(F.col(basket).alias("basket"), F.col(item).cast("long").alias("item")).dropna().distinct(), "bought")
    sized = bought.withColumn("size", F.count("*").over(W.partitionBy("basket"))).where("size > 1")
    part = F.when(F.col("size") > large, F.pmod(F.xxhash64("item"), F.ceil(F.col("size") / large)))  # no list outgrows its row
    listed = stage(sized.groupBy("basket", "size", part.alias("part")).agg(F.sort_array(F.collect_list("item")).alias("items")).drop("part"), "baskets")
    wide = listed.where(F.col("size") > large).select("basket", F.explode("items").alias("item"))
    products = wide.select("item").distinct()
    blocks = -(-products.count() // block)
    ordinary = listed.where(F.col("size") <= large).select("basket", "size", "items")
    if blocks:
        each = ordinary.select("basket", F.explode("items").alias("item")).join(products.withColumn("mark", F.lit(True)), "item", "left")
        marked = F.sort_array(F.collect_list(F.struct("item", F.coalesce("mark", F.lit(False)).alias("mark"))))
        ordinary = stage(each.groupBy("basket").agg(marked.alias("all")), "baskets").select("basket", F.size("all").alias("size"), F.col("all.item").alias("items"), F.col("all.mark").alias("marks"))
    best = pairs = counted(ordinary.drop("basket"), k, cell)
    if blocks:
        inside = products.withColumn("place", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
        mine, theirs = inside.withColumnRenamed("place", "i"), inside.select(F.col("item").alias("partner"), F.col("place").alias("j"))
        placed = pairs.join(mine, "item", "left").join(theirs, "partner", "left")
        members = wide.join(inside, "item")
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        none = F.lit(None).cast("long")
        code = F.xxhash64("basket")
        rows = (
            members.select(F.col("place").alias("i"), every.alias("j"), "item", none.alias("partner"), code.alias("basket"), none.alias("n"))
            .unionByName(members.select(every.alias("i"), F.col("place").alias("j"), none.alias("item"), F.col("item").alias("partner"), code.alias("basket"), none.alias("n")))
            .unionByName(placed.where("i IS NOT NULL AND j IS NOT NULL").select("i", "j", "item", "partner", none.alias("basket"), "n"))
        )
        both = rows.groupBy("i", "j").applyInPandas(_multiply(k), "item long, partner long, n long")
        best = placed.where("i IS NULL OR j IS NULL").select("item", "partner", "n").unionByName(both)
    ranked = top_per_group(best, ["item"], [F.desc("n"), F.col("partner")], k, rank="rank")
    return ranked.select(F.col("item").alias(item), F.col("partner").alias("partner_id"), F.col("n").alias("baskets"), "rank")


def _multiply(k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows.partner.isna()], rows[rows.item.isna()]
        items, a = np.unique(left.item.to_numpy(np.int64), return_inverse=True)
        partners, b = np.unique(right.partner.to_numpy(np.int64), return_inverse=True)
        if not len(items) or not len(partners):
            return pd.DataFrame({"item": [], "partner": [], "n": []}).astype("int64")
        shared = np.intersect1d(left.basket.to_numpy(np.int64), right.basket.to_numpy(np.int64))
        counts = np.zeros((len(items), len(partners)), np.float64)
        of = lambda side: np.searchsorted(shared, side.basket.to_numpy(np.int64))
        at, to = of(left), of(right)
        hit, met = np.isin(left.basket.to_numpy(np.int64), shared), np.isin(right.basket.to_numpy(np.int64), shared)
        for first in range(0, len(shared), 1024):
            x, y = np.zeros((len(items), 1024), np.float32), np.zeros((len(partners), 1024), np.float32)
            own, other = hit & (at >= first) & (at < first + 1024), met & (to >= first) & (to < first + 1024)
            x[a[own], at[own] - first] = 1
            y[b[other], to[other] - first] = 1
            counts += x @ y.T
        more = rows[rows.basket.isna()]
        np.add.at(counts, (np.searchsorted(items, more.item.to_numpy(np.int64)), np.searchsorted(partners, more.partner.to_numpy(np.int64))), more.n.to_numpy(np.float64))
        counts[items[:, None] == partners[None, :]] = 0
        kept = np.argsort(-counts, axis=1, kind="stable")[:, :k]  # partners ascend, so ties stay in their order
        n = np.take_along_axis(counts, kept, 1).ravel().astype(np.int64)
        out = pd.DataFrame({"item": np.repeat(items, kept.shape[1]), "partner": partners[kept.ravel()], "n": n})
        return out[out.n > 0]

    return multiply
