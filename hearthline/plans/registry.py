"""Named queries over a data directory, each with the SQL it must equal (or none)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hearthline.operators import dims, experiments, facts, gold
from hearthline.plans.fixtures import AS_OF, AS_OF_TS, TZ, Fixtures
from hearthline.plans.oracle import sql

Build = Callable[["Inputs"], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


class Inputs(Fixtures):
    """Fixtures, and the silver and gold tables derived from them."""

    @cached_property
    def message_fact(self) -> DataFrame:
        return facts.message_fact(self.messages, AS_OF_TS, TZ)

    @cached_property
    def voice_fact(self) -> DataFrame:
        return facts.voice_chat_fact(self.voice, AS_OF_TS, TZ, id="raw")

    @cached_property
    def guild_dim(self) -> DataFrame:
        return dims.guild_dim(self.channels)

    @cached_property
    def category_dim(self) -> DataFrame:
        return dims.category_dim(self.channels)

    @cached_property
    def channel_dim(self) -> DataFrame:
        return dims.channel_dim(self.channels)

    @cached_property
    def user_dim(self) -> DataFrame:
        return dims.user_dim(self.messages, self.voice)

    @cached_property
    def weekday_hour(self) -> DataFrame:
        return gold.activity_by_weekday_hour(self.message_fact, self.voice_fact, self.guild_dim, TZ)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.activity_daily(self.message_fact, self.voice_fact, self.guild_dim, TZ)

    @cached_property
    def user_activity(self) -> DataFrame:
        return gold.user_activity(self.message_fact, self.voice_fact, self.user_dim, self.guild_dim)

    @cached_property
    def channel_activity(self) -> DataFrame:
        return gold.channel_activity(self.message_fact, self.voice_fact, self.channel_dim, self.category_dim, self.guild_dim)

    @cached_property
    def voice_summary(self) -> DataFrame:
        return gold.user_voice_summary(self.voice_fact, self.user_dim, self.guild_dim, AS_OF, TZ)

    @cached_property
    def churn(self) -> DataFrame:
        """A risk for every order, also for those without a prediction."""
        risk = F.round(1 - (F.col("o_orderkey") % 100).cast("double") / 100, 2)
        return self.table("orders").select(F.col("o_orderkey").alias("opportunity_id"), risk.alias("churn_risk_score"))

    @cached_property
    def ab_tests(self) -> DataFrame:
        return experiments.ab_assign(self.ab_units, "test_2001", "2001-01-15", 0.5, ["account_id", "product_id"])

    @cached_property
    def ab_results(self) -> DataFrame:
        return experiments.ab_attribute(self.ab_tests, self.opportunities)


def tidy(df: DataFrame, digits: int = 6, special: dict[str, int] | None = None) -> DataFrame:
    """Rounded floats and 64-bit integers, so that two engines can be compared value by value."""
    def column(f: T.StructField):
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            return F.round(F.col(f.name).cast("double"), (special or {}).get(f.name, digits)).alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            return F.col(f.name).cast("bigint").alias(f.name)
        return F.col(f.name)

    return df.select(*[column(f) for f in df.schema])


def query(name: str, oracle: str | None = None, floats: str = "", ints: str = "", digits: int = 6) -> Callable[[Build], Build]:
    """Register a query. ``oracle`` is SQL over the views; its ``floats`` (``name`` or ``name:digits``) are
    rounded and its ``ints`` cast to BIGINT as ``tidy`` does on the Spark side."""
    places = {n: int(d or digits) for n, _, d in (f.partition(":") for f in floats.split())}

    def register(build: Build) -> Build:
        QUERIES[name] = lambda c: tidy(build(c), digits, places)
        if oracle is not None:
            fixed = [f"round(CAST({c} AS DOUBLE), {d}) AS {c}" for c, d in places.items()]
            fixed += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
            ORACLES[name] = sql(f"SELECT * REPLACE ({', '.join(fixed)}) FROM ({oracle})" if fixed else oracle)
        return build

    return register


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](Inputs(spark, sf_dir))
