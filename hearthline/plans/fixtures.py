"""Community and sales inputs as projections of the driver's tables (see FIXTURES.md, section D)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthline.schemas import ddl

AS_OF = "2024-02-01"
AS_OF_TS = "2024-02-01 00:00:00"
SALES_AS_OF = "2001-08-02"
TZ = "Asia/Tokyo"

# Declared schemas spare a footer-reading job per table.
TABLES = {
    "region": ddl("r_regionkey INT, r_name STRING"),
    "nation": ddl("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "customer": ddl("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
    "supplier": ddl("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"),
    "part": ddl("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"),
    "orders": ddl(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": ddl(
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": ddl("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"),
    "conversations": ddl("conv_id BIGINT, turn BIGINT, role STRING, text STRING"),
    "documents": ddl("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"),
}


CHAT_COLUMNS = [
    "CAST(100 + event_id % 25 AS STRING) AS channel_id",
    "CASE WHEN event_id % 25 >= 22 THEN NULL ELSE 10 + (event_id % 25) % 5 END AS category_id",
    "CAST(1 + (event_id % 25) % 3 AS STRING) AS guild_id",
    "CAST(user_id AS STRING) AS user_id",
    "CONCAT('user_', CAST(user_id % 120 AS STRING)) AS user_name",
]


class Fixtures:
    """Lazy inputs over one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def messages(self) -> DataFrame:
        return self.table("events").filter("event_type IN ('click', 'view', 'error')").selectExpr(
            "CAST(event_id AS STRING) AS message_id",
            *CHAT_COLUMNS,
            "props AS content",
            "ts AS timestamp",
            "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 3 AS INT) END AS attachment_count",
            "CAST(event_id % 4 AS INT) AS reaction_count",
            "event_id % 11 = 0 AS is_pinned",
        )

    @cached_property
    def dirty_messages(self) -> DataFrame:
        """Messages with unreadable and missing ids, and second copies whose time cannot be read."""
        number = F.col("message_id").cast("bigint")
        bad = F.when(number % 31 == 0, F.concat(F.lit("bad-"), "message_id")).when(number % 37 != 0, F.col("message_id"))
        text = self.messages.withColumn("timestamp", F.col("timestamp").cast("string"))
        copies = text.filter((number % 29 == 0) & (number % 31 != 0) & (number % 37 != 0)).withColumns(
            {"timestamp": F.lit("soon"), "content": F.lit("worse copy")}
        )
        return text.withColumn("message_id", bad).unionByName(copies)

    @cached_property
    def voice(self) -> DataFrame:
        return self.table("events").filter("event_type IN ('purchase', 'signup')").selectExpr(
            "CONCAT(CAST(user_id AS STRING), '_', CAST(event_id AS STRING)) AS session_id",
            *CHAT_COLUMNS,
            "ts AS joined_at",
            """CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ts - INTERVAL 600 SECONDS
               WHEN event_id % 83 = 0 THEN ts + INTERVAL 30 HOURS
               ELSE ts + make_dt_interval(0, 0, 0, CAST(floor(value * 60) AS INT)) END AS left_at""",
        )

    @cached_property
    def channels(self) -> DataFrame:
        """Two daily snapshots of channels and categories; one category is renamed in between."""
        snaps = "explode(array('2024-01-30', '2024-01-31')) AS snapshot_date"
        plain = self.table("nation").selectExpr("*", snaps).selectExpr(
            "snapshot_date",
            "CAST(1 + n_nationkey % 3 AS STRING) AS guild_id",
            "CONCAT('guild_', CAST(1 + n_nationkey % 3 AS STRING)) AS guild_name",
            "CAST(100 + n_nationkey AS STRING) AS channel_id",
            "CASE WHEN n_nationkey % 4 = 3 THEN 2 WHEN n_nationkey % 4 = 2 THEN 5 ELSE 0 END AS channel_type",
            "n_name AS channel_name",
            "CAST(CASE WHEN n_nationkey >= 22 THEN NULL ELSE 10 + n_nationkey % 5 END AS BIGINT) AS category_id",
        )
        categories = self.table("region").selectExpr("*", snaps).selectExpr(
            "snapshot_date",
            "'1' AS guild_id",
            "'guild_1' AS guild_name",
            "CAST(10 + r_regionkey AS STRING) AS channel_id",
            "4 AS channel_type",
            "CASE WHEN snapshot_date = '2024-01-30' AND r_regionkey = 0 THEN 'OLD NAME' ELSE r_name END AS channel_name",
            "CAST(NULL AS BIGINT) AS category_id",
        )
        # member-made channels: one per customer, with every fifth type a category that is renamed in between
        own = self.table("customer").selectExpr("*", snaps).selectExpr(
            "snapshot_date",
            "CAST(1 + c_nationkey % 3 AS STRING) AS guild_id",
            "CONCAT('guild_', CAST(1 + c_nationkey % 3 AS STRING)) AS guild_name",
            "CAST(1000000 + c_custkey AS STRING) AS channel_id",
            "CASE c_mktsegment WHEN 'BUILDING' THEN 4 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 5 ELSE 0 END AS channel_type",
            "IF(snapshot_date = '2024-01-30', CONCAT('zz ', c_name), c_name) AS channel_name",
            "IF(c_mktsegment = 'BUILDING', NULL, CAST(10 + c_nationkey % 5 AS BIGINT)) AS category_id",
        )
        return plain.unionByName(categories).unionByName(own)

    @cached_property
    def voice_events(self) -> DataFrame:
        """Join and leave events; channels without category send no joins."""
        who = ["guild_id", "user_id", "channel_id"]
        joins = self.voice.filter("category_id IS NOT NULL").selectExpr(*who, "'join' AS kind", "joined_at AS ts")
        leaves = self.voice.filter("left_at >= joined_at").selectExpr(*who, "'leave' AS kind", "left_at AS ts")
        return joins.unionByName(leaves)

    @cached_property
    def opportunities(self) -> DataFrame:
        customers = self.table("customer").join(self.table("nation"), F.expr("c_nationkey = n_nationkey"))
        return self.table("orders").join(customers, F.expr("o_custkey = c_custkey")).selectExpr(
            "o_orderkey AS opportunity_id",
            "o_custkey AS account_id",
            "o_totalprice AS amount",
            "o_orderstatus <> 'O' AS is_closed",
            "o_orderstatus = 'F' AS is_won",
            "CAST(o_orderdate AS DATE) AS created_date",
            "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 180 AS INT)) AS close_date",
            "o_orderpriority AS stage_name",
            "1 AS is_current",
            "n_name AS billing_state",
            "c_mktsegment AS industry",
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Orders of one priority have no prediction; every third prediction has a close date."""
        return self.table("orders").filter("o_orderpriority <> '4-NOT SPECIFIED'").selectExpr(
            "o_orderkey AS opportunity_id",
            "CAST(o_orderkey % 100 AS DOUBLE) / 100 AS win_probability",
            "IF(o_orderkey % 3 = 0, date_add(CAST(o_orderdate AS DATE), CAST(200 + o_orderkey % 300 AS INT)), NULL) AS predicted_close_date",
        )

    @cached_property
    def targets(self) -> DataFrame:
        """Monthly revenue targets: the amount of all opportunities due in the month."""
        return self.opportunities.groupBy(F.expr("trunc(close_date, 'MM')").alias("period")).agg(
            F.sum("amount").alias("target_revenue")
        )

    @cached_property
    def opportunity_history(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS opportunity_id", "l_returnflag AS stage_name", "l_extendedprice AS amount", "l_shipdate AS changed_at"
        )

    @cached_property
    def activities(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id AS account_id",
            "CASE event_type WHEN 'signup' THEN 'task' WHEN 'purchase' THEN 'meeting' ELSE 'event' END AS activity_type",
            "CAST(ts AS DATE) AS activity_date",
            "event_id % 3 = 0 AS is_open",
        )

    @cached_property
    def ab_units(self) -> DataFrame:
        return (
            self.table("orders").join(self.table("lineitem"), F.expr("o_orderkey = l_orderkey"))
            .selectExpr("o_custkey AS account_id", "l_partkey AS product_id")
            .distinct()
        )
