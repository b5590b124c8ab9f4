"""The given tables in the roles of the four datasets, in Spark and in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.specs import FACT, FULL, VERSIONED, Dataset, columns

# Three delivery dates; the cuts divide each whole table into three deliveries.
BATCHES = (date(2024, 1, 10), date(2024, 1, 20), date(2024, 1, 30))
ORDER_CUTS = ("1998-01-01", "2000-01-01")
EVENT_CUTS = ("2024-01-11", "2024-01-21")
SHIP_CUTS = ("1998-01-01", "2000-01-01")

_MICROS = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}

PLANS = Dataset(
    name="price_plans",
    schema=columns(
        {
            "price_plan_id": "long",
            "price_plan_name": "string",
            "price": "decimal(18,2)",
            "payment_period": "string",
            "price_plan_type": "string",
            "plan_size": "integer",
        }
    ),
    load=FULL,
    keys=("price_plan_id",),
    required=("price_plan_id", "price_plan_name"),
)

SUBS = Dataset(
    name="subscriptions",
    schema=columns(
        {
            "user_id": "long",
            "subs_id": "string",
            "version_id": "long",
            "start_ts": "timestamp_ntz",
            "cancel_ts": "timestamp_ntz",
        }
    ),
    load=VERSIONED,
    keys=("user_id", "subs_id"),
    version_order="start_ts",
    ties=("version_id",),
    active="cancel_ts IS NULL",
    required=("user_id", "subs_id"),
    csv_options=_MICROS,
)

TX = Dataset(
    name="transactions",
    schema=columns(
        {
            "transaction_id": "long",
            "subs_id": "long",
            "user_id": "long",
            "price_plan_id": "integer",
            "amount": "decimal(18,2)",
            "created_ts": "timestamp_ntz",
            "tx_status": "string",
        }
    ),
    load=FACT,
    required=("transaction_id",),
    partition_by=("price_plan_id",),
    csv_options=_MICROS,
)

USERS = Dataset(
    name="users",
    schema=columns(
        {
            "user_id": "long",
            "version_id": "long",
            "updated_ts": "timestamp_ntz",
            "event_type": "string",
            "score": "double",
            "is_active": "boolean",
        }
    ),
    load=VERSIONED,
    keys=("user_id",),
    version_order="updated_ts",
    ties=("version_id",),
    active="is_active",
    required=("user_id", "is_active"),
    csv_options=_MICROS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("price_plan_id"),
        F.col("p_name").alias("price_plan_name"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        F.col("p_type").alias("payment_period"),
        F.col("p_brand").alias("price_plan_type"),
        F.col("p_size").alias("plan_size"),
    )


def subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("subs_id"),
        F.col("o_orderkey").alias("version_id"),
        F.col("o_orderdate").alias("start_ts"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("cancel_ts"),
    )


def tx(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("subs_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_linenumber").alias("price_plan_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_shipdate").alias("created_ts"),
        F.col("l_returnflag").alias("tx_status"),
        *more,
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_id").alias("version_id"),
        F.col("ts").alias("updated_ts"),
        "event_type",
        F.col("value").alias("score"),
        (F.col("event_type") != "error").alias("is_active"),
    )


def deliveries(df: DataFrame, order: str, cuts: tuple[str, str]) -> list[DataFrame]:
    """The whole table as three deliveries; rows without a date come first."""
    first, second = (F.lit(c).cast("timestamp_ntz") for c in cuts)
    when = F.col(order)
    return [
        df.where(F.coalesce(when < first, F.lit(True))),
        df.where((when >= first) & (when < second)),
        df.where(when >= second),
    ]


PLANS_SQL = """SELECT p_partkey AS price_plan_id, p_name AS price_plan_name,
  CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_type AS payment_period,
  p_brand AS price_plan_type, p_size AS plan_size FROM part"""

SUBS_SQL = """SELECT o_custkey AS user_id, o_orderpriority AS subs_id, o_orderkey AS version_id,
  o_orderdate AS start_ts, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS cancel_ts FROM orders"""

TX_SQL = """SELECT l_orderkey AS transaction_id, l_partkey AS subs_id, l_suppkey AS user_id,
  l_linenumber AS price_plan_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  l_shipdate AS created_ts, l_returnflag AS tx_status FROM lineitem"""

USERS_SQL = """SELECT user_id, event_id AS version_id, ts AS updated_ts, event_type, value AS score,
  event_type <> 'error' AS is_active FROM events"""


def batch_sql(order: str, cuts: tuple[str, str]) -> str:
    """The delivery date of a row, as :func:`deliveries` divides the table."""
    first, second, third = BATCHES
    return (
        f"CASE WHEN {order} >= TIMESTAMP '{cuts[1]} 00:00:00' THEN DATE '{third}' "
        f"WHEN {order} >= TIMESTAMP '{cuts[0]} 00:00:00' THEN DATE '{second}' ELSE DATE '{first}' END"
    )


SUBS_BATCH = batch_sql("start_ts", ORDER_CUTS)
USERS_BATCH = batch_sql("updated_ts", EVENT_CUTS)
TX_BATCH = batch_sql("created_ts", SHIP_CUTS)


def history_sql(source: str, spec: Dataset, batch: str) -> str:
    """Every version with its interval and status, from all deliveries at once."""
    keys = ", ".join(spec.keys)
    order = ", ".join((spec.version_order, *spec.ties))
    named = ", ".join(spec.schema.names)
    return f"""
WITH delivered AS (SELECT v.*, {batch} AS b FROM ({source}) v),
followed AS (SELECT *, LEAD(b) OVER (PARTITION BY {keys} ORDER BY {order}) AS nb FROM delivered),
history AS (SELECT {named}, b AS eff_start_date,
  CASE WHEN {spec.active} THEN nb ELSE b END AS eff_end_date FROM followed)
SELECT *, CASE WHEN eff_end_date IS NULL THEN 'current' ELSE 'closed' END AS status FROM history"""
