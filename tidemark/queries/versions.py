"""Queries for the operators over versions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.functions import newest_first
from tidemark.queries.registry import query
from tidemark.queries.standins import SUBS, SUBS_SQL, USERS, USERS_SQL, history_sql, subs, table, users
from tidemark.specs import EFF_START, Dataset

STEP_DATE = date(2024, 2, 1)
SUBS_CUT = "2000-01-01"
USERS_CUT = "2024-01-15"


@query(f"SELECT *, DATE '{STEP_DATE}' AS eff_start_date, CAST(NULL AS DATE) AS eff_end_date FROM ({SUBS_SQL}) v")
def stamp_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.stamp_open(subs(spark, sf_dir), STEP_DATE)


@query(SUBS_SQL)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves by activity, the second with its columns in another order."""
    versions = subs(spark, sf_dir)
    incoming = op.active_rows(versions, SUBS).select(*reversed(versions.columns))
    return op.union_by_name(op.inactive_rows(versions, SUBS), incoming)


@query(SUBS_SQL)
def union_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half brings its cancellation as text, some of which is no timestamp."""
    versions = subs(spark, sf_dir)
    later = F.col("start_ts") >= F.lit(SUBS_CUT).cast("timestamp_ntz")
    text = F.coalesce(F.col("cancel_ts").cast("string"), F.lit("not cancelled"))
    return op.union_by_name(versions.where(~later), versions.where(later).withColumn("cancel_ts", text))


@query(f"""SELECT user_id, subs_id, version_id, start_ts,
  CASE WHEN start_ts >= TIMESTAMP '{SUBS_CUT} 00:00:00' AND version_id % 10 = 0 THEN NULL ELSE cancel_ts END AS cancel_ts,
  CASE WHEN start_ts >= TIMESTAMP '{SUBS_CUT} 00:00:00' AND version_id % 10 = 0 THEN 'cancel_ts is no timestamp_ntz: soon' END AS reason
FROM ({SUBS_SQL}) v""")
def union_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half brings its cancellation as text; rows in which that is no timestamp are told apart, not closed."""
    versions = subs(spark, sf_dir).withColumn("reason", F.lit(None).cast("string"))
    later = F.col("start_ts") >= F.lit(SUBS_CUT).cast("timestamp_ntz")
    text = F.when(F.col("version_id") % 10 == 0, F.lit("soon")).otherwise(F.col("cancel_ts").cast("string"))
    incoming = versions.where(later).withColumn("cancel_ts", text).drop("reason")
    return op.union_by_name(versions.where(~later), op.with_misfits(incoming, SUBS.schema, SUBS.decisive, "reason"))


def _ranked(source: str, spec: Dataset, condition: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {", ".join(spec.keys)}
  ORDER BY {spec.version_order} DESC NULLS LAST, version_id DESC) AS rn FROM ({source}) v) r WHERE {condition}"""


@query(_ranked(SUBS_SQL, SUBS, "rn = 1"))
def latest_per_key_2col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_per_key(subs(spark, sf_dir), SUBS.keys, newest_first(SUBS, None))


@query(_ranked(USERS_SQL, USERS, "rn = 1"))
def latest_per_key_1col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_per_key(users(spark, sf_dir), USERS.keys, newest_first(USERS, None))


@query(_ranked(SUBS_SQL, SUBS, "rn > 1"))
def superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = subs(spark, sf_dir)
    counts = op.count_keys(versions, SUBS.keys)
    return op.superseded(versions, SUBS.keys, newest_first(SUBS, None), counts)


@query(f"SELECT * FROM ({SUBS_SQL}) v WHERE cancel_ts IS NULL")
def filter_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.active_rows(subs(spark, sf_dir), SUBS)


@query(f"SELECT * FROM ({SUBS_SQL}) v WHERE cancel_ts IS NOT NULL")
def filter_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.inactive_rows(subs(spark, sf_dir), SUBS)


@query(f"SELECT * FROM ({USERS_SQL}) v WHERE is_active")
def filter_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.active_rows(users(spark, sf_dir), USERS)


@query(f"SELECT * FROM ({USERS_SQL}) v WHERE NOT is_active")
def filter_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.inactive_rows(users(spark, sf_dir), USERS)


def _parts(versions: DataFrame, spec: Dataset, cut: str) -> tuple[DataFrame, DataFrame]:
    """All versions before the cut give the snapshot, all others are the delivery."""
    before = F.col(spec.version_order) < F.lit(cut).cast("timestamp_ntz")
    latest = op.latest_per_key(versions.where(before), spec.keys, newest_first(spec, None))
    existing = op.active_rows(latest, spec).withColumns(
        {EFF_START: F.col(spec.version_order).cast("date"), "eff_end_date": F.lit(None).cast("date")}
    )
    return existing, versions.where(~F.coalesce(before, F.lit(False)))


def _step(versions: DataFrame, spec: Dataset, cut: str, **limits: object) -> DataFrame:
    return op.step(*_parts(versions, spec, cut), spec, STEP_DATE, **limits)


def _step_sql(source: str, spec: Dataset, cut: str) -> str:
    keys, order = ", ".join(spec.keys), f"{spec.version_order} DESC NULLS LAST, version_id DESC"
    names = ", ".join(spec.schema.names)
    rank = f"ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn"
    return f"""
WITH v AS ({source}),
existing AS (SELECT {names}, CAST({spec.version_order} AS DATE) AS eff_start_date, CAST(NULL AS DATE) AS eff_end_date
  FROM (SELECT *, {rank} FROM v WHERE {spec.version_order} < TIMESTAMP '{cut} 00:00:00') x
  WHERE rn = 1 AND {spec.active}),
incoming AS (SELECT {names}, DATE '{STEP_DATE}' AS eff_start_date, CAST(NULL AS DATE) AS eff_end_date
  FROM v WHERE {spec.version_order} >= TIMESTAMP '{cut} 00:00:00'),
ranked AS (SELECT *, {rank} FROM (SELECT * FROM existing UNION ALL SELECT * FROM incoming) u)
SELECT {names}, eff_start_date,
  CASE WHEN rn = 1 AND {spec.active} THEN eff_end_date ELSE DATE '{STEP_DATE}' END AS eff_end_date,
  CASE WHEN rn = 1 AND {spec.active} THEN 'current' ELSE 'closed' END AS status
FROM ranked"""


@query(_step_sql(SUBS_SQL, SUBS, SUBS_CUT))
def scd2_step_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step(subs(spark, sf_dir), SUBS, SUBS_CUT)


@query(_step_sql(USERS_SQL, USERS, USERS_CUT))
def scd2_step_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step(users(spark, sf_dir), USERS, USERS_CUT)


@query(_step_sql(SUBS_SQL, SUBS, SUBS_CUT))
def scd2_step_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step in which a list of the delivered keys keeps all other stored rows out of the shuffle."""
    return _step(subs(spark, sf_dir), SUBS, SUBS_CUT, touched_only=True)


@query(_step_sql(SUBS_SQL, SUBS, SUBS_CUT))
def scd2_step_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a bitmap, since the list is held to be too large."""
    existing, incoming = _parts(subs(spark, sf_dir), SUBS, SUBS_CUT)
    counts = op.count_keys(incoming, SUBS.keys)
    limit = 16 * max(64, counts.total_keys)
    return op.step(existing, incoming, SUBS, STEP_DATE, counts, touched_only=True, broadcast_bytes=limit)


@query(_step_sql(USERS_SQL, USERS, USERS_CUT))
def scd2_step_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step in which keys with more than four delivered rows are ranked in parts."""
    return _step(users(spark, sf_dir), USERS, USERS_CUT, rows_per_task=4)


@query(_step_sql(USERS_SQL, USERS, USERS_CUT))
def scd2_step_split_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step(users(spark, sf_dir), USERS, USERS_CUT, rows_per_task=4, touched_only=True)


@query(history_sql(USERS_SQL, USERS, "CAST(updated_ts AS DATE)"))
def scd2_rebuild_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per calendar day, the whole history at once."""
    versions = users(spark, sf_dir).withColumn("delivered", F.col("updated_ts").cast("date"))
    return op.rebuild(versions, USERS, "delivered")


@query(history_sql(SUBS_SQL, SUBS, "CAST(start_ts AS DATE)"))
def scd2_rebuild_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = subs(spark, sf_dir).withColumn("delivered", F.col("start_ts").cast("date"))
    return op.rebuild(versions, SUBS, "delivered")


# Deliveries in an order that has nothing to do with the versions: thirty batches by a rule on the version.
LATE_SQL = "DATE '2024-01-01' + CAST(version_id * 7919 % 30 AS INTEGER)"


def any_order(versions: DataFrame) -> DataFrame:
    days = (F.col("version_id") * 7919 % 30).cast("int")
    return versions.withColumn("delivered", F.date_add(F.lit(date(2024, 1, 1)), days))


def any_order_sql(source: str, spec: Dataset, batch: str) -> str:
    """The history of deliveries in any order.

    Of a key's rows in a batch the newest may outlive it.  It ends where the next newer one comes, and never lives
    if an older batch's active one, newer than it, has not ended by then.
    """
    keys, names = ", ".join(spec.keys), ", ".join(f"x.{n}" for n in spec.schema.names)
    same = " AND ".join(f"x.{k} IS NOT DISTINCT FROM y.{k}" for k in spec.keys)
    return f"""
WITH delivered AS (SELECT v.*, {batch} AS b FROM ({source}) v),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {spec.version_order} NULLS FIRST, version_id, b) AS rk FROM delivered),
led AS (SELECT *, rk = MAX(rk) OVER (PARTITION BY {keys}, b) AS leads FROM ranked),
ends AS (SELECT {", ".join(f"x.{k}" for k in spec.keys)}, x.rk, x.b, ({spec.active}) AS lives,
  (SELECT MIN(y.b) FROM led y WHERE {same} AND y.leads AND y.b > x.b AND y.rk > x.rk) AS nb FROM led x WHERE x.leads),
judged AS (SELECT {names}, x.b, y.nb, coalesce(y.lives, false) AND NOT EXISTS (SELECT 1 FROM ends z
    WHERE {same.replace("x.", "z.").replace("y.", "x.")} AND z.lives AND z.b < x.b AND z.rk > x.rk AND (z.nb IS NULL OR z.nb > x.b)) AS lived
  FROM led x LEFT JOIN ends y ON {same} AND x.rk = y.rk)
SELECT * EXCLUDE (b, nb, lived), b AS eff_start_date, CASE WHEN lived THEN nb ELSE b END AS eff_end_date,
  CASE WHEN lived AND nb IS NULL THEN 'current' ELSE 'closed' END AS status FROM judged"""


@query(any_order_sql(USERS_SQL, USERS, LATE_SQL))
def scd2_rebuildany_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that arrive long after newer ones, and after their key was closed."""
    return op.rebuild(any_order(users(spark, sf_dir)), USERS, "delivered")


@query(any_order_sql(SUBS_SQL, SUBS, LATE_SQL))
def scd2_rebuild_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where keys with more than two rows are ranked in parts."""
    return op.rebuild(any_order(subs(spark, sf_dir)), SUBS, "delivered", rows_per_task=2)


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as payments of the subscription that their order belongs to."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("subs_id"))
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_shipdate").alias("paid_ts"),
    )
    return items.join(orders, "o_orderkey").select("user_id", "subs_id", F.col("o_orderkey").alias("order_id"), "line", "amount", "paid_ts")


_PAYMENTS_SQL = """SELECT o_custkey AS user_id, o_orderpriority AS subs_id, o_orderkey AS order_id, l_linenumber AS line,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_shipdate AS paid_ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_VALID_SQL = f"""SELECT f.*, h.version_id, h.eff_start_date, h.eff_end_date FROM ({_PAYMENTS_SQL}) f
LEFT JOIN ({history_sql(SUBS_SQL, SUBS, "CAST(start_ts AS DATE)")}) h
  ON h.user_id = f.user_id AND h.subs_id = f.subs_id AND h.eff_start_date <= CAST(f.paid_ts AS DATE)
  AND (h.eff_end_date IS NULL OR h.eff_end_date > CAST(f.paid_ts AS DATE))"""


def _valid(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    versions = subs(spark, sf_dir).withColumn("delivered", F.col("start_ts").cast("date"))
    payments = _payments(spark, sf_dir)
    found = op.with_version(payments, op.rebuild(versions, SUBS, "delivered"), SUBS, "paid_ts", **limits)
    return found.select(*payments.columns, "version.version_id", "version.eff_start_date", "version.eff_end_date")


@query(_VALID_SQL)
def transactions_with_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payment with the version of its subscription that was valid on its day, if any."""
    return _valid(spark, sf_dir)


@query(_VALID_SQL)
def transactions_with_version_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where subscriptions with more than ten payments are dealt into lanes."""
    return _valid(spark, sf_dir, rows_per_task=10)


_RULES_SQL = """SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, l_suppkey AS supplier_id,
  CASE WHEN COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'repeated order_id, line'
       WHEN l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) THEN 'unknown part'
       WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) THEN 'unknown supplier' END AS reason
FROM lineitem"""


def _by_rules(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    """Line items against each other, against parts that are not too large, and against suppliers in credit."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"), F.lit(None).cast("string").alias("reason"),
    )
    parts, suppliers = table(spark, sf_dir, "part").where("p_size <= 40"), table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    rows = op.flag_repeated(rows, ["order_id", "line"], "reason", **limits)
    rows = op.flag_unknown(rows, ["part_id"], parts, ["p_partkey"], "reason", "unknown part", **limits)
    return op.flag_unknown(rows, ["supplier_id"], suppliers, ["s_suppkey"], "reason", "unknown supplier", **limits)


@query(_RULES_SQL)
def cross_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_rules(spark, sf_dir)


@query(_RULES_SQL)
def cross_rules_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where no list is short enough to be sent to every task, and frequent values are split off."""
    return _by_rules(spark, sf_dir, limit=0, rows_per_task=50)
