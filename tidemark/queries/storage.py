"""Queries that write deliveries or tables and read them back."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.batches import delivery_path
from tidemark.plans import Roots, backfill, load_fact, load_full, load_versions, rerun, run_batch
from tidemark.queries.registry import query
from tidemark.queries.standins import (
    BATCHES,
    EVENT_CUTS,
    ORDER_CUTS,
    PLANS,
    PLANS_SQL,
    SHIP_CUTS,
    SUBS,
    SUBS_BATCH,
    SUBS_SQL,
    TX,
    TX_BATCH,
    TX_SQL,
    USERS,
    USERS_BATCH,
    USERS_SQL,
    deliveries,
    history_sql,
    plans,
    subs,
    tx,
    users,
)
from tidemark.queries.versions import LATE_SQL, any_order, any_order_sql
from tidemark.session import prepare, work_folder
from tidemark.sinks import register_table, write_partitioned
from tidemark.sources import BatchTable, HeaderMismatch, check_header, land, read_checked, read_csv, read_landed, stored_table
from tidemark.sources.csv import REASON
from tidemark.sources.landing import landed_folder
from tidemark.sources.files import NO_VALUE
from tidemark.specs import BATCH, STATUS, Dataset
from tidemark.streaming import land_arrivals, run_flat_arrivals

FIRST, SECOND, THIRD = BATCHES


def _deliver(df: DataFrame, path: str, spec: Dataset) -> str:
    df.write.option("header", True).options(**spec.csv_options).csv(path)
    return path


@query(PLANS_SQL)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _deliver(plans(spark, sf_dir), work_folder(spark, "csv_scan"), PLANS)
    return read_csv(spark, path, PLANS)


@query(f"""SELECT price_plan_id, payment_period, price_plan_type, plan_size,
  CASE WHEN plan_size <> 1 THEN price_plan_name END AS price_plan_name,
  CASE WHEN plan_size <= 40 THEN price END AS price,
  CASE WHEN plan_size > 40 THEN 'malformed' WHEN plan_size = 1 THEN 'missing price_plan_name' END AS reason
FROM ({PLANS_SQL}) v""")
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large plans come without a readable price, the smallest without a name."""
    size = F.col("plan_size")
    spoiled = plans(spark, sf_dir).withColumns(
        {
            "price": F.when(size > 40, F.lit("on request")).otherwise(F.col("price").cast("string")),
            "price_plan_name": F.when(size != 1, F.col("price_plan_name")),
        }
    )
    rows = read_checked(spark, _deliver(spoiled, work_folder(spark, "csv_quarantine"), PLANS), PLANS)
    return rows.select(*PLANS.schema.names, F.col(REASON).alias("reason"))


@query(f"""SELECT 'declared' AS delivery, true AS accepted, CAST(count(*) AS BIGINT) AS n_rows, sum(price) AS price
FROM ({PLANS_SQL}) v
UNION ALL SELECT 'reordered', false, CAST(count(*) AS BIGINT), sum(price) FROM ({PLANS_SQL}) v""")
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, one with its columns out of order; the check says which may be loaded."""
    folder = work_folder(spark, "schema_check")
    rows = plans(spark, sf_dir)
    orders = {"declared": rows.columns, "reordered": rows.columns[1:] + rows.columns[:1]}
    reports = []
    for name, order in orders.items():
        path = _deliver(rows.select(*order), f"{folder}/{name}", PLANS)
        found, accepted = spark.read.option("header", True).csv(path), True
        try:
            check_header(spark, path, PLANS)
        except HeaderMismatch:
            accepted = False
        reports.append(
            found.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("price").cast("decimal(18,2)")).alias("price"))
            .withColumns({"delivery": F.lit(name), "accepted": F.lit(accepted)})
        )
    return reduce(DataFrame.unionByName, reports).withColumn("price", F.col("price").cast("decimal(38,2)"))


def _store(spark: SparkSession, spec: Dataset, parts: list[DataFrame], load, purpose: str) -> BatchTable:
    """Load deliveries in date order into a fresh table."""
    prepare(spark)
    table = stored_table(spark, work_folder(spark, purpose), spec)
    for batch_date, rows in zip(BATCHES, parts):
        load(table, rows, batch_date)
    return table


def _subs_table(spark: SparkSession, sf_dir: str, purpose: str) -> BatchTable:
    return _store(spark, SUBS, deliveries(subs(spark, sf_dir), "start_ts", ORDER_CUTS), load_versions, purpose)


def _users_table(spark: SparkSession, sf_dir: str, purpose: str) -> BatchTable:
    return _store(spark, USERS, deliveries(users(spark, sf_dir), "updated_ts", EVENT_CUTS), load_versions, purpose)


def _tx_table(spark: SparkSession, sf_dir: str, purpose: str) -> BatchTable:
    return _store(spark, TX, deliveries(tx(spark, sf_dir), "created_ts", SHIP_CUTS), load_fact, purpose)


@query(f"SELECT v.*, {TX_BATCH} AS batch_dt FROM ({TX_SQL}) v")
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored batches through the declared schema."""
    table = _tx_table(spark, sf_dir, "snapshot_scan")
    return table.read(table.batches())


@query(f"""WITH delivered AS (SELECT {TX_BATCH} AS batch_dt, * FROM ({TX_SQL}) v),
sizes AS (SELECT batch_dt, count(*) AS n FROM delivered GROUP BY batch_dt)
SELECT a.batch_dt, b.batch_dt AS previous_dt, CAST(coalesce(b.n, 0) AS BIGINT) AS previous_rows
FROM sizes a LEFT JOIN sizes b
  ON b.batch_dt = (SELECT max(c.batch_dt) FROM sizes c WHERE c.batch_dt < a.batch_dt)""")
def previous_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every stored batch the one before it, and how many rows that holds."""
    table = _tx_table(spark, sf_dir, "previous_batch")
    reports = []
    for batch_date in table.batches():
        previous = table.previous(batch_date)
        rows = table.read([] if previous is None else [previous])
        reports.append(
            rows.agg(F.count(F.lit(1)).alias("previous_rows")).withColumns(
                {"batch_dt": F.lit(batch_date), "previous_dt": F.lit(previous).cast("date")}
            )
        )
    return reduce(DataFrame.unionByName, reports)


@query(PLANS_SQL.replace("p_retailprice AS", "p_retailprice * 2 AS"))
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of all plans; the table shows the second, with prices doubled."""
    first = plans(spark, sf_dir)
    second = first.withColumn("price", (F.col("price") * 2).cast("decimal(18,2)"))
    table = _store(spark, PLANS, [first, second], load_full, "full_refresh")
    return table.read([table.newest()]).select(*PLANS.schema.names)


@query(f"SELECT v.*, {TX_BATCH} AS batch_dt FROM ({TX_SQL}) v")
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _tx_table(spark, sf_dir, "fact_load")
    return table.read(list(BATCHES))


@query(f"""SELECT price_plan_id, tx_status, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(sum(amount) AS DECIMAL(38,2)) AS amount FROM ({TX_SQL}) v GROUP BY price_plan_id, tx_status""")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One directory per plan, read back as partitions."""
    path = work_folder(spark, "partitioned_write")
    write_partitioned(tx(spark, sf_dir), path, ["price_plan_id"])
    rows = spark.read.schema(TX.schema).parquet(path)
    return rows.groupBy("price_plan_id", "tx_status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("decimal(38,2)").alias("amount")
    )


@query(f"SELECT * EXCLUDE (status) FROM ({history_sql(SUBS_SQL, SUBS, SUBS_BATCH)}) h WHERE status = 'current'")
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subs_table(spark, sf_dir, "scd2_current").current()


@query(f"SELECT * FROM ({history_sql(SUBS_SQL, SUBS, SUBS_BATCH)}) h WHERE status = 'closed'")
def scd2_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _subs_table(spark, sf_dir, "scd2_closed")
    return table.history().where(F.col(STATUS) == "closed")


@query(history_sql(USERS_SQL, USERS, USERS_BATCH))
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users_table(spark, sf_dir, "scd2_history").history()


@query(f"""SELECT * EXCLUDE (status) FROM ({history_sql(USERS_SQL, USERS, USERS_BATCH)}) h
WHERE eff_start_date <= DATE '{SECOND}' AND (eff_end_date IS NULL OR eff_end_date > DATE '{SECOND}')""")
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users_table(spark, sf_dir, "scd2_as_of").as_of(SECOND)


def _snapshot_sql(source: str, spec: Dataset, batch: str, day: date) -> str:
    return f"""SELECT * FROM ({history_sql(source, spec, batch)}) h
WHERE eff_start_date <= DATE '{day}' AND (eff_end_date IS NULL OR eff_end_date > DATE '{day}')"""


@query(f"""SELECT * EXCLUDE (status) FROM ({history_sql(USERS_SQL, USERS, USERS_BATCH)}) h
WHERE eff_start_date <= DATE '{FIRST}' AND (eff_end_date IS NULL OR eff_end_date > DATE '{FIRST}')""")
def scd2_as_of_filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read as of the first day from a table whose closed versions are filed by the days they were valid."""
    parts = deliveries(users(spark, sf_dir), "updated_ts", EVENT_CUTS)
    return _store(spark, replace(USERS, by_day=True), parts, load_versions, "scd2_as_of_filed").as_of(FIRST)


@query(f"""SELECT coalesce(b.user_id, a.user_id) AS user_id, coalesce(b.subs_id, a.subs_id) AS subs_id,
  CASE WHEN b.version_id IS NULL THEN 'opened' WHEN a.version_id IS NULL THEN 'closed' ELSE 'changed' END AS kind,
  b.version_id AS version_before, a.version_id AS version_after, a.eff_start_date AS since
FROM ({_snapshot_sql(SUBS_SQL, SUBS, SUBS_BATCH, FIRST)}) b
FULL JOIN ({_snapshot_sql(SUBS_SQL, SUBS, SUBS_BATCH, THIRD)}) a ON a.user_id = b.user_id AND a.subs_id = b.subs_id
WHERE a.version_id IS DISTINCT FROM b.version_id""")
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriptions that were opened, renewed or closed between two days, over the batches in between."""
    found = _subs_table(spark, sf_dir, "scd2_changes").changes(FIRST, THIRD)
    return found.select(
        *SUBS.keys, "kind", F.col("before.version_id").alias("version_before"),
        F.col("after.version_id").alias("version_after"), F.col("after.eff_start_date").alias("since"),
    )


@query(f"SELECT * FROM ({history_sql(SUBS_SQL, SUBS, SUBS_BATCH)}) h")
def scd2_by_start_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of a table that is also divided by the start of its versions."""
    by_start = replace(SUBS, partition_by=("eff_start_date",))
    parts = deliveries(subs(spark, sf_dir), "start_ts", ORDER_CUTS)
    return _store(spark, by_start, parts, load_versions, "scd2_by_start_date").history()


@query(history_sql(USERS_SQL, USERS, USERS_BATCH))
def scd2_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of a table kept by a hash of the key, of which a batch writes touched buckets only."""
    parts = deliveries(users(spark, sf_dir), "updated_ts", EVENT_CUTS)
    return _store(spark, replace(USERS, buckets=8), parts, load_versions, "scd2_by_key").history()


@query(f"SELECT * EXCLUDE (status) FROM ({history_sql(SUBS_SQL, SUBS, SUBS_BATCH)}) h WHERE status = 'current'")
def scd2_by_key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of such a table where keys with two or more delivered rows count as too large for a task."""
    parts = deliveries(subs(spark, sf_dir), "start_ts", ORDER_CUTS)
    load = partial(load_versions, rows_per_task=1)
    return _store(spark, replace(SUBS, buckets=8), parts, load, "scd2_by_key_split").current()


@query(any_order_sql(SUBS_SQL, SUBS, LATE_SQL))
def scd2_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole history stored in one pass, from deliveries in any order."""
    prepare(spark)
    table = stored_table(spark, work_folder(spark, "scd2_backfill"), SUBS)
    backfill(table, any_order(subs(spark, sf_dir)), "delivered")
    return table.history()


_BY_QUANTITY = replace(TX, partition_by=("quantity",), schema=StructType([*TX.schema.fields, StructField("quantity", IntegerType())]))
_QUANTITY_SQL = TX_SQL.replace(" FROM lineitem", ", CAST(l_quantity AS INTEGER) AS quantity FROM lineitem")


@query(f"SELECT v.*, {TX_BATCH} AS batch_dt FROM ({_QUANTITY_SQL}) v")
def fact_load_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of more partition values than a task writes side by side: rows of a value are brought together."""
    rows = tx(spark, sf_dir, F.col("l_quantity").cast("int").alias("quantity"))
    table = _store(spark, _BY_QUANTITY, deliveries(rows, "created_ts", SHIP_CUTS), load_fact, "fact_load_many")
    return table.read(list(BATCHES))


def _repaired(spark: SparkSession, sf_dir: str, spec: Dataset, purpose: str) -> DataFrame:
    """The second delivery first came without a third of its rows and with others spoilt, after the third it came whole."""
    first, second, third = deliveries(users(spark, sf_dir), "updated_ts", EVENT_CUTS)
    spoilt = second.where("version_id % 3 <> 0").withColumn("is_active", F.col("is_active") & (F.col("version_id") % 7 != 0))
    table = _store(spark, spec, [first, spoilt, third], load_versions, purpose)
    rerun(table, SECOND, lambda: load_versions(table, second, SECOND), second)
    return table.history()


@query(history_sql(USERS_SQL, USERS, USERS_BATCH))
def scd2_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir, USERS, "scd2_repair")


@query(history_sql(USERS_SQL, USERS, USERS_BATCH))
def scd2_repair_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir, replace(USERS, buckets=8), "scd2_repair_by_key")


@query(f"SELECT v.*, {TX_BATCH} AS batch_dt FROM ({TX_SQL}) v")
def catalog_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _tx_table(spark, sf_dir, "catalog_register")
    name = table.location.split("/")[-2].replace("-", "_")
    register_table(table, name, table.batches())
    return spark.table(name)


@query(USERS_SQL)
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery kept as raw lines, and its rows parsed from those."""
    folder = work_folder(spark, "raw_landing")
    source = _deliver(users(spark, sf_dir), delivery_path(folder, USERS.name, THIRD), USERS)
    land(spark, source, f"{folder}/landing", THIRD)
    return read_landed(spark, f"{folder}/landing", USERS, THIRD).select(*USERS.schema.names)


@query(f"SELECT v.*, {USERS_BATCH} AS batch_dt FROM ({USERS_SQL}) v")
def file_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries picked up in two goes; every file is landed once."""
    folder = work_folder(spark, "file_arrival")
    source, landing = f"{folder}/source", f"{folder}/landing"
    parts = dict(zip(BATCHES, deliveries(users(spark, sf_dir), "updated_ts", EVENT_CUTS)))
    for go in ((FIRST, SECOND), (THIRD,)):
        for batch_date in go:
            _deliver(parts[batch_date], delivery_path(source, USERS.name, batch_date), USERS)
        land_arrivals(spark, source, landing, f"{folder}/checkpoint")
    landed = [
        read_landed(spark, landing, USERS, b).select(*USERS.schema.names, F.lit(b).alias(BATCH)) for b in BATCHES
    ]
    return reduce(DataFrame.unionByName, landed)


@query(f"""SELECT 'users' AS dataset, batch_dt, version_id AS id, event_type AS what FROM (SELECT v.*, {USERS_BATCH} AS batch_dt FROM ({USERS_SQL}) v) u
UNION ALL SELECT 'subscriptions', batch_dt, version_id, subs_id FROM (SELECT v.*, {SUBS_BATCH} AS batch_dt FROM ({SUBS_SQL}) v) s
UNION ALL SELECT 'no dataset', NULL, 1, NULL""")
def flat_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of two datasets in one folder, beside a file that belongs to none, landed by one stream and loaded."""
    folder = work_folder(spark, "flat_arrival")
    roots = Roots("", f"{folder}/checked", f"{folder}/tables", f"{folder}/landing")
    specs = [USERS, SUBS]
    parts = {
        USERS: deliveries(users(spark, sf_dir), "updated_ts", EVENT_CUTS),
        SUBS: deliveries(subs(spark, sf_dir), "start_ts", ORDER_CUTS),
    }
    for spec in specs:
        for batch_date, rows in zip(BATCHES, parts[spec]):
            _deliver(rows, delivery_path(f"{folder}/source", spec.name, batch_date), spec)
    plans(spark, sf_dir).limit(1).write.csv(f"{folder}/source/notes.csv")
    reports = run_flat_arrivals(spark, f"{folder}/source", f"{folder}/checkpoint", roots, specs)
    unmatched = [r.message for r in reports if not r.ok]
    if len(unmatched) != 1 or "notes.csv" not in unmatched[0]:
        raise RuntimeError("; ".join(unmatched))
    shown = {USERS: "event_type", SUBS: "subs_id"}
    landed = [
        read_landed(spark, roots.landed(spec), spec, b).select(
            F.lit(spec.name).alias("dataset"), F.lit(b).alias(BATCH), F.col("version_id").alias("id"), F.col(shown[spec]).alias("what")
        )
        for spec in specs
        for b in BATCHES
    ]
    odd = spark.read.parquet(f"{landed_folder(roots.landing, NO_VALUE)}").agg(F.count(F.lit(1)).alias("id"))
    odd = odd.select(F.lit("no dataset").alias("dataset"), F.lit(None).cast("date").alias(BATCH), "id", F.lit(None).cast("string").alias("what"))
    return reduce(DataFrame.unionByName, [*landed, odd])


def _sizes_sql(name: str, rows: str, status: str = "'loaded'") -> str:
    return (
        f"SELECT '{name}' AS dataset, batch_dt, {status} AS status, CAST(count(*) AS BIGINT) AS n_rows "
        f"FROM ({rows}) r GROUP BY ALL"
    )


_DATES = ", ".join(f"(DATE '{b}')" for b in BATCHES)


def _versions_sql(source: str, spec: Dataset, batch: str) -> str:
    """Rows stored by each batch: those it closed, and those current after it."""
    return f"""SELECT d.batch_dt, CASE WHEN h.eff_end_date = d.batch_dt THEN 'closed' ELSE 'current' END AS status
FROM (VALUES {_DATES}) d(batch_dt) JOIN ({history_sql(source, spec, batch)}) h
  ON h.eff_start_date <= d.batch_dt AND (h.eff_end_date IS NULL OR h.eff_end_date >= d.batch_dt)"""


_DAILY_SQL = "\nUNION ALL\n".join(
    [
        _sizes_sql("price_plans", f"SELECT d.batch_dt FROM (VALUES {_DATES}) d(batch_dt), part"),
        _sizes_sql("transactions", f"SELECT {TX_BATCH} AS batch_dt FROM ({TX_SQL}) v"),
        _sizes_sql("subscriptions", _versions_sql(SUBS_SQL, SUBS, SUBS_BATCH), "r.status"),
        _sizes_sql("users", _versions_sql(USERS_SQL, USERS, USERS_BATCH), "r.status"),
    ]
)


def _ran_daily(spark: SparkSession, sf_dir: str, purpose: str) -> tuple[Roots, list[Dataset]]:
    """All four datasets over three days, from CSV deliveries to stored tables."""
    folder = work_folder(spark, purpose)
    roots = Roots(f"{folder}/deliveries", f"{folder}/checked", f"{folder}/tables")
    specs = {
        PLANS: [plans(spark, sf_dir)] * len(BATCHES),
        SUBS: deliveries(subs(spark, sf_dir), "start_ts", ORDER_CUTS),
        TX: deliveries(tx(spark, sf_dir), "created_ts", SHIP_CUTS),
        USERS: deliveries(users(spark, sf_dir), "updated_ts", EVENT_CUTS),
    }
    for number, batch_date in enumerate(BATCHES):
        for spec, parts in specs.items():
            _deliver(parts[number], delivery_path(roots.deliveries, spec.name, batch_date), spec)
        reports = run_batch(spark, batch_date, roots, list(specs))
        failed = [r.message for r in reports if not r.ok]
        if failed:
            raise RuntimeError("; ".join(failed))
    return roots, list(specs)


@query(_DAILY_SQL)
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of which status every batch of the daily run stores."""
    roots, specs = _ran_daily(spark, sf_dir, "daily_run")
    sizes = []
    for spec in specs:
        stored = BatchTable(spark, roots.tables, spec).read(list(BATCHES))
        status = F.col(STATUS) if spec.versioned else F.lit("loaded").alias(STATUS)
        sizes.append(
            stored.select(F.lit(spec.name).alias("dataset"), BATCH, status)
            .groupBy("dataset", BATCH, STATUS)
            .agg(F.count(F.lit(1)).alias("n_rows"))
        )
    return reduce(DataFrame.unionByName, sizes)


@query(history_sql(USERS_SQL, USERS, USERS_BATCH))
def daily_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days of one dataset, each delivery landed as raw lines first and loaded from those."""
    folder = work_folder(spark, "daily_landing")
    roots = Roots(f"{folder}/deliveries", f"{folder}/checked", f"{folder}/tables", f"{folder}/landing")
    for batch_date, rows in zip(BATCHES, deliveries(users(spark, sf_dir), "updated_ts", EVENT_CUTS)):
        _deliver(rows, delivery_path(roots.deliveries, USERS.name, batch_date), USERS)
        (report,) = run_batch(spark, batch_date, roots, [USERS])
        if not report.ok:
            raise RuntimeError(report.message)
    return BatchTable(spark, roots.tables, USERS).history()


# A row of any of the four tables in the same columns.
_ROW = ("dataset", "batch_dt", "status", "id", "part", "version", "eff_start_date", "eff_end_date", "amount")


def _rows_sql(name: str, rows: str, row_id: str, part: str, version: str, amount: str, status: str = "'loaded'", interval: bool = False) -> str:
    start, end = ("eff_start_date", "stored_end") if interval else ("CAST(NULL AS DATE)", "CAST(NULL AS DATE)")
    return f"""SELECT '{name}' AS dataset, batch_dt, {status} AS status, CAST({row_id} AS VARCHAR) AS id, CAST({part} AS VARCHAR) AS part,
  CAST({version} AS BIGINT) AS version, {start} AS eff_start_date, {end} AS eff_end_date, CAST({amount} AS DECIMAL(18,2)) AS amount FROM ({rows}) r"""


def _stored_versions_sql(source: str, spec: Dataset, batch: str) -> str:
    """As :func:`_versions_sql` with all columns; a version that ends later is stored without an end."""
    return f"""SELECT d.batch_dt, h.* EXCLUDE (status), CASE WHEN h.eff_end_date = d.batch_dt THEN 'closed' ELSE 'current' END AS status,
  CASE WHEN h.eff_end_date = d.batch_dt THEN h.eff_end_date END AS stored_end
FROM (VALUES {_DATES}) d(batch_dt) JOIN ({history_sql(source, spec, batch)}) h
  ON h.eff_start_date <= d.batch_dt AND (h.eff_end_date IS NULL OR h.eff_end_date >= d.batch_dt)"""


@query(
    "\nUNION ALL\n".join(
        [
            _rows_sql("price_plans", f"SELECT d.batch_dt, p.* FROM (VALUES {_DATES}) d(batch_dt), ({PLANS_SQL}) p", "price_plan_id", "price_plan_type", "plan_size", "price"),
            _rows_sql("transactions", f"SELECT v.*, {TX_BATCH} AS batch_dt FROM ({TX_SQL}) v", "transaction_id", "price_plan_id", "subs_id", "amount"),
            _rows_sql("subscriptions", _stored_versions_sql(SUBS_SQL, SUBS, SUBS_BATCH), "user_id", "subs_id", "version_id", "NULL", "r.status", True),
            _rows_sql("users", _stored_versions_sql(USERS_SQL, USERS, USERS_BATCH), "user_id", "event_type", "version_id", "NULL", "r.status", True),
        ]
    )
)
def daily_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that the daily run of three days stores, by table and batch."""
    roots, _ = _ran_daily(spark, sf_dir, "daily_run_rows")
    shapes = {
        PLANS: ("price_plan_id", "price_plan_type", "plan_size", "price"),
        SUBS: ("user_id", "subs_id", "version_id", None),
        TX: ("transaction_id", "price_plan_id", "subs_id", "amount"),
        USERS: ("user_id", "event_type", "version_id", None),
    }
    parts = []
    for spec, (row_id, part, version, amount) in shapes.items():
        rows = BatchTable(spark, roots.tables, spec).read(list(BATCHES))
        dates = [F.col(c) if spec.versioned else F.lit(None).cast("date").alias(c) for c in ("eff_start_date", "eff_end_date")]
        money = F.lit(None) if amount is None else F.col(amount)
        parts.append(
            rows.select(
                F.lit(spec.name).alias("dataset"), BATCH, F.col(STATUS) if spec.versioned else F.lit("loaded").alias(STATUS),
                F.col(row_id).cast("string").alias("id"), F.col(part).cast("string").alias("part"),
                F.col(version).cast("long").alias("version"), *dates, money.cast("decimal(18,2)").alias("amount"),
            )
        )
    return reduce(DataFrame.unionByName, parts).select(*_ROW)
