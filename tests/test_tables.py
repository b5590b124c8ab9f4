"""Stored tables and the daily run."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helpers import rows_of, stored_subs, subs
from tidemark.__main__ import main
from tidemark.batches import delivery_path, parse_batch_date
from tidemark.operators import step
from tidemark.plans import Roots, backfill, load_fact, load_full, load_versions, refused_rows, run_batch
from tidemark.sinks import drop_old_snapshots, register_table
from tidemark.sources import BatchTable, KeyedTable
from tidemark.specs import DATASETS, PRICE_PLANS, STATUS, SUBSCRIPTIONS, TRANSACTIONS, USERS

DAYS = [date(2025, 1, d) for d in (20, 21, 23)]
# Day one opens two subscriptions; day two renews one and cancels the other; day four opens one.
DELIVERIES = [
    [("01-20", None, None, 1, 1), ("01-20", None, None, 2, 1)],
    [("01-21", None, None, 1, 1), ("01-21", "01-21", None, 2, 1)],
    [("01-23", None, None, 3, 1)],
]


@pytest.fixture
def table(spark, tmp_path):
    stored = BatchTable(spark, str(tmp_path), SUBSCRIPTIONS)
    for day, versions in zip(DAYS, DELIVERIES):
        load_versions(stored, subs(spark, *versions), day)
    return stored


def starts(df):
    return rows_of(df, "user_id", F.date_format("subs_start_timestamp", "MM-dd"))


def test_batches_and_previous(table):
    assert table.batches() == DAYS
    assert table.previous(DAYS[2]) == DAYS[1]
    assert table.previous(date(2025, 1, 22)) == DAYS[1]
    assert table.previous(DAYS[0]) is None
    assert table.newest() == DAYS[2]
    assert table.batches(after=DAYS[0]) == DAYS[1:]


def test_current_history_as_of(table):
    assert starts(table.current()) == [(1, "01-21"), (3, "01-23")]
    assert table.history().count() == 5
    assert starts(table.as_of(date(2025, 1, 19))) == []
    assert starts(table.as_of(DAYS[0])) == [(1, "01-20"), (2, "01-20")]
    assert starts(table.as_of(DAYS[1])) == [(1, "01-21")]
    assert starts(table.as_of(date(2025, 1, 22))) == [(1, "01-21")]
    assert starts(table.as_of(date(2026, 1, 1))) == [(1, "01-21"), (3, "01-23")]


def test_as_of_equals_the_snapshot_of_that_day(table):
    for day in DAYS:
        assert starts(table.as_of(day)) == starts(table.snapshot(day))


def test_running_a_batch_again_changes_nothing(spark, table):
    before = rows_of(table.history())
    load_versions(table, subs(spark, *DELIVERIES[2]), DAYS[2])
    assert rows_of(table.history()) == before


def test_unfinished_batch_is_not_seen(table):
    os.remove(f"{table.batch_path(DAYS[2])}/_SUCCESS")
    assert table.batches() == DAYS
    os.remove(f"{table.batch_path(DAYS[2])}/_FINISHED")
    assert table.unfinished(date(2025, 2, 1)) == [DAYS[2]]
    assert table.batches() == DAYS[:2]
    assert table.previous(date(2025, 2, 1)) == DAYS[1]
    assert starts(table.current()) == [(1, "01-21")]
    assert starts(table.as_of(DAYS[2])) == [(1, "01-21")]
    assert table.history().count() == 4


def test_nothing_stored_yet(spark, tmp_path):
    empty = BatchTable(spark, str(tmp_path), SUBSCRIPTIONS)
    assert empty.batches() == []
    assert [empty.current().count(), empty.history().count(), empty.as_of(DAYS[0]).count()] == [0, 0, 0]


def test_all_cancelled_leaves_a_readable_snapshot(spark, tmp_path):
    stored = BatchTable(spark, str(tmp_path), SUBSCRIPTIONS)
    load_versions(stored, subs(spark, ("01-20", "01-20")), DAYS[0])
    assert stored.current().count() == 0
    assert load_versions(stored, subs(spark, ("01-21", None)), DAYS[1]) == {"current": 1, "closed": 0}
    assert load_versions(stored, subs(spark), DAYS[2]) == {"current": 1, "closed": 0}


WAYS = [{"large_snapshot": -1}, {"large_snapshot": -1, "rows_per_task": 1}, {"total": 2}]
WAYS += [{"large_snapshot": -1, "broadcast_bytes": 90}, {"large_snapshot": -1, "broadcast_bytes": -1}]


@pytest.mark.parametrize("options", WAYS, ids=str)
def test_ways_to_step_store_the_same(spark, table, tmp_path, options):
    other = BatchTable(spark, str(tmp_path / "other"), SUBSCRIPTIONS)
    for day, versions in zip(DAYS, DELIVERIES):
        load_versions(other, subs(spark, *versions), day, **options)
    assert rows_of(other.history()) == rows_of(table.history())


def test_division_by_start_date(spark, table, tmp_path):
    other = BatchTable(spark, str(tmp_path / "other"), replace(SUBSCRIPTIONS, partition_by=("eff_start_date",)))
    for day, versions in zip(DAYS, DELIVERIES):
        load_versions(other, subs(spark, *versions), day)
    assert os.path.isdir(f"{other.batch_path(DAYS[1])}/status=closed/eff_start_date=2025-01-20")
    assert rows_of(other.history()) == rows_of(table.history())


def test_old_snapshots_can_go(spark, table):
    before = rows_of(table.history())
    assert drop_old_snapshots(table, keep=2) == DAYS[:1]
    assert rows_of(table.history()) == before
    assert starts(table.as_of(DAYS[0])) == [(1, "01-20"), (2, "01-20")]
    load_versions(table, subs(spark, *DELIVERIES[2]), DAYS[2])
    with pytest.raises(LookupError):
        load_versions(table, subs(spark, *DELIVERIES[1]), DAYS[1])
    with pytest.raises(ValueError):
        drop_old_snapshots(table, keep=1)


def test_backfill_stores_the_same_history(spark, table, tmp_path):
    whole = None
    for day, versions in zip(DAYS, DELIVERIES):
        part = subs(spark, *versions).withColumn("delivered", F.lit(day))
        whole = part if whole is None else whole.unionByName(part)
    other = BatchTable(spark, str(tmp_path / "other"), SUBSCRIPTIONS)
    assert backfill(other, whole, "delivered")
    assert other.batches() == DAYS[2:]
    assert rows_of(other.history()) == rows_of(table.history())
    for day in DAYS:
        assert starts(other.as_of(day)) == starts(table.as_of(day))
    assert not backfill(BatchTable(spark, str(tmp_path / "none"), SUBSCRIPTIONS), whole.limit(0), "delivered")


def test_backfill_of_late_rows_equals_the_daily_steps(spark, tmp_path):
    """Late rows, a cancelled key that is sent again, and a table kept by key."""
    parts = [
        subs(spark, ("01-20", None), ("01-20", "01-20", None, 2, 1)),
        subs(spark, ("01-10", None), ("01-19", None, None, 2, 1), ("01-22", "01-22", None, 3, 1)),
        subs(spark, ("01-21", None), ("01-18", "01-21", None, 2, 1), ("01-01", None, None, 3, 1)),
    ]
    daily = BatchTable(spark, str(tmp_path / "daily"), SUBSCRIPTIONS)
    whole = []
    for day, rows in zip(DAYS, parts):
        load_versions(daily, rows, day)
        whole.append(rows.withColumn("delivered", F.lit(day)))
    by_key = replace(SUBSCRIPTIONS, buckets=4)
    for other in (BatchTable(spark, str(tmp_path / "all"), SUBSCRIPTIONS), KeyedTable(spark, str(tmp_path / "keyed"), by_key)):
        assert backfill(other, reduce(DataFrame.unionByName, whole), "delivered")
        assert rows_of(other.history()) == rows_of(daily.history())
        for day in DAYS:
            assert rows_of(other.as_of(day)) == rows_of(daily.as_of(day))
        load_versions(other, subs(spark, ("01-28", None)), date(2025, 1, 30))
    assert other.layout(date(2025, 1, 30)) and other.current().count() == daily.current().count()


def test_full_and_fact(spark, tmp_path):
    plans = BatchTable(spark, str(tmp_path), PRICE_PLANS)
    row = lambda name: spark.createDataFrame([(1, name, None, None, None)], PRICE_PLANS.schema)
    load_full(plans, row("old"), DAYS[0])
    load_full(plans, row("new"), DAYS[1])
    assert [r.price_plan_name for r in plans.read([plans.newest()]).collect()] == ["new"]
    facts = BatchTable(spark, str(tmp_path), TRANSACTIONS)
    rows = [(n, 1, 1, n % 2 or None, None, None, None, "paid") for n in (1, 2, 2, 3)]
    load_fact(facts, spark.createDataFrame(rows, TRANSACTIONS.schema), DAYS[0])
    folders = [f for f in sorted(os.listdir(facts.batch_path(DAYS[0]))) if "=" in f]
    assert folders == ["price_plan_id=1", "price_plan_id=__HIVE_DEFAULT_PARTITION__"]
    assert facts.read(DAYS[:1]).count() == 4


@pytest.mark.parametrize("plans, gathered", [(3, False), (30, True)])
def test_facts_of_many_plans_are_gathered(spark, tmp_path, plans, gathered):
    facts = BatchTable(spark, str(tmp_path), TRANSACTIONS)
    rows = spark.range(0, 3000, 1, 6).selectExpr(
        "CAST(id AS INT) AS transaction_id",
        "1 AS user_id",
        "1 AS subs_id",
        f"CAST(id % {plans} AS INT) AS price_plan_id",
        "CAST(1 AS DECIMAL(18,2)) AS transaction_amount",
        "CAST(NULL AS TIMESTAMP) AS transaction_created_timestamp",
        "CAST(NULL AS TIMESTAMP) AS transaction_updated_timestamp",
        "'paid' AS transaction_status",
    )
    load_fact(facts, rows, DAYS[0])
    assert facts.read(DAYS[:1]).count() == 3000
    files = len(facts.read(DAYS[:1]).inputFiles())
    assert files == plans if gathered else files == plans * 6


@pytest.mark.parametrize("search", [True, False])
def test_catalogue_follows_the_batches(spark, table, search):
    name, late = "subs_registered", date(2025, 1, 24)
    register_table(table, name, None if search else DAYS)
    assert rows_of(spark.table(name)) == rows_of(table.read(DAYS))
    load_versions(table, subs(spark, ("01-24", None)), late)
    register_table(table, name, None if search else [late])
    assert spark.table(name).where("batch_dt = DATE '2025-01-24'").count() == 3
    assert rows_of(spark.table(name)) == rows_of(table.read([*DAYS, late]))
    spark.sql(f"DROP TABLE {name}")


def test_catalogue_of_a_rerun_forgets_partitions_that_are_gone(spark, tmp_path):
    facts = BatchTable(spark, str(tmp_path), TRANSACTIONS)

    def rows(*plans):
        return spark.createDataFrame([(1, 1, 1, p, None, None, None, "x") for p in plans], TRANSACTIONS.schema)

    load_fact(facts, rows(1, 2, None), DAYS[0])
    register_table(facts, "tx_registered", DAYS[:1])
    assert rows_of(spark.table("tx_registered"), "price_plan_id") == rows_of(rows(1, 2, None), "price_plan_id")
    load_fact(facts, rows(2, 3), DAYS[0])
    register_table(facts, "tx_registered", DAYS[:1])
    assert rows_of(spark.table("tx_registered"), "price_plan_id") == [(2,), (3,)]
    assert spark.sql("SHOW PARTITIONS tx_registered").count() == 2
    spark.sql("DROP TABLE tx_registered")


def deliver(folder, day, spec, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(delivery_path(str(folder), spec.name, day), "w") as out:
        out.write("\n".join([",".join(spec.schema.names), *lines]) + "\n")


def deliver_day(folder, day):
    stamp = f"{day} 08:00:00"
    deliver(folder, day, PRICE_PLANS, "1,basic,9.99,monthly,recurring", "2,sport,x,monthly,recurring")
    deliver(folder, day, SUBSCRIPTIONS, f"1,1,1,{stamp},,,,", f"2,1,1,{stamp},,,,{stamp}")
    deliver(folder, day, TRANSACTIONS, f"{day.day},1,1,1,5.50,{stamp},{stamp},paid")
    deliver(folder, day, USERS, f"1,ann,1990-01-01,a@x,1,{stamp},{stamp},true")


def test_daily_run_with_a_skipped_day(spark, tmp_path):
    roots = Roots(str(tmp_path / "in"), str(tmp_path / "checked"), str(tmp_path / "tables"))
    for day in DAYS:
        deliver_day(tmp_path / "in", day)
        reports = {r.dataset: r for r in run_batch(spark, day, roots)}
        assert all(r.ok for r in reports.values()), reports
        assert (reports["price_plans"].accepted, reports["price_plans"].refused) == (1, 1)
        first = day == DAYS[0]
        assert (reports["subscriptions"].current, reports["subscriptions"].closed) == (1, 1 if first else 2)
        assert (reports["users"].current, reports["users"].closed) == (1, 0 if first else 1)
    assert BatchTable(spark, roots.tables, TRANSACTIONS).read(DAYS).count() == 3
    assert BatchTable(spark, roots.tables, USERS).history().count() == 3
    assert [r.price_plan_name for r in refused_rows(spark, PRICE_PLANS, DAYS[0], roots).collect()] == ["sport"]

    again = {r.dataset: r for r in run_batch(spark, DAYS[1], roots)}
    assert again["users"].stale == (DAYS[2],)
    assert BatchTable(spark, roots.tables, USERS).history().count() == 3


def test_one_failing_load_does_not_stop_the_others(spark, tmp_path):
    roots = Roots(str(tmp_path / "in"), str(tmp_path / "checked"), str(tmp_path / "tables"))
    deliver_day(tmp_path / "in", DAYS[0])
    os.remove(delivery_path(roots.deliveries, "users", DAYS[0]))
    with open(delivery_path(roots.deliveries, "price_plans", DAYS[0]), "w") as out:
        out.write("name,id\n")
    reports = {r.dataset: r for r in run_batch(spark, DAYS[0], roots)}
    assert {n: r.ok for n, r in reports.items()} == {
        "price_plans": False, "subscriptions": True, "transactions": True, "users": False
    }
    assert "HeaderMismatch" in reports["price_plans"].message


def test_bad_cells_can_be_loaded_as_null(spark, tmp_path):
    roots = Roots(str(tmp_path / "in"), str(tmp_path / "checked"), str(tmp_path / "tables"))
    deliver_day(tmp_path / "in", DAYS[0])
    (report,) = run_batch(spark, DAYS[0], roots, [PRICE_PLANS], bad_rows="null")
    assert (report.accepted, report.refused) == (2, 0)
    prices = BatchTable(spark, roots.tables, PRICE_PLANS).read(DAYS[:1]).select("price").collect()
    assert sorted(str(r.price) for r in prices) == ["9.99", "None"]


def test_empty_deliveries(spark, tmp_path):
    roots = Roots(str(tmp_path / "in"), str(tmp_path / "checked"), str(tmp_path / "tables"))
    for spec in DATASETS:
        deliver(tmp_path / "in", DAYS[0], spec)
    assert all(r.ok for r in run_batch(spark, DAYS[0], roots))
    assert all(BatchTable(spark, roots.tables, s).read(DAYS[:1]).count() == 0 for s in DATASETS)


def test_catalogue_of_a_run(spark, tmp_path):
    roots = Roots(str(tmp_path / "in"), str(tmp_path / "checked"), str(tmp_path / "tables"))
    deliver_day(tmp_path / "in", DAYS[0])
    spark.sql("CREATE DATABASE IF NOT EXISTS daily")
    run_batch(spark, DAYS[0], roots, catalog="daily")
    assert spark.table("daily.transactions").count() == 1
    assert spark.table("daily.subscriptions").where("status = 'current'").count() == 1
    spark.sql("DROP DATABASE daily CASCADE")


@pytest.mark.parametrize("text", ["2025120", "2025-01-20", "20251301", "", "２０２５０１２０"])
def test_other_batch_dates_are_refused(text):
    with pytest.raises(ValueError):
        parse_batch_date(text)


def test_command_line(spark, tmp_path, capsys):
    assert main([]) == 1
    assert main(["2025120", "--deliveries", "a", "--checked", "b", "--tables", "c"]) == 1
    assert "Error" in capsys.readouterr().err
    deliver_day(tmp_path / "in", DAYS[0])
    folders = [f"--{n}={tmp_path / n}" for n in ("checked", "tables")]
    arguments = ["20250120", f"--deliveries={tmp_path / 'in'}", *folders]
    assert main([*arguments, "--dataset=users"]) == 0
    assert BatchTable(spark, str(tmp_path / "tables"), USERS).current().count() == 1
    assert main(["20250122", *arguments[1:]]) == 2


def test_step_reads_only_what_it_keeps(spark):
    stepped = step(stored_subs(spark, ("01-20", None)), subs(spark, ("01-21", None)), SUBSCRIPTIONS, DAYS[1])
    assert stepped.columns == [*SUBSCRIPTIONS.schema.names, "eff_start_date", "eff_end_date", STATUS]


def test_daily_run_lands_deliveries(spark, tmp_path):
    """What was landed stays when the delivery is gone, and a run without deliveries reads it again."""
    header = ",".join(USERS.schema.names)
    delivery = tmp_path / "in" / "users_20250120.csv"
    delivery.parent.mkdir()
    delivery.write_text(f"{header}\n1,a,,,,,2025-01-20 00:00:00,true\n2,b\n")
    folders = [f"{tmp_path / n}" for n in ("checked", "tables", "landing")]
    assert main(["20250120", f"--deliveries={delivery.parent}", "--dataset=users", *(f"--{n}={tmp_path / n}" for n in ("checked", "tables", "landing"))]) == 0
    delivery.unlink()
    (report,) = run_batch(spark, DAYS[0], Roots("", *folders), [USERS])
    assert (report.ok, report.accepted, report.refused) == (True, 1, 1), report
    (report,) = run_batch(spark, DAYS[0], Roots(str(delivery.parent), *folders), [USERS])
    assert not report.ok
