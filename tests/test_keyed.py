"""Histories kept by a hash of the key."""

from __future__ import annotations

import os
import re
from dataclasses import replace
from datetime import date

import pytest

from helpers import TODAY, YESTERDAY, intervals, rows_of, subs, users
from tidemark import operators as op
from tidemark.operators.hot_keys import KeyCounts
from tidemark.plans import Roots, load_versions, run_batch
from tidemark.sinks import drop_old_snapshots, register_table
from tidemark.sources import BatchTable, KeyedTable
from tidemark.sources.tables import FINISHED
from tidemark.specs import PRICE_PLANS, SUBSCRIPTIONS, TRANSACTIONS, USERS

BY_KEY = replace(USERS, buckets=8)
DAYS = [date(2025, 1, d) for d in range(20, 24)]


def deliveries(spark, seed=0, days=len(DAYS), people=15):
    """Random deliveries with late rows, ties, unknown activity and NULL keys."""
    import random

    pick = random.Random(seed)
    for _ in range(days):
        rows = []
        for _ in range(pick.randint(0, 25)):
            who = pick.choice([None, *range(people)])
            rows.append((who, f"01-{pick.randint(1, 28):02d}", pick.choice([True, True, False, None])))
        yield users(spark, *rows)


def both(spark, tmp_path, spec=BY_KEY, rows_per_task=2_000_000, **kind):
    plain = BatchTable(spark, f"{tmp_path}/plain", replace(spec, buckets=0))
    keyed = KeyedTable(spark, f"{tmp_path}/keyed", spec)
    for day, rows in zip(DAYS, deliveries(spark, **kind)):
        a = load_versions(plain, rows, day, rows_per_task=rows_per_task)
        b = load_versions(keyed, rows, day, rows_per_task=rows_per_task)
        assert b["closed"] == a["closed"] and b["current"] <= a["current"]
    return plain, keyed


@pytest.mark.parametrize("rows_per_task", [1, 2_000_000])
def test_equals_the_plain_table(spark, tmp_path, rows_per_task):
    plain, keyed = both(spark, tmp_path, rows_per_task=rows_per_task, seed=rows_per_task)
    assert rows_of(keyed.history()) == rows_of(plain.history())
    for day in DAYS:
        assert rows_of(keyed.snapshot(day)) == rows_of(plain.snapshot(day))
        assert rows_of(keyed.as_of(day)) == rows_of(plain.as_of(day))


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), BY_KEY)
    load_versions(table, users(spark, *((k, "01-20", True) for k in range(200))), YESTERDAY)
    before = table.held(YESTERDAY)
    assert len(before) == 8
    delivered = users(spark, (3, "01-21", True), (4, "01-21", False))
    load_versions(table, delivered, TODAY)
    touched = op.touched_buckets(delivered, BY_KEY)
    after = table.held(TODAY)
    assert {b for b in before if after.get(b) != before[b]} == touched
    written = {n for n in os.listdir(f"{table.batch_path(TODAY)}/status=current") if n.startswith("bucket=")}
    assert written <= {f"bucket={b}" for b in touched}
    assert table.current().count() == 199


def test_a_bucket_that_loses_all_its_rows_is_empty(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), BY_KEY)
    load_versions(table, users(spark, (1, "01-20", True)), YESTERDAY)
    load_versions(table, users(spark, (1, "01-21", False)), TODAY)
    assert table.current().isEmpty() and table.history().count() == 2
    load_versions(table, users(spark), date(2025, 1, 22))
    assert table.current().isEmpty()


def test_run_again(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), BY_KEY)
    load_versions(table, users(spark, (1, "01-20", True), (2, "01-20", True)), YESTERDAY)
    for _ in range(2):
        load_versions(table, users(spark, (1, "01-21", True)), TODAY)
        assert intervals(table.history(), "user_updated_timestamp") == [
            ("closed", "01-20", "01-20", "01-21"), ("current", "01-20", "01-20", None), ("current", "01-21", "01-21", None),
        ]


def test_a_lost_write_is_not_seen(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), BY_KEY)
    load_versions(table, users(spark, (1, "01-20", True)), YESTERDAY)
    load_versions(table, users(spark, (1, "01-21", True)), TODAY)
    for marker in (FINISHED, "_SUCCESS"):
        os.remove(f"{table.batch_path(TODAY)}/{marker}")
    assert table.newest() == YESTERDAY and table.current().count() == 1


def test_only_the_delivery_is_shuffled(spark, tmp_path):
    """No exchange lies above the scan of the snapshot, and only touched buckets are read."""
    table = KeyedTable(spark, str(tmp_path), BY_KEY)
    load_versions(table, users(spark, *((k, "01-20", True) for k in range(200))), YESTERDAY)
    rows = users(spark, *((k, "01-21", True) for k in range(3)))
    held = {b: p for b, p in table.held(YESTERDAY).items() if b in op.touched_buckets(rows, BY_KEY)}
    counts = KeyCounts.few(rows, BY_KEY.keys, 3)
    with table.bucketed(held) as existing:
        # larger than any broadcast would be
        threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            stepped = op.step_by_key(existing, rows, BY_KEY, TODAY, counts)
            text, read = stepped._jdf.queryExecution().executedPlan().toString(), existing.inputFiles()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "Bucketed: true" in scan
    assert {os.path.dirname(f.removeprefix("file://")) for f in read} == set(held.values())
    assert above(text, "FileScan") and not any("Exchange" in line for line in above(text, "FileScan"))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def above(text, node):
    """Lines of the nodes that a node's rows pass on their way to the top."""
    lines = text.splitlines()
    depth = lambda line: len(re.match(r"[ :+\-]*", line).group())
    at = next(k for k, line in enumerate(lines) if node in line)
    out, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            out.append(line)
            level = depth(line)
    return out


def test_two_column_keys_with_nulls(spark, tmp_path):
    spec = replace(SUBSCRIPTIONS, buckets=4)
    table = KeyedTable(spark, str(tmp_path), spec)
    load_versions(table, subs(spark, ("01-20", None, None, 1, None), ("01-20", None, None, None, 1), ("01-20", None)), YESTERDAY)
    load_versions(table, subs(spark, ("01-21", None, None, 1, None), ("01-21", "01-21", None, None, 1)), TODAY)
    assert intervals(table.history()) == [
        ("closed", "01-20", "01-20", "01-21"), ("closed", "01-20", "01-20", "01-21"), ("closed", "01-21", "01-21", "01-21"),
        ("current", "01-20", "01-20", None), ("current", "01-21", "01-21", None),
    ]


def test_dropping_old_buckets_keeps_the_history(spark, tmp_path):
    plain, keyed = both(spark, tmp_path, seed=5)
    wanted = rows_of(plain.history())
    assert drop_old_snapshots(keyed)
    assert rows_of(keyed.history()) == wanted
    assert rows_of(keyed.snapshot(DAYS[-2])) == rows_of(plain.snapshot(DAYS[-2]))
    with pytest.raises(LookupError):
        keyed.snapshot(DAYS[0])
    load_versions(keyed, users(spark, (1, "01-28", True)), date(2025, 2, 1))
    load_versions(plain, users(spark, (1, "01-28", True)), date(2025, 2, 1))
    assert rows_of(keyed.history()) == rows_of(plain.history())


def test_catalogue_shows_the_history(spark, tmp_path):
    _, keyed = both(spark, tmp_path, seed=6, days=2)
    register_table(keyed, "users_by_key", DAYS[:2])
    names = [*BY_KEY.version_schema.names, "status"]
    assert rows_of(spark.table("users_by_key"), *names) == rows_of(keyed.history(), *names)
    load_versions(keyed, users(spark, *((k, "01-28", True) for k in range(9))), DAYS[2])
    register_table(keyed, "users_by_key", [DAYS[2]])
    assert rows_of(spark.table("users_by_key"), *names) == rows_of(keyed.history(), *names)
    spark.sql("DROP TABLE users_by_key")


def test_other_number_of_buckets_is_refused(spark, tmp_path):
    load_versions(KeyedTable(spark, str(tmp_path), BY_KEY), users(spark, (1, "01-20", True)), YESTERDAY)
    with pytest.raises(ValueError, match="8 buckets, declared 4"):
        KeyedTable(spark, str(tmp_path), replace(USERS, buckets=4)).current()


@pytest.mark.parametrize("spec", [PRICE_PLANS, TRANSACTIONS, replace(USERS, partition_by=("eff_start_date",))])
def test_only_plain_histories_are_kept_by_key(spec):
    with pytest.raises(ValueError):
        replace(spec, buckets=4)


def test_daily_run(spark, tmp_path):
    header = ",".join(USERS.schema.names)
    for day, text in (("20250120", "1,a,,,,,2025-01-20 00:00:00,true"), ("20250121", "1,b,,,,,2025-01-21 00:00:00,true")):
        (tmp_path / f"users_{day}.csv").write_text(f"{header}\n{text}\n")
    roots = Roots(str(tmp_path), f"{tmp_path}/checked", f"{tmp_path}/tables")
    for day in (YESTERDAY, TODAY):
        (report,) = run_batch(spark, day, roots, [BY_KEY])
        assert report.ok, report.message
    assert (report.current, report.closed) == (1, 1)
    assert KeyedTable(spark, roots.tables, BY_KEY).history().count() == 2
