"""A batch that is run again, and what it changes later."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date
from random import Random

import pytest

from helpers import rows_of, users
from tidemark.plans import Roots, load_versions, rerun, run_batch
from tidemark.sinks import drop_old_snapshots
from tidemark.sources import stored_table
from tidemark.specs import USERS

DAYS = [date(2025, 1, d) for d in range(20, 25)]
KINDS = [USERS, replace(USERS, buckets=4)]


def delivery(spark, seed, people=12):
    pick = Random(seed)
    rows = [(pick.choice([None, *range(people)]), f"01-{pick.randint(1, 28):02d}", pick.choice([True, True, False, None])) for _ in range(pick.randint(0, 14))]
    return users(spark, *rows)


def loaded(spark, root, spec, parts):
    table = stored_table(spark, str(root), spec)
    for day, rows in parts.items():
        load_versions(table, rows, day)
    return table


@pytest.mark.parametrize("spec", KINDS, ids=["plain", "keyed"])
@pytest.mark.parametrize("seed, again", [(1, 0), (3, 2)])
def test_equals_running_all_again(spark, tmp_path, spec, seed, again):
    parts = {day: delivery(spark, 10 * seed + n) for n, day in enumerate(DAYS)}
    table = loaded(spark, tmp_path / "one", spec, parts)
    other = delivery(spark, 1000 + seed)
    rerun(table, DAYS[again], lambda: load_versions(table, other, DAYS[again]), other)
    wanted = loaded(spark, tmp_path / "two", USERS, parts | {DAYS[again]: other})
    assert table.batches() == DAYS
    assert rows_of(table.history()) == rows_of(wanted.history())
    for day in DAYS:
        assert rows_of(table.snapshot(day)) == rows_of(wanted.snapshot(day))
        assert rows_of(table.as_of(day)) == rows_of(wanted.as_of(day))
    more = delivery(spark, 2000 + seed)
    for x in (table, wanted):
        load_versions(x, more, date(2025, 1, 30))
    assert rows_of(table.history()) == rows_of(wanted.history())


@pytest.mark.parametrize("spec", KINDS, ids=["plain", "keyed"])
def test_a_batch_that_comes_late(spark, tmp_path, spec):
    parts = {day: delivery(spark, 50 + n) for n, day in enumerate(DAYS)}
    table = loaded(spark, tmp_path / "one", spec, {d: r for d, r in parts.items() if d != DAYS[2]})
    rerun(table, DAYS[2], lambda: load_versions(table, parts[DAYS[2]], DAYS[2]), parts[DAYS[2]])
    wanted = loaded(spark, tmp_path / "two", USERS, parts)
    assert rows_of(table.history()) == rows_of(wanted.history())


@pytest.mark.parametrize("spec", KINDS, ids=["plain", "keyed"])
def test_the_same_delivery_changes_nothing(spark, tmp_path, spec):
    parts = {day: delivery(spark, 70 + n) for n, day in enumerate(DAYS[:3])}
    table = loaded(spark, tmp_path, spec, parts)
    before = files(table, DAYS[1])
    assert rerun(table, DAYS[0], lambda: load_versions(table, parts[DAYS[0]], DAYS[0]), parts[DAYS[0]]) == ()
    assert files(table, DAYS[1]) == before


def files(table, day):
    return sorted(os.path.join(root, n) for root, _, names in os.walk(table.batch_path(day)) for n in names if n.startswith("part-"))


def test_only_buckets_of_changed_keys_are_written(spark, tmp_path):
    spec = replace(USERS, buckets=8)
    everybody = users(spark, *((k, "01-01", True) for k in range(100)))
    second = users(spark, *((k, "01-02", True) for k in range(100)))
    table = loaded(spark, tmp_path, spec, {DAYS[0]: everybody, DAYS[1]: second})
    before = files(table, DAYS[1])
    changed = users(spark, *((k, "01-03" if k == 5 else "01-01", True) for k in range(100)))
    assert rerun(table, DAYS[0], lambda: load_versions(table, changed, DAYS[0]), changed) == (DAYS[1],)
    after = files(table, DAYS[1])
    written = {p.split("bucket=")[1].split("/")[0] for p in set(after) - set(before)}
    assert len(written) == 1 and len(set(before) & set(after)) >= len(before) - 2
    # the later version of the fifth is now late
    assert table.current().where("user_id = 5 AND user_updated_timestamp = '2025-01-03'").count() == 1


def test_dropped_snapshots_are_refused(spark, tmp_path):
    parts = {day: delivery(spark, 90 + n) for n, day in enumerate(DAYS)}
    table = loaded(spark, tmp_path, USERS, parts)
    drop_old_snapshots(table)
    called = []
    with pytest.raises(LookupError, match="were dropped"):
        rerun(table, DAYS[1], lambda: called.append(1), parts[DAYS[1]])
    assert not called


def test_daily_run_repairs(spark, tmp_path):
    header = ",".join(USERS.schema.names)
    text = lambda when, name: f"{header}\n1,{name},,,,,2025-01-{when} 00:00:00,true\n"
    for day, when in (("20250120", "20"), ("20250121", "21")):
        (tmp_path / f"users_{day}.csv").write_text(text(when, "a"))
    roots = Roots(str(tmp_path), f"{tmp_path}/checked", f"{tmp_path}/tables")
    for day in DAYS[:2]:
        run_batch(spark, day, roots, [USERS])
    (tmp_path / "users_20250120.csv").write_text(text("25", "b"))
    (report,) = run_batch(spark, DAYS[0], roots, [USERS], repair=True)
    assert report.ok and report.repaired == (DAYS[1],) and report.stale == ()
    table = stored_table(spark, roots.tables, USERS)
    assert [r.user_name for r in table.current().collect()] == ["b"] and table.history().count() == 2
