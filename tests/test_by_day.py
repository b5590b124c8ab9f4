"""Reads as of a day from versions filed by day."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of, users
from tidemark.plans import backfill, load_versions, rerun
from tidemark.sources import stored_table
from tidemark.sources.by_day import LEVELS, cell_columns, cells_of
from tidemark.specs import USERS

START = date(2025, 1, 1)
FILED = replace(USERS, by_day=True)


def delivery(spark, seed):
    pick = Random(seed)
    rows = [(pick.choice([None, *range(9)]), f"01-{pick.randint(1, 28):02d}", pick.choice([True, True, False])) for _ in range(6)]
    return users(spark, *rows)


def loaded(spark, root, spec, days):
    table = stored_table(spark, str(root), spec)
    for n, day in enumerate(days):
        load_versions(table, delivery(spark, n), day)
    return table


def test_a_version_is_in_one_cell_of_each_of_its_days_and_of_no_other(spark):
    pick = Random(1)
    pairs = [(START + timedelta(pick.randint(-40, 40)), pick.choice([1, 1, 2, 5, 40, 500])) for _ in range(300)]
    rows = [(s, s + timedelta(n)) for s, n in pairs] + [(date(1969, 12, 30), date(1970, 1, 3)), (date(1, 1, 1), date(9999, 12, 31))]
    frame = spark.createDataFrame(rows, "eff_start_date date, eff_end_date date")
    for r in frame.select("*", *(c.alias(n) for n, c in cell_columns().items())).collect():
        assert 0 <= r.level < LEVELS
        for day in {r.eff_start_date, r.eff_end_date - timedelta(1), r.eff_start_date + (r.eff_end_date - r.eff_start_date) / 2}:
            assert (r.level, r.cell) in cells_of(day)


@pytest.mark.parametrize("spec", [FILED, replace(FILED, buckets=4)], ids=["plain", "keyed"])
def test_same_rows(spark, tmp_path, spec):
    days = [START + timedelta(n) for n in (0, 1, 3, 4, 9)]
    table = loaded(spark, tmp_path / "filed", spec, days)
    plain = loaded(spark, tmp_path / "plain", USERS, days)
    assert set(table.day_index().filed()) == set(days)

    def same():
        for day in [START - timedelta(1), *days, START + timedelta(2), START + timedelta(20)]:
            assert rows_of(table.as_of(day)) == rows_of(plain.as_of(day)), day

    same()
    again = delivery(spark, 77)
    for x in (table, plain):
        rerun(x, days[1], lambda x=x: load_versions(x, again, days[1]), again)
    same()


def test_batches_that_are_not_filed_are_read_as_before(spark, tmp_path):
    days = [START + timedelta(n) for n in range(4)]
    loaded(spark, tmp_path, USERS, days[:3])
    table = stored_table(spark, str(tmp_path), FILED)
    plain = stored_table(spark, str(tmp_path), USERS)
    load_versions(table, delivery(spark, 3), days[3])  # files what came before as well
    assert set(table.day_index().filed()) == set(days)
    load_versions(plain, delivery(spark, 9), days[2])
    assert set(table.day_index().filed()) == {days[0], days[1], days[3]}
    for day in days:
        assert rows_of(table.as_of(day)) == rows_of(plain.as_of(day))


def test_backfill_is_filed(spark, tmp_path):
    whole = delivery(spark, 1).withColumn("delivered", F.lit(START)).unionByName(delivery(spark, 2).withColumn("delivered", F.lit(START + timedelta(1))))
    table, plain = stored_table(spark, f"{tmp_path}/a", FILED), stored_table(spark, f"{tmp_path}/b", USERS)
    for x in (table, plain):
        assert backfill(x, whole, "delivered")
    assert rows_of(table.as_of(START)) == rows_of(plain.as_of(START))


def test_a_day_reads_few_folders(spark, tmp_path):
    """However many batches came since: one folder of a level at most, and no closed folder of a batch."""
    days = [START + timedelta(n) for n in range(12)]
    table = loaded(spark, tmp_path, FILED, days)
    text = table.as_of(START)._jdf.queryExecution().executedPlan().toString()
    assert "status=closed" not in text
    folders = [int(n) for n in re.findall(r"InMemoryFileIndex\((\d+) paths\)", text)]
    assert len(folders) == 2 and max(folders) <= 5
