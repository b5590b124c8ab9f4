"""Physical plans: what is shuffled, pushed down, and read."""

from __future__ import annotations

import os
import re
from datetime import date

import pytest

from tidemark import operators as op
from tidemark.functions import newest_first
from tidemark.plans import load_versions
from tidemark.queries.standins import BATCHES, ORDER_CUTS, SUBS, deliveries, subs
from tidemark.sources import BatchTable

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    table = BatchTable(spark, str(tmp_path_factory.mktemp("tables")), SUBS)
    parts = deliveries(subs(spark, SF_DIR), "start_ts", ORDER_CUTS)
    for batch_date, rows in zip(BATCHES[:2], parts):
        load_versions(table, rows, batch_date)
    return table, parts[2]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_full_step_shuffles_once(stored):
    table, incoming = stored
    text = plan(op.step(table.current(), incoming, SUBS, BATCHES[2]))
    assert len(shuffles(text)) == 1
    assert "Join" not in text


def test_touched_step_keeps_other_rows_out_of_the_shuffle(stored):
    table, incoming = stored
    text = plan(op.step(table.current(), incoming, SUBS, BATCHES[2], touched_only=True))
    untouched, changing = text.split("Window", 1)
    assert "LeftAnti" in untouched and "LeftSemi" in changing
    assert "SortMergeJoin" not in text
    # Counting the delivered keys shuffles key columns only.
    assert all(len(columns.split(",")) <= 3 for columns in shuffles(text))


def test_splitting_broadcasts_the_list_and_shuffles_by_part(stored):
    _, incoming = stored
    hot = op.count_keys(incoming, SUBS.keys).hot(rows_per_task=1)
    text = plan(op.mark_newest(incoming, SUBS.keys, newest_first(SUBS, None), hot))
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert sum("_part" in columns for columns in shuffles(text)) == 2


def test_latest_is_limited_before_the_shuffle(spark):
    text = plan(op.latest_per_key(subs(spark, SF_DIR), SUBS.keys, newest_first(SUBS, None)))
    before_shuffle = text.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before_shuffle


def test_superseded_of_few_rows_shuffles_once(spark):
    rows = subs(spark, SF_DIR)
    counts = op.count_keys(rows, SUBS.keys)
    assert len(shuffles(plan(op.superseded(rows, SUBS.keys, newest_first(SUBS, None), counts)))) == 1


def test_rebuild_shuffles_once(spark):
    rows = subs(spark, SF_DIR).selectExpr("*", "CAST(start_ts AS DATE) AS delivered")
    assert len(shuffles(plan(op.rebuild(rows, SUBS, "delivered")))) == 1


def test_reads_name_their_folders_and_push_the_day_down(stored):
    table, _ = stored
    text = plan(table.as_of(date(2024, 1, 15)))
    assert "LessThanOrEqual(eff_start_date,2024-01-15)" in text
    assert "batch_dt=2024-01-10" not in text
    folders = re.search(r"InMemoryFileIndex\((\d+) paths\)", plan(table.history())).group(1)
    assert folders == "3"  # closed of both batches, current of the newest


def test_reads_only_needed_columns(stored):
    table, _ = stored
    text = plan(table.current().select("user_id"))
    assert "ReadSchema: struct<user_id:bigint>" in text
