"""Net changes between two days."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta
from random import Random

import pytest

from helpers import users
from tidemark.plans import load_versions
from tidemark.sources import stored_table
from tidemark.specs import USERS

DAYS = [date(2025, 1, d) for d in (20, 21, 23)]


@pytest.mark.parametrize("spec", [USERS, replace(USERS, buckets=4)], ids=["plain", "keyed"])
def test_equals_both_snapshots(spark, tmp_path, spec):
    pick = Random(3)
    table = stored_table(spark, str(tmp_path), spec)
    for day in DAYS:
        rows = [(pick.choice([None, *range(9)]), f"01-{pick.randint(1, 28):02d}", pick.choice([True, True, False])) for _ in range(9)]
        load_versions(table, users(spark, *rows), day)
    days = [DAYS[0] - timedelta(1), *DAYS, DAYS[1] + timedelta(1), DAYS[2] + timedelta(3)]
    valid = {day: {r.user_id: r for r in table.as_of(day).collect()} for day in days}
    for first in days:
        for second in days:
            if second < first:
                continue
            old, new = valid[first], valid[second]
            wanted = {
                (k, "opened" if k not in old else "closed" if k not in new else "changed")
                for k in {*old, *new}
                if k not in old or k not in new or old[k].eff_start_date != new[k].eff_start_date
            }
            got = table.changes(first, second).collect()
            assert {(r.user_id, r.kind) for r in got} == wanted and len(got) == len(wanted)
            for r in got:
                for version, side in ((r.before, old), (r.after, new)):
                    assert (version and version.user_updated_timestamp) == (side.get(r.user_id) and side[r.user_id].user_updated_timestamp)
    with pytest.raises(ValueError):
        table.changes(DAYS[1], DAYS[0])


def test_reads_only_what_lies_in_between(spark, tmp_path):
    table = stored_table(spark, str(tmp_path), USERS)
    for day in DAYS:
        load_versions(table, users(spark, (1, f"01-{day.day}", True)), day)
    text = table.changes(DAYS[0], DAYS[1])._jdf.queryExecution().executedPlan().toString()
    assert f"batch_dt={DAYS[2]}" not in text and f"batch_dt={DAYS[0]}" not in text
    assert f"GreaterThan(eff_start_date,{DAYS[0]})" in text
