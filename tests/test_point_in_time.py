"""Facts with the version valid on their day."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from random import Random

import pytest

from helpers import rows_of
from tidemark import operators as op
from tidemark.specs import EFF_END, EFF_START, SUBSCRIPTIONS

DAY = date(2025, 1, 1)
FACTS = "fact int, who int, what int, at timestamp, version string, _day string"


def history(spark, seed, keys):
    """Intervals that never overlap, with gaps, days at which several end at once, and open ones."""
    pick, rows = Random(seed), []
    for key in keys:
        day = DAY + timedelta(days=pick.randint(0, 5))
        for number in range(pick.randint(0, 6)):
            length = pick.choice([0, 1, 3, 7])
            end = None if number == 5 else day + timedelta(days=length)
            rows.append((*key, number, day, end))
            if end is None:
                break
            day = end + timedelta(days=pick.choice([0, 0, 2]))
    schema = f"user_id int, subs_id int, price_plan_id int, {EFF_START} date, {EFF_END} date"
    made = spark.createDataFrame(rows, schema)
    other = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in SUBSCRIPTIONS.schema if f.name not in made.columns]
    return made.selectExpr("*", *other).select(*SUBSCRIPTIONS.version_schema.names), rows


def facts(spark, seed, keys, rows=200):
    pick, out = Random(seed), []
    for number in range(rows):
        key = pick.choice([keys[0], pick.choice(keys), (99, 99)])
        when = datetime(2025, 1, 1) + timedelta(days=pick.randint(-2, 30), hours=pick.randint(0, 23))
        out.append((number % 150, *key, None if number % 40 == 0 else when, "x", "y"))
    return spark.createDataFrame(out, FACTS).repartition(5), out


def brute(facts, versions):
    out = []
    for fact in facts:
        day = fact[3] and fact[3].date()
        valid = [v for v in versions if day and v[:2] == fact[1:3] and v[3] <= day and (v[4] is None or v[4] > day)]
        assert len(valid) <= 1
        out.append((*fact[:4], valid[0][2] if valid else None))
    return sorted(out, key=repr)


KEYS = [(1, 1), (1, 2), (None, 1), (None, None), (2, None), (3, 1)]


@pytest.mark.parametrize("rows_per_task", [2_000_000, 20])
@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed, rows_per_task):
    versions, as_rows = history(spark, seed, KEYS)
    delivered, fact_rows = facts(spark, seed, KEYS)
    found = op.with_version(delivered, versions, SUBSCRIPTIONS, "at", ["who", "what"], rows_per_task=rows_per_task)
    assert found.columns == [*delivered.columns, "version"]
    shown = found.toDF(*delivered.columns[:4], "clash", "_day", "valid").select("fact", "who", "what", "at", "valid.price_plan_id")
    assert rows_of(shown, "fact", "who", "what", "at", "price_plan_id") == brute(fact_rows, as_rows)


def test_no_versions_or_no_facts(spark):
    versions, _ = history(spark, 1, KEYS)
    delivered, _ = facts(spark, 1, KEYS)
    clean = delivered.drop("version")
    found = op.with_version(clean, versions.limit(0), SUBSCRIPTIONS, "at", ["who", "what"])
    assert found.count() == 200 and found.where("version IS NOT NULL").isEmpty()
    assert op.with_version(clean.limit(0), versions, SUBSCRIPTIONS, "at", ["who", "what"]).isEmpty()


def test_is_one_shuffle_and_no_join(spark):
    versions, _ = history(spark, 1, KEYS)
    delivered, _ = facts(spark, 1, KEYS)
    counts = op.count_keys(delivered, ["who", "what"])
    found = op.with_version(delivered.drop("version"), versions, SUBSCRIPTIONS, "at", ["who", "what"], counts)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Cartesian" not in text
    assert text.count("Exchange hashpartitioning") == 1
