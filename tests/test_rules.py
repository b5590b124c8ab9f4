"""Rules about several rows or datasets."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace
from datetime import date
from random import Random

import pytest
from pyspark.sql import functions as F

from helpers import users
from tidemark import operators as op
from tidemark.plans import Roots, load_versions, refused_rows, run_batch
from tidemark.sources import stored_table
from tidemark.specs import PRICE_PLANS, SUBSCRIPTIONS, TRANSACTIONS, USERS

DAY = date(2025, 1, 20)
LIMITS = [{}, {"limit": 0}, {"limit": 0, "rows_per_task": 20}, {"limit": 600}]


def random_rows(seed, rows=300):
    pick = Random(seed)
    return [(n, pick.choice([1, 1, None, pick.randrange(150)]), pick.choice(["a", None, "b"])) for n in range(rows)]


@pytest.mark.parametrize("limits", LIMITS, ids=str)
def test_repeated(spark, limits):
    rows = random_rows(1)
    frame = spark.createDataFrame(rows, "n int, a int, b string").withColumn("reason", F.when(F.col("n") < 5, F.lit("before")))
    counts = Counter((a, b) for _, a, b in rows)
    found = op.flag_repeated(frame, ["a", "b"], "reason", **limits)
    assert found.columns == frame.columns and found.count() == len(rows)
    for r in found.collect():
        repeats = r.a is not None and r.b is not None and counts[r.a, r.b] > 1
        assert r.reason == ("before" if r.n < 5 else "repeated a, b" if repeats else None)


@pytest.mark.parametrize("limits", LIMITS, ids=str)
def test_unknown(spark, limits):
    rows = random_rows(2)
    frame = spark.createDataFrame(rows, "n int, a int, b string").withColumn("reason", F.lit(None).cast("string"))
    parents = [(k, "x") for k in [*range(2, 150, 3), None, None, 2]]
    known = {k for k, _ in parents}
    frame_of = lambda p: spark.createDataFrame(p, "id long, reason string")
    found = op.flag_unknown(frame, ["a"], frame_of(parents), ["id"], "reason", "unknown a", **limits)
    assert found.count() == len(rows)
    for r in found.collect():
        assert r.reason == ("unknown a" if r.a is not None and r.a not in known else None)
    nobody = op.flag_unknown(frame, ["a"], frame_of(parents).limit(0), ["id"], "reason", "unknown a", **limits)
    assert nobody.where("reason IS NULL").count() == sum(a is None for _, a, _ in rows)
    assert op.flag_unknown(frame.limit(0), ["a"], frame_of(parents), ["id"], "reason", "unknown a", **limits).isEmpty()


def test_misfits_are_told_apart(spark):
    rows = spark.createDataFrame([("1", "2025-01-20", "yes"), ("x", "2025-01-20", "no"), (None, "soon", "2")], "user_id string, user_updated_timestamp string, is_subs_active string")
    found = op.with_misfits(rows, USERS.schema, USERS.decisive, "reason").collect()
    assert [r.reason for r in found] == [None, "user_id is no int: x", "user_updated_timestamp is no timestamp: soon"]
    assert [(r.user_id, r.is_subs_active) for r in found] == [(1, True), (None, False), (None, None)]


def write(folder, name, spec, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([",".join(spec.schema.names), *lines]) + "\n")


@pytest.mark.parametrize("bad_rows", ["refuse", "null"])
def test_daily_run_refuses_by_rules(spark, tmp_path, bad_rows):
    """Plans of the same day are known, users of an earlier one too; malformed rows are no party to the rules."""
    roots = Roots(str(tmp_path / "in"), str(tmp_path / "checked"), str(tmp_path / "tables"))
    load_versions(stored_table(spark, roots.tables, USERS), users(spark, (7, "01-01", True), (8, "01-01", False)), date(2025, 1, 1))
    tx = replace(TRANSACTIONS, unique=("transaction_id",), references=(("price_plan_id", "price_plans", "price_plan_id"), ("user_id", "users", "user_id")))
    write(tmp_path / "in", "price_plans_20250120.csv", PRICE_PLANS, "1,basic,10,monthly,recurring")
    payment = lambda number, user, plan: f"{number},{user},1,{plan},5.00,2025-01-20 08:00:00,,paid"
    lines = [payment(1, 7, 1), payment(2, 7, 1), payment(2, 7, 1), payment(3, 7, 9), payment(4, 8, 1), payment(5, "", 1), "1,x"]
    write(tmp_path / "in", "transactions_20250120.csv", tx, *lines)
    reports = {r.dataset: r for r in run_batch(spark, DAY, roots, [tx, PRICE_PLANS, USERS], bad_rows)}
    assert reports["transactions"].ok, reports["transactions"].message
    reasons = Counter(r["_reason"] for r in refused_rows(spark, tx, DAY, roots).collect())
    wanted = {"repeated transaction_id": 2, "unknown price_plan_id": 1, "unknown user_id": 1, "malformed": 1}
    if bad_rows == "null":  # the malformed row is accepted, so its number repeats that of another
        wanted = {**wanted, "repeated transaction_id": 4, "malformed": 0}
    assert reasons == Counter(wanted)
    stored = [r.transaction_id for r in stored_table(spark, roots.tables, tx).read([DAY]).collect()]
    assert sorted(stored) == ([1, 5] if bad_rows == "refuse" else [5])


def test_rules_name_known_columns():
    with pytest.raises(ValueError):
        replace(SUBSCRIPTIONS, unique=("nothing",))
    with pytest.raises(ValueError):
        replace(SUBSCRIPTIONS, references=(("nothing", "users", "user_id"),))
