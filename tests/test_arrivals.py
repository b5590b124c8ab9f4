"""New files are landed and loaded once."""

from __future__ import annotations

import os
from datetime import date

from tidemark.__main__ import main
from tidemark.plans import Roots
from tidemark.sources import BatchTable
from tidemark.sources.landing import read_lines
from tidemark.specs import PRICE_PLANS, USERS
from tidemark.streaming import land_arrivals, run_arrivals, run_flat_arrivals

DAYS = [date(2025, 1, 20), date(2025, 1, 21)]


def drop(folder, name, spec, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([",".join(spec.schema.names), *lines]) + "\n")


def user(number, day):
    return f"{number},u{number},,,,,{day} 08:00:00,true"


def test_every_file_is_landed_once(spark, tmp_path):
    source, landing, memory = tmp_path / "in", str(tmp_path / "landing"), str(tmp_path / "memory")
    drop(source, "users_20250120.csv", USERS, user(1, DAYS[0]))
    for _ in range(2):
        land_arrivals(spark, str(source), landing, memory)
    assert read_lines(spark, landing).count() == 2
    drop(source, "users_20250121.csv", USERS, user(1, DAYS[1]))
    drop(source / "nested", "users.csv", USERS, user(2, DAYS[1]))
    drop(source / "nested", "users_20259999.csv", USERS, user(3, DAYS[1]))
    old = source / "users_20250121.csv"
    os.utime(old, (old.stat().st_atime, old.stat().st_mtime - 100 * 24 * 3600))
    land_arrivals(spark, str(source), landing, memory, files_per_trigger=1)
    found = {r.batch_dt: r["count"] for r in read_lines(spark, landing).groupBy("batch_dt").count().collect()}
    assert found == {DAYS[0]: 2, DAYS[1]: 2, None: 4}


def test_arrivals_are_loaded(spark, tmp_path):
    roots = Roots("", str(tmp_path / "checked"), str(tmp_path / "tables"), str(tmp_path / "landing"))
    run = lambda: run_arrivals(spark, str(tmp_path / "in"), str(tmp_path / "memory"), roots, [USERS, PRICE_PLANS])
    drop(tmp_path / "in" / "users", "users_20250120.csv", USERS, user(1, DAYS[0]), user(2, DAYS[0]))
    drop(tmp_path / "in" / "price_plans", "price_plans_20250120.csv", PRICE_PLANS, "1,basic,10,monthly,recurring")
    first = run()
    assert [(r.dataset, r.ok, r.accepted) for r in first] == [("users", True, 2), ("price_plans", True, 1)], first
    assert run() == []

    drop(tmp_path / "in" / "users", "users_20250121.csv", USERS, user(1, DAYS[1]))
    assert [(r.dataset, r.current, r.closed) for r in run()] == [("users", 2, 1)]

    drop(tmp_path / "in" / "users", "late_20250121.csv", USERS, user(3, DAYS[1]))
    assert [(r.batch_date, r.current, r.closed) for r in run()] == [(DAYS[1], 3, 1)]
    assert BatchTable(spark, roots.tables, USERS).current().count() == 3


def test_command_line_lands_and_loads(spark, tmp_path):
    drop(tmp_path / "in" / "users", "anything.csv", USERS, user(1, DAYS[0]))
    folders = [f"--{n}={tmp_path / n}" for n in ("landing", "checkpoint", "checked", "tables")]
    spark.sql("CREATE DATABASE IF NOT EXISTS arrived")
    arguments = [f"--source={tmp_path / 'in'}", *folders, "--dataset=users", "--catalog=arrived"]
    assert main(["20250120", *arguments]) == 0
    assert spark.table("arrived.users").where("batch_dt = DATE '2025-01-20'").count() == 1
    drop(tmp_path / "in" / "users", "more.csv", USERS, user(1, DAYS[1]))
    assert main(["20250121", *arguments]) == 0
    assert spark.table("arrived.users").where("batch_dt = DATE '2025-01-21'").count() == 2
    spark.sql("DROP DATABASE arrived CASCADE")
    assert main(["20250121", f"--source={tmp_path}", *folders[2:]]) == 1


def test_failed_batch_is_tried_again(spark, tmp_path):
    roots = Roots("", str(tmp_path / "checked"), str(tmp_path / "tables"), str(tmp_path / "landing"))
    run = lambda: run_arrivals(spark, str(tmp_path / "in"), str(tmp_path / "memory"), roots, [USERS])
    (tmp_path / "in" / "users").mkdir(parents=True)
    assert run() == []
    (tmp_path / "in" / "users" / "users_20250120.csv").write_text("id,name\n1,ann\n")
    assert [r.ok for r in run()] == [False]
    assert [r.ok for r in run()] == [False]


def test_failed_reload_is_tried_again(spark, tmp_path, monkeypatch):
    import tidemark.streaming.arrivals as arrivals

    roots = Roots("", str(tmp_path / "checked"), str(tmp_path / "tables"), str(tmp_path / "landing"))
    run = lambda: run_arrivals(spark, str(tmp_path / "in"), str(tmp_path / "memory"), roots, [USERS])
    drop(tmp_path / "in" / "users", "users_20250120.csv", USERS, user(1, DAYS[0]))
    assert [r.current for r in run()] == [1]
    drop(tmp_path / "in" / "users", "more_20250120.csv", USERS, user(2, DAYS[0]))
    works = arrivals.load_dataset
    failed = lambda spark, spec, batch, *_, **__: arrivals.LoadReport(spec.name, batch, ok=False, message="lost")
    monkeypatch.setattr(arrivals, "load_dataset", failed)
    assert [r.ok for r in run()] == [False]
    monkeypatch.setattr(arrivals, "load_dataset", works)
    assert [(r.ok, r.current) for r in run()] == [(True, 2)]
    assert run() == []


def test_no_file_is_lost(spark, tmp_path):
    roots = Roots("", str(tmp_path / "checked"), str(tmp_path / "tables"), str(tmp_path / "landing"))
    source = tmp_path / "in" / "users"
    run = lambda memory: run_arrivals(spark, str(tmp_path / "in"), str(tmp_path / memory), roots, [USERS])
    drop(source, "users_20250120.csv", USERS, user(1, DAYS[0]))
    assert [r.current for r in run("memory")] == [1]
    drop(source, "users_20250121.csv", USERS, user(2, DAYS[1]))
    drop(source, "undated.csv", USERS, user(3, DAYS[1]))
    os.utime(source / "users_20250121.csv", (0, 0))
    found = run("memory")
    assert [(r.batch_date, r.ok) for r in found] == [(DAYS[1], True), (None, False)]
    assert "undated.csv" in found[1].message

    for name in os.listdir(source):
        if name.endswith(".csv"):
            (source / name).write_text("")
    drop(source, "later_20250121.csv", USERS, user(4, DAYS[1]))
    found = {r.batch_date: r for r in run("other memory")}  # its first micro-batch replaces no earlier one
    assert found[DAYS[1]].ok and found[DAYS[1]].accepted == 2


def test_flat_folder(spark, tmp_path):
    """Files of several datasets side by side, one that fits none, a few files at a time."""
    roots = Roots("", str(tmp_path / "checked"), str(tmp_path / "tables"), str(tmp_path / "landing"))
    source = tmp_path / "in (flat)"
    run = lambda: run_flat_arrivals(spark, str(source), str(tmp_path / "memory"), roots, [USERS, PRICE_PLANS], files_per_trigger=1)
    drop(source, "users_20250120.csv", USERS, user(1, DAYS[0]), user(2, DAYS[0]))
    drop(source, "price_plans_20250120.csv", PRICE_PLANS, "1,basic,10,monthly,recurring")
    drop(source, "users_20250121.csv", USERS, user(1, DAYS[1]))
    reports = run()
    assert sorted((r.dataset, r.batch_date, r.accepted) for r in reports) == [
        ("price_plans", DAYS[0], 1), ("users", DAYS[0], 2), ("users", DAYS[1], 1),
    ]
    assert run() == []
    drop(source, "superusers_20250121.csv", USERS, user(9, DAYS[1]))
    drop(source, "users_more_20250121.csv", USERS, user(3, DAYS[1]))
    drop(source, "users_undated.csv", USERS, user(4, DAYS[1]))
    found = run()
    assert [(r.dataset, r.batch_date, r.ok) for r in found] == [("users", DAYS[1], True), ("users", None, False), ("", None, False)]
    assert "superusers" in found[2].message and "users_undated" in found[1].message
    assert BatchTable(spark, roots.tables, USERS).current().count() == 3
    assert [(r.dataset, r.ok) for r in run()] == [("users", False), ("", False)]


def test_command_line_of_a_flat_folder(spark, tmp_path):
    drop(tmp_path / "in", "users_20250120.csv", USERS, user(1, DAYS[0]))
    folders = [f"--{n}={tmp_path / n}" for n in ("landing", "checkpoint", "checked", "tables")]
    assert main(["20250120", f"--source={tmp_path / 'in'}", "--flat", *folders, "--dataset=users"]) == 0
    assert BatchTable(spark, str(tmp_path / "tables"), USERS).current().count() == 1


def test_only_lines_that_begin_as_the_header_are_compared_with_it(spark):
    from tidemark.sources.landing import _is_header

    header = ",".join(USERS.schema.names)
    quoted = "\t" + ",".join(f'"{name}"' for name in USERS.schema.names) + " \r"
    lines = [None, "", header, quoted, f" {header}", f"x{header}", header[:-1], header[0], "1," + header, '"']
    rows = spark.createDataFrame([(line,) for line in lines], "line string").select(_is_header(USERS).alias("is_header"))
    assert [r["is_header"] for r in rows.collect()] == [None, False, True, True, True, False, False, False, False, False]
    plan = rows._jdf.queryExecution().analyzed().toString().lower()
    assert plan.index("startswith(") < plan.index("translate(")  # the dear comparison stands behind the cheap one
