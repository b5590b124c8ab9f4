"""Reading deliveries: cells, headers, refused rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from tidemark.sources import HeaderMismatch, check_header, land, read_checked, read_csv, read_landed
from tidemark.sources.csv import RAW, REASON
from tidemark.specs import PRICE_PLANS, SUBSCRIPTIONS, TRANSACTIONS, USERS, Dataset, columns

HEADER = "price_plan_id,price_plan_name,price,payment_period,price_plan_type"
LINES = [
    "1,basic,9.99,monthly,recurring",
    "2,sport,abc,monthly,recurring",
    "3,premium",
    "4,free_trial,0,weekly,one_time,extra",
    ",basic,10,monthly,recurring",
]


def write(path, *lines, end="\n"):
    path.write_bytes("".join(line + end for line in lines).encode())
    return str(path)


def test_permissive_cells(spark, tmp_path):
    rows = read_csv(spark, write(tmp_path / "p.csv", HEADER, *LINES), PRICE_PLANS).collect()
    assert [r.price_plan_id for r in rows] == [1, 2, 3, 4, None]
    assert [r.price for r in rows] == [Decimal("9.99"), None, None, Decimal("0.00"), Decimal("10.00")]
    assert [r.price_plan_type for r in rows] == ["recurring", "recurring", None, "one_time", "recurring"]


def test_refused_rows_keep_their_line_and_reason(spark, tmp_path):
    rows = read_checked(spark, write(tmp_path / "p.csv", HEADER, *LINES), PRICE_PLANS).collect()
    reasons = [None, "malformed", "malformed", "malformed", "missing price_plan_id"]
    assert [r[REASON] for r in rows] == reasons
    assert [r[RAW] for r in rows] == [None, *LINES[1:4], None]


def test_reading_leaves_the_declared_schema_alone(spark, tmp_path):
    before = list(PRICE_PLANS.schema.names)
    read_checked(spark, write(tmp_path / "p.csv", HEADER, *LINES), PRICE_PLANS)
    assert PRICE_PLANS.schema.names == before


def test_crlf_sample(spark, tmp_path):
    lines = [HEADER, "1,basic,10,monthly,recurring", "4,free_trial,0,weekly,one_time"]
    path = write(tmp_path / "p.csv", *lines, end="\r\n")
    check_header(spark, path, PRICE_PLANS)
    rows = read_checked(spark, path, PRICE_PLANS).collect()
    assert [(r.price_plan_type, r[REASON]) for r in rows] == [("recurring", None), ("one_time", None)]


@pytest.mark.parametrize(
    "header", ["price_plan_name,price_plan_id,price,payment_period,price_plan_type", HEADER.replace("price,", "cost,")]
)
def test_other_headers_are_refused(spark, tmp_path, header):
    path = write(tmp_path / "p.csv", header, LINES[0])
    with pytest.raises(HeaderMismatch):
        check_header(spark, path, PRICE_PLANS)
    with pytest.raises(Exception):
        read_checked(spark, path, PRICE_PLANS).collect()
    assert read_csv(spark, path, PRICE_PLANS).first().price_plan_id == 1


def test_a_wrong_header_in_any_file_is_noticed(spark, tmp_path):
    folder = tmp_path / "delivery"
    folder.mkdir()
    write(folder / "a.csv", HEADER, LINES[0])
    write(folder / "b.csv", HEADER.replace("price,", "cost,"), LINES[0])
    with pytest.raises(Exception):
        read_checked(spark, str(folder), PRICE_PLANS).collect()


def test_a_column_too_many_shifts_nothing(spark, tmp_path):
    header = ",".join(USERS.schema.names).replace("date_of_birth", "city,date_of_birth")
    with pytest.raises(HeaderMismatch, match="city"):
        check_header(spark, write(tmp_path / "u.csv", header), USERS)


def test_types_of_all_datasets(spark, tmp_path):
    path = write(
        tmp_path / "u.csv",
        ",".join(USERS.schema.names),
        "1,ann,1990-05-04,a@x,1,2025-01-20 08:00:00,2025-01-20T09:00:00,true",
        "2,bo,,,,,,",
    )
    rows = read_checked(spark, path, USERS).collect()
    assert rows[0].date_of_birth == date(1990, 5, 4) and rows[0].is_subs_active and rows[0][REASON] is None
    assert rows[1][REASON] == "missing is_subs_active"
    start = "1,2,3,2025-01-20 00:00:00,,,,"
    path = write(tmp_path / "s.csv", ",".join(SUBSCRIPTIONS.schema.names), start, f"{start}soon")
    assert [r[REASON] for r in read_checked(spark, path, SUBSCRIPTIONS).collect()] == [None, "malformed"]
    path = write(tmp_path / "t.csv", ",".join(TRANSACTIONS.schema.names), "1,2,3,4,10.505,2025-01-20 00:00:00,,paid")
    assert read_checked(spark, path, TRANSACTIONS).first().transaction_amount == Decimal("10.51")


def test_empty_delivery(spark, tmp_path):
    path = write(tmp_path / "p.csv", HEADER)
    check_header(spark, path, PRICE_PLANS)
    assert read_checked(spark, path, PRICE_PLANS).count() == 0


def test_landed_lines_parse_like_the_file(spark, tmp_path):
    path = write(tmp_path / "p.csv", HEADER, *LINES)
    day = date(2025, 1, 20)
    for _ in range(2):
        land(spark, path, str(tmp_path / "landing"), day)
    landed = read_landed(spark, str(tmp_path / "landing"), PRICE_PLANS, day)
    direct = read_checked(spark, path, PRICE_PLANS)
    assert sorted(map(tuple, landed.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_landed_file_without_header_is_refused(spark, tmp_path):
    land(spark, write(tmp_path / "p.csv", "id,name", LINES[0]), str(tmp_path / "landing"), date(2025, 1, 20))
    with pytest.raises(HeaderMismatch):
        read_landed(spark, str(tmp_path / "landing"), PRICE_PLANS, date(2025, 1, 20))


def test_specs_are_checked():
    schema = columns({"a": "integer"})
    with pytest.raises(ValueError):
        Dataset("x", schema, "versioned", keys=("a",))
    with pytest.raises(ValueError):
        Dataset("x", schema, "fact", required=("b",))
    with pytest.raises(ValueError):
        Dataset("x", columns({"a": "double"}), "full", keys=("a",))
    with pytest.raises(ValueError):
        Dataset("x", schema, "sometimes")
