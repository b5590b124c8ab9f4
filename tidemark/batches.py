"""Batch dates."""

from __future__ import annotations

import re
from datetime import date, datetime


def parse_batch_date(text: str) -> date:
    """``yyyymmdd`` as a date; anything but eight digits is refused."""
    if not re.fullmatch(r"[0-9]{8}", text):
        raise ValueError(f"batch date must be yyyymmdd, got {text!r}")
    return datetime.strptime(text, "%Y%m%d").date()


def compact(batch_date: date) -> str:
    return batch_date.strftime("%Y%m%d")


def delivery_path(root: str, dataset: str, batch_date: date) -> str:
    """Where the delivery of one dataset and day is expected."""
    return f"{root.rstrip('/')}/{dataset}_{compact(batch_date)}.csv"
