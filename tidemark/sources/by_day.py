"""Closed versions filed by the days on which they were valid.

Days are numbered from the first a date can have.  A version valid from day s to day e is filed under the smallest dyadic cell that holds both:
its level is the number of the highest bit in which s and e differ, its cell what is left of s without the bits
below.  A day lies in one cell of each level, so the versions valid on it are in a few folders, however many
batches were stored since.  All versions closed by one batch end on the same day and hence fill at most one cell
of each level.

A batch appends its rows under a number of its own, and a marker in the batch's folder names that number.  Writing
the batch again removes the marker; rows of numbers that no marker names are passed over.
"""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.sources.files import file_system
from tidemark.specs import BATCH, EFF_END, EFF_START, Dataset

LEVEL, CELL, RUN = "level", "cell", "run"
MARKER = "_BY_DAY-"
_FIRST = date.min
# 2 ** 24 days are more than any calendar has.
LEVELS = 25


def cell_columns() -> dict[str, Column]:
    before = F.lit((date(1970, 1, 1) - _FIRST).days)
    first, last = F.unix_date(EFF_START) + before, F.unix_date(EFF_END) + before - 1
    differing = first.bitwiseXOR(last)
    level = F.when(differing == 0, F.lit(0)).otherwise(F.length(F.bin(differing)))
    return {LEVEL: level, CELL: F.call_function("shiftright", first, level).cast("long")}


def cells_of(day: date) -> list[tuple[int, int]]:
    number = (day - _FIRST).days
    return [(level, number >> level) for level in range(LEVELS)]


class DayIndex:
    """The filed versions of one table."""

    def __init__(self, spark: SparkSession, location: str, spec: Dataset) -> None:
        self.spark, self.table, self.spec = spark, location, spec
        self.location = f"{location}.by_day"
        self.schema = StructType(
            [
                *spec.version_schema.fields, StructField(BATCH, DateType()), StructField(RUN, StringType()),
                StructField(LEVEL, IntegerType()), StructField(CELL, LongType()),
            ]
        )

    def filed(self) -> dict[date, str]:
        """The number under which each batch's closed versions are filed; one listing."""
        files, path = file_system(self.spark, f"{self.table}/{BATCH}=*/{MARKER}*")
        found = [f.getPath() for f in files.globStatus(path) or []]
        return {date.fromisoformat(p.getParent().getName().split("=", 1)[1]): p.getName().removeprefix(MARKER) for p in found}

    def add(self, closed: DataFrame, batch_date: date) -> None:
        """File the versions that a batch closed; those that never were valid are of no use."""
        run = uuid4().hex
        lasting = closed.where(F.col(EFF_END) > F.col(EFF_START)).select(*self.spec.version_schema.names)
        rows = lasting.withColumns({BATCH: F.lit(batch_date), RUN: F.lit(run), **cell_columns()})
        rows.hint("rebalance", LEVEL).write.mode("append").partitionBy(LEVEL, CELL).parquet(self.location)
        files, marker = file_system(self.spark, f"{self.table}/{BATCH}={batch_date.isoformat()}/{MARKER}{run}")
        files.create(marker, True).close()

    def valid(self, day: date, filed: dict[date, str]) -> DataFrame:
        """Versions valid on a day among those of some batches."""
        paths = []
        for level, cell in cells_of(day):
            files, path = file_system(self.spark, f"{self.location}/{LEVEL}={level}/{CELL}={cell}")
            if files.exists(path):
                paths.append(path.toString())
        if not paths or not filed:
            return self.spark.createDataFrame([], self.spec.version_schema).limit(0)
        rows = self.spark.read.schema(self.schema).option("basePath", self.location).parquet(*paths)
        there = (F.col(EFF_START) <= F.lit(day)) & (F.col(EFF_END) > F.lit(day))
        wanted = self.spark.createDataFrame(list(filed.items()), f"its_batch date, its_{RUN} string")
        same = (F.col(BATCH) == F.col("its_batch")) & (F.col(RUN) == F.col(f"its_{RUN}"))
        return rows.where(there).join(F.broadcast(wanted), same, "left_semi").select(*self.spec.version_schema.names)
