"""Stored tables: one directory per batch, visible once its write has finished."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.changes import net_changes
from tidemark.operators.versions import as_of
from tidemark.sources.by_day import DayIndex
from tidemark.sources.files import NO_VALUE, file_system
from tidemark.specs import BATCH, CLOSED, CURRENT, STATUS, Dataset

# Written by the engine after a batch's write has returned; committers may leave out their own marker.
FINISHED = "_FINISHED"
COMMITTED = "_SUCCESS"
# Marks a batch whose current rows were deleted.
DROPPED = "_SNAPSHOT_DROPPED"


# Look-ups that run side by side; on object stores each is a request.
_LOOKUPS = 16


def batch_folders(spark: SparkSession, root: str) -> list[date]:
    """Dates of all batch folders, finished or not; one listing."""
    files, path = file_system(spark, f"{root}/{BATCH}=*")
    values = {f.getPath().getName().split("=", 1)[1] for f in files.globStatus(path) or []}
    return sorted(date.fromisoformat(value) for value in values - {NO_VALUE})


def batches_with(spark: SparkSession, root: str, batches: list[date], entry: str) -> list[date]:
    """Those of the batches whose folder contains a file or folder."""

    def contains(batch_date: date) -> bool:
        files, path = file_system(spark, f"{root}/{BATCH}={batch_date.isoformat()}/{entry}")
        return files.exists(path)

    if len(batches) < 2:
        return [b for b in batches if contains(b)]
    with ThreadPoolExecutor(_LOOKUPS) as pool:
        return [b for b, found in zip(batches, pool.map(contains, batches)) if found]


class BatchTable:
    """The stored batches of one dataset below ``<root>/<dataset>``."""

    def __init__(self, spark: SparkSession, root: str, spec: Dataset) -> None:
        self.spark = spark
        self.spec = spec
        self.location = f"{root.rstrip('/')}/{spec.name}"

    def batch_path(self, batch_date: date) -> str:
        return f"{self.location}/{BATCH}={batch_date.isoformat()}"

    def batches(self, after: date | None = None) -> list[date]:
        """Finished batches, oldest first, of all dates or of those after one."""
        dates = [b for b in self._folders() if after is None or b > after]
        return self._finished(dates)

    def unfinished(self, before: date) -> list[date]:
        """Batch folders before a date, after the newest finished one, that a lost write left behind."""
        dates, newest = [b for b in self._folders() if b < before], self.previous(before)
        return [b for b in dates if newest is None or b > newest]

    def newest(self) -> date | None:
        return self._newest(self._folders())

    def previous(self, batch_date: date) -> date | None:
        """The newest finished batch before a date, so a day without delivery breaks nothing."""
        return self._newest([b for b in self._folders() if b < batch_date])

    def _newest(self, dates: list[date]) -> date | None:
        return next((b for b in reversed(dates) if self._finished([b])), None)

    def _finished(self, batches: list[date]) -> list[date]:
        marked = set(self._with(batches, FINISHED))
        marked.update(self._with([b for b in batches if b not in marked], COMMITTED))
        return [b for b in batches if b in marked]

    def _folders(self) -> list[date]:
        return batch_folders(self.spark, self.location)

    def _with(self, batches: list[date], entry: str) -> list[date]:
        return batches_with(self.spark, self.location, batches, entry)

    def read(self, batches: list[date]) -> DataFrame:
        """All rows of the given batches."""
        return self._scan([self.batch_path(b) for b in batches])

    def _scan(self, paths: list[str]) -> DataFrame:
        """Rows with the declared schema, which also holds where no file was written."""
        if not paths:
            return self.spark.createDataFrame([], self.spec.stored_schema).limit(0)
        return self.spark.read.schema(self.spec.stored_schema).option("basePath", self.location).parquet(*paths)

    def _status_paths(self, status: str, batches: list[date]) -> list[str]:
        """Folders of one status; naming them keeps Spark from listing the others."""
        return [f"{self.batch_path(b)}/{STATUS}={status}" for b in self._with(batches, f"{STATUS}={status}")]

    def snapshot(self, batch_date: date | None) -> DataFrame:
        """The active versions after a batch, or none without a batch."""
        batches = [] if batch_date is None else [batch_date]
        if self.dropped(batches):
            raise LookupError(f"{self.spec.name}: the snapshot of {batch_date} was dropped")
        return self._scan(self._current_paths(batches)).select(*self.spec.version_schema.names)

    def dropped(self, batches: list[date]) -> list[date]:
        """Those of the batches whose snapshot was deleted."""
        return self._with(batches, DROPPED)

    def _current_paths(self, batches: list[date]) -> list[str]:
        """Folders of the active versions after a batch (one or none)."""
        return self._status_paths(CURRENT, batches)

    def current(self) -> DataFrame:
        """The active versions after the newest batch."""
        return self.snapshot(self.newest())

    def history(self) -> DataFrame:
        """Every version once: closed ones of all batches and the newest current ones."""
        return self._versions(self.batches())

    def as_of(self, day: date) -> DataFrame:
        """The versions valid on a day.

        A version is closed no earlier than the day it ends, so only later batches can
        hold closed versions that were still valid on that day.  Where those are filed by day, the few folders of
        that day are read in place of theirs.
        """
        newest = self.newest()
        batches = [] if newest is None else sorted({*self.batches(after=day), newest})
        filed = {b: run for b, run in self.day_index().filed().items() if b in batches} if self.spec.by_day else {}
        paths = self._status_paths(CLOSED, [b for b in batches if b not in filed]) + self._current_paths(batches[-1:])
        later = as_of(self._scan(paths).select(*self.spec.version_schema.names), day)
        return later.unionByName(self.day_index().valid(day, filed)) if filed else later

    def day_index(self) -> DayIndex:
        return DayIndex(self.spark, self.location, self.spec)

    def file_by_day(self) -> list[date]:
        """File the closed versions of all batches that are not filed yet; returns those batches."""
        filed = self.day_index().filed()
        todo = [b for b in self.batches() if b not in filed]
        for batch_date in todo:
            closed = self._scan(self._status_paths(CLOSED, [batch_date]))
            self.day_index().add(closed, batch_date)
        return todo

    def changes(self, first: date, second: date) -> DataFrame:
        """Keys whose valid version differs between two days, see :func:`net_changes`.

        Versions that ended in between are in the closed rows of the batches in between.  Those that began then and
        are valid on the second day are in the snapshot of that day, of which only rows that began after the first
        day are read on.  Nothing else is read: no other snapshot, no earlier or later closed rows.
        """
        if second < first:
            raise ValueError(f"{second} is before {first}")
        batches = [b for b in self.batches(after=first) if b <= second]
        ended = self._scan(self._status_paths(CLOSED, batches))
        begun = self.snapshot(batches[-1]) if batches else self._scan([])
        return net_changes(ended, begun, self.spec, first, second)

    def _versions(self, batches: list[date]) -> DataFrame:
        """Closed versions of the given batches and current ones of the last."""
        paths = self._status_paths(CLOSED, batches) + self._current_paths(batches[-1:])
        return self._scan(paths).select(*self.spec.version_schema.names, STATUS)
