"""Histories kept by key: a batch holds only the buckets that its delivery touched."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import file_system
from tidemark.sources.tables import BatchTable
from tidemark.specs import BUCKET, CURRENT, KEY_HASH, STATUS, Dataset

# Says, beside a batch, in which batch every bucket of its snapshot was written.
LAYOUT = "_LAYOUT"
# Partitions declared in one statement.
_DECLARED = 500


class KeyedTable(BatchTable):
    """As :class:`BatchTable`; the snapshot of a batch is every bucket as it was last written.

    A batch names, for each bucket, the batch that wrote it, so a snapshot is found by one small file however
    many batches there are.
    """

    def layout(self, batch_date: date | None) -> dict[int, date]:
        """The batch that holds each bucket of a snapshot; buckets without rows may be absent."""
        if batch_date is None:
            return {}
        files, path = file_system(self.spark, f"{self.batch_path(batch_date)}/{LAYOUT}")
        opened = files.open(path)
        try:
            stored = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))
        finally:
            opened.close()
        if stored["buckets"] != self.spec.buckets:
            raise ValueError(f"{self.spec.name} is stored in {stored['buckets']} buckets, declared {self.spec.buckets}")
        return {bucket: date.fromisoformat(day) for day, buckets in stored["written"].items() for bucket in buckets}

    def write_layout(self, batch_date: date, layout: Mapping[int, date]) -> None:
        written: dict[str, list[int]] = {}
        for bucket, day in sorted(layout.items()):
            written.setdefault(day.isoformat(), []).append(bucket)
        files, path = file_system(self.spark, f"{self.batch_path(batch_date)}/{LAYOUT}")
        out = files.create(path, True)
        try:
            out.write(bytearray(json.dumps({"buckets": self.spec.buckets, "written": written}), "utf-8"))
        finally:
            out.close()

    def bucket_path(self, batch_date: date, bucket: int) -> str:
        return f"{self.batch_path(batch_date)}/{STATUS}={CURRENT}/{BUCKET}={bucket}"

    def bucket_folders(self, batch_date: date) -> set[int]:
        """Buckets of which a batch holds active rows; one listing."""
        files, path = file_system(self.spark, f"{self.batch_path(batch_date)}/{STATUS}={CURRENT}/{BUCKET}=*")
        return {int(f.getPath().getName().split("=", 1)[1]) for f in files.globStatus(path) or []}

    def held(self, batch_date: date | None) -> dict[int, str]:
        """The folder of every bucket of a snapshot that has rows."""
        layout = self.layout(batch_date)
        there = {day: self.bucket_folders(day) for day in set(layout.values())}
        return {b: self.bucket_path(day, b) for b, day in sorted(layout.items()) if b in there[day]}

    def _current_paths(self, batches: list[date]) -> list[str]:
        return [path for batch_date in batches for path in self.held(batch_date).values()]

    def rows_of(self, folders: list[str]) -> DataFrame:
        """Versions in some bucket folders."""
        return self._scan(folders).select(*self.spec.version_schema.names)

    @contextmanager
    def bucketed(self, folders: Mapping[int, str]) -> Iterator[DataFrame]:
        """The rows of some buckets as a scan that Spark knows to be divided by ``key_hash``.

        Joins on it need no shuffle of the scan.  For that Spark wants a table with buckets, so one is declared in
        the session's catalogue while the frame is in use; it owns no data.
        """
        spark, spec = self.spark, self.spec
        name = f"tidemark_{spec.name}_{uuid4().hex[:12]}"
        fields = [*spec.version_schema.fields, *(f for f in spec.stored_schema.fields if f.name in (KEY_HASH, BUCKET))]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({BUCKET}) "
            f"CLUSTERED BY ({KEY_HASH}) INTO {spec.buckets} BUCKETS LOCATION '{self.location}/_{name}'"
        )
        try:
            parts = [f"PARTITION ({BUCKET} = {b}) LOCATION '{path}'" for b, path in folders.items()]
            for start in range(0, len(parts), _DECLARED):
                spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts[start : start + _DECLARED])}")
            yield spark.table(name).select(*spec.version_schema.names, KEY_HASH)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def stored_table(spark: SparkSession, root: str, spec: Dataset) -> BatchTable:
    """The stored batches of a dataset, kept as its declaration says."""
    return (KeyedTable if spec.buckets else BatchTable)(spark, root, spec)
