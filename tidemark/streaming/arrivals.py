"""Picking up new delivery files, each exactly once."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import LoadReport, Roots, load_dataset, register_loaded
from tidemark.session import prepare
from tidemark.sources.landing import ARRIVAL, DATASET, LANDED, landed_folder, raw_lines, write_landed
from tidemark.sources.files import NO_VALUE, file_system
from tidemark.sources.tables import batch_folders, batches_with
from tidemark.specs import BATCH, DATASETS, Dataset

# Spark passes over files that are older than the newest one seen by more than this; no file is.
MAX_FILE_AGE = "3650000d"
# Marks a landed arrival whose batch was loaded with it.
LOADED = "_LOADED"


def land_arrivals(
    spark: SparkSession,
    source: str,
    landing: str,
    checkpoint: str,
    batch_date: date | None = None,
    files_per_trigger: int | None = None,
    landed: Callable[[str], None] | None = None,
    patterns: Mapping[str, str] | None = None,
) -> None:
    """Land all files below ``source`` that no earlier call has landed, then return.

    With ``patterns`` files of several datasets lie side by side: each belongs to the first dataset whose pattern
    its name below ``source`` matches, and is landed below that; files that match none are kept apart.

    The checkpoint remembers the files.  Each micro-batch replaces its own arrival
    partition, so one that is run again after a failure lands its files once; partitions are named by
    checkpoint too, so another checkpoint never replaces them.  The
    batch is ``batch_date`` or else the ``_yyyymmdd`` in the file's path; files with neither
    are kept without a batch.  ``landed`` is called with the arrival before the
    micro-batch counts as done.
    """
    files = spark.readStream.option("recursiveFileLookup", True).option("maxFileAge", MAX_FILE_AGE)
    if files_per_trigger is not None:
        files = files.option("maxFilesPerTrigger", files_per_trigger)
    if batch_date is not None:
        batch = F.lit(batch_date)
    else:
        stamp = F.regexp_extract("file_path", r"_(\d{8})\.csv", 1)
        batch = F.try_to_date(stamp, "yyyyMMdd")
    lines = raw_lines(files.text(source)).withColumn(BATCH, batch)
    if patterns is not None:
        _, folder = file_system(spark, source)
        name = F.regexp_extract("file_path", f"\\Q{folder.toUri().getRawPath().rstrip('/')}\\E/+(.*)$", 1)
        lines = lines.withColumn(DATASET, dataset_of(name, patterns))

    def store(micro_batch: DataFrame, epoch: int) -> None:
        arrival = f"{_identity(spark, checkpoint)}-epoch-{epoch:06d}"
        write_landed(micro_batch, landing, arrival)
        if landed is not None:
            landed(arrival)

    (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def dataset_of(name: Column, patterns: Mapping[str, str]) -> Column:
    """The dataset whose pattern a file's name matches as a whole, or NULL."""
    return F.coalesce(*(F.when(name.rlike(f"^(?:{pattern})$"), F.lit(dataset)) for dataset, pattern in patterns.items()))


def _identity(spark: SparkSession, checkpoint: str) -> str:
    """The start of the identifier that Spark keeps in a checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"].split("-")[0]


def arrival_folders(spark: SparkSession, landing: str, batch: str = "*", entry: str = "") -> set[str]:
    """Folders of landed arrivals with a batch, or of those that contain an entry."""
    files, path = file_system(spark, f"{landing}/{BATCH}={batch}/{ARRIVAL}=*{entry and '/' + entry}")
    found = [f.getPath() for f in files.globStatus(path) or []]
    return {(p.getParent() if entry else p).toString() for p in found}


def waiting_batches(spark: SparkSession, landing: str) -> list[date]:
    """Batches with an arrival that no successful load has read."""
    waiting = arrival_folders(spark, landing) - arrival_folders(spark, landing, entry=LOADED)
    values = {folder.rsplit("/", 2)[1].split("=", 1)[1] for folder in waiting}
    return sorted(date.fromisoformat(value) for value in values - {NO_VALUE})


def undated_files(spark: SparkSession, landing: str) -> list[str]:
    """Some of the landed files that belong to no batch, because neither caller nor name gives a date."""
    return _some_files(spark, landing, f"{landing}/{BATCH}={NO_VALUE}")


def unmatched_files(spark: SparkSession, landing: str) -> list[str]:
    """Some of the landed files whose names fit no dataset's pattern."""
    folder = landed_folder(landing, NO_VALUE)
    return _some_files(spark, folder, folder)


def _some_files(spark: SparkSession, base: str, folder: str) -> list[str]:
    files, path = file_system(spark, folder)
    if not files.exists(path):
        return []
    rows = spark.read.schema(LANDED).option("basePath", base).parquet(folder).select("file_path").distinct()
    return sorted(r["file_path"] for r in rows.limit(5).collect())


def batches_of(spark: SparkSession, landing: str, arrival: str | None = None) -> list[date]:
    """Landed batch dates, oldest first, of all arrivals or of one; lists folders, reads no file."""
    batches = batch_folders(spark, landing)
    return batches if arrival is None else batches_with(spark, landing, batches, f"{ARRIVAL}={arrival}")


def run_arrivals(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    roots: Roots,
    datasets: Sequence[Dataset] = DATASETS,
    batch_date: date | None = None,
    bad_rows: str = "refuse",
    catalog: str | None = None,
    limits: Mapping[str, int] | None = None,
) -> list[LoadReport]:
    """Land what is new below ``<source>/<dataset>`` and load the batches it belongs to.

    A batch that gets further files later is loaded again as a whole.
    Batches are tried again until a load has read all their arrivals.  Files without a date are
    reported by every call: they are landed, but belong to no batch.
    """
    prepare(spark)
    loads = _Loads(spark, roots, datasets, bad_rows, limits)
    for spec in datasets:
        land_arrivals(
            spark, f"{source}/{spec.name}", roots.landed(spec), f"{checkpoint}/{spec.name}", batch_date,
            landed=lambda arrival, spec=spec: loads.of_arrival(spec, arrival),
        )
        loads.waiting(spec)
    if catalog is not None:
        register_loaded(spark, roots, datasets, loads.reports, catalog)
    return loads.reports


def run_flat_arrivals(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    roots: Roots,
    datasets: Sequence[Dataset] = DATASETS,
    batch_date: date | None = None,
    bad_rows: str = "refuse",
    catalog: str | None = None,
    limits: Mapping[str, int] | None = None,
    patterns: Mapping[str, str] | None = None,
    files_per_trigger: int | None = None,
) -> list[LoadReport]:
    """As :func:`run_arrivals` for one folder in which the files of all datasets lie side by side.

    One stream watches it, a bounded number of files at a time, and tells datasets apart by ``patterns`` of file
    names below the folder, by default ``<dataset>_<anything>.csv``, a file or a folder of files.  Files that fit
    none are landed and reported by every call.
    """
    prepare(spark)
    loads = _Loads(spark, roots, datasets, bad_rows, limits)
    patterns = patterns or {spec.name: rf"{re.escape(spec.name)}_[^/]*\.csv(/[^/]*)?" for spec in datasets}

    def load_arrival(arrival: str) -> None:
        for spec in datasets:
            loads.of_arrival(spec, arrival)

    land_arrivals(spark, source, roots.landing, checkpoint, batch_date, files_per_trigger, load_arrival, patterns)
    for spec in datasets:
        loads.waiting(spec)
    if unmatched := unmatched_files(spark, roots.landing):
        loads.reports.append(LoadReport("", None, ok=False, message=f"files such as {unmatched} fit no dataset"))
    if catalog is not None:
        register_loaded(spark, roots, datasets, loads.reports, catalog)
    return loads.reports


class _Loads:
    """Loads of what has arrived, and their reports."""

    def __init__(self, spark: SparkSession, roots: Roots, datasets: Sequence[Dataset], bad_rows: str, limits: Mapping[str, int] | None) -> None:
        self.spark, self.roots, self.datasets, self.bad_rows, self.limits = spark, roots, datasets, bad_rows, limits
        self.reports: list[LoadReport] = []

    def of_arrival(self, spec: Dataset, arrival: str) -> None:
        self._load(spec, batches_of(self.spark, self.roots.landed(spec), arrival))

    def waiting(self, spec: Dataset) -> None:
        """Batches that an earlier call did not load; files without a date are reported."""
        landing = self.roots.landed(spec)
        done = {r.batch_date for r in self.reports if r.dataset == spec.name}
        self._load(spec, [batch for batch in waiting_batches(self.spark, landing) if batch not in done])
        if undated := undated_files(self.spark, landing):
            message = f"no date in the names of files such as {undated}"
            self.reports.append(LoadReport(spec.name, None, ok=False, message=message))

    def _load(self, spec: Dataset, batches: list[date]) -> None:
        for batch in batches:
            arrived = arrival_folders(self.spark, self.roots.landed(spec), batch.isoformat())
            report = load_dataset(self.spark, spec, batch, self.roots, self.bad_rows, self.limits, datasets=self.datasets)
            self.reports.append(report)
            for folder in arrived if report.ok else ():
                files, marker = file_system(self.spark, f"{folder}/{LOADED}")
                files.create(marker, True).close()
