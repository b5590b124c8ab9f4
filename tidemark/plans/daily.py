"""The daily run: every dataset's delivery of one date into its stored table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.batches import delivery_path
from tidemark.operators import KeyCounts, count_keys, flag_repeated, flag_unknown, rebuild, step, step_by_key, survey, touched_buckets
from tidemark.operators.hot_keys import BROADCAST_BYTES, ROWS_PER_TASK
from tidemark.plans.repair import rerun
from tidemark.session import OPEN_FILES, prepare, work_folder
from tidemark.sinks import register_table, write_all_keyed, write_batch, write_keyed, write_partitioned
from tidemark.sources import BatchTable, KeyedTable, check_header, land, read_checked, read_landed, stored_table
from tidemark.sources.csv import RAW, REASON
from tidemark.sources.landing import landed_folder
from tidemark.specs import BATCH, CLOSED, CURRENT, DATASETS, FACT, FULL, STATUS, Dataset


_RULE = "_rule"


@dataclass(frozen=True)
class Roots:
    """Where deliveries arrive, where checked rows are kept, and where tables live.

    With ``landing`` deliveries are kept there as raw lines and read from those; without ``deliveries`` too, the
    run reads what has been landed before.
    """

    deliveries: str
    checked: str
    tables: str
    landing: str | None = None

    def landed(self, spec: Dataset) -> str:
        """Where the landed lines of a dataset are."""
        return landed_folder(self.landing, spec.name)


@dataclass(frozen=True)
class LoadReport:
    """What one load did.

    ``stale`` lists later batches that must now be run again, ``repaired`` those that were brought up to date,
    ``unfinished`` earlier ones whose write was lost: the load passed over them, and is to be run again after
    them.  Files without a date have no ``batch_date``.
    """

    dataset: str
    batch_date: date | None
    ok: bool
    message: str = ""
    accepted: int = 0
    refused: int = 0
    current: int = 0
    closed: int = 0
    stale: tuple[date, ...] = ()
    unfinished: tuple[date, ...] = ()
    repaired: tuple[date, ...] = ()


@dataclass(frozen=True)
class Checked:
    """The accepted rows of a delivery and what was counted while checking them."""

    rows: DataFrame
    accepted: int
    refused: int
    partition_values: int


def check_delivery(
    spark: SparkSession,
    spec: Dataset,
    batch_date: date,
    roots: Roots,
    bad_rows: str = "refuse",
    datasets: Sequence[Dataset] = DATASETS,
) -> Checked:
    """Parse a delivery once and keep it as Parquet, refused rows with their reason.

    Everything after this reads columns, not text.  ``bad_rows="null"`` accepts all
    rows, with NULL for the cells that could not be read; of a history, malformed rows without a value in a
    decisive column are refused even so, since the value may have been there.  Rules about several rows or other
    datasets (``unique``, ``references``) are checked on the parsed columns, among rows not refused before; rows
    that break them are refused either way.
    """
    if bad_rows not in ("refuse", "null"):
        raise ValueError(f"bad_rows must be refuse or null, got {bad_rows!r}")
    if roots.landing is not None:
        if roots.deliveries:
            land(spark, delivery_path(roots.deliveries, spec.name, batch_date), roots.landed(spec), batch_date)
        rows = read_landed(spark, roots.landed(spec), spec, batch_date)
    else:
        path = delivery_path(roots.deliveries, spec.name, batch_date)
        check_header(spark, path, spec)
        rows = read_checked(spark, path, spec)

    refused = F.col(REASON).isNotNull()
    if bad_rows == "null":
        lost = reduce(lambda c, name: c | F.col(name).isNull(), spec.decisive, F.lit(False))
        refused = F.col(RAW).isNotNull() & lost
    if spec.unique or spec.references:
        rows = _against_rules(spark, spec, rows, refused, roots, datasets)
        refused = refused | F.coalesce(F.col(REASON).rlike("^(repeated|unknown) "), F.lit(False))
    counted = Observation()
    rows = rows.observe(
        counted,
        F.count_if(~refused).alias("accepted"),
        F.count_if(refused).alias("refused"),
        _partition_values(spec).alias("partition_values"),
    )
    kept = f"{roots.checked}/{spec.name}/{BATCH}={batch_date.isoformat()}"
    write_partitioned(rows, kept)
    checked = spark.read.schema(rows.schema).parquet(kept)
    counts = {"accepted": 0, "refused": 0, "partition_values": 0, **counted.get}
    return Checked(checked.where(~refused).select(*spec.schema.names), **counts)


def _against_rules(
    spark: SparkSession, spec: Dataset, rows: DataFrame, refused: Column, roots: Roots, datasets: Sequence[Dataset]
) -> DataFrame:
    """Rows with the reasons of rules across rows and datasets; refused rows are no party to them."""
    path = work_folder(spark, "parsed")
    rows.write.parquet(path)
    parsed = spark.read.schema(rows.schema).parquet(path)
    party = parsed.where(~refused).withColumn(_RULE, F.lit(None).cast("string"))
    if spec.unique:
        party = flag_repeated(party, spec.unique, _RULE)
    known = {d.name: d for d in datasets}
    for column, name, key in spec.references:
        table = stored_table(spark, roots.tables, known[name])
        newest = table.newest()
        parents = table.current() if known[name].versioned else table.read([] if newest is None else [newest])
        party = flag_unknown(party, [column], parents, [key], _RULE, f"unknown {column}")
    party = party.withColumn(REASON, F.coalesce(_RULE, REASON)).drop(_RULE)
    return party.unionByName(parsed.where(refused))


def _partition_values(spec: Dataset) -> Column:
    """About how many partition values there are; decides file layout, nothing else."""
    inner = [name for name in spec.partition_by if name in spec.schema.names]
    return F.approx_count_distinct(F.struct(*inner)) if inner else F.lit(0).cast("long")


def refused_rows(spark: SparkSession, spec: Dataset, batch_date: date, roots: Roots) -> DataFrame:
    """The rows of a checked delivery with a cell or value amiss, and what; not loaded unless as NULL."""
    kept = f"{roots.checked}/{spec.name}/{BATCH}={batch_date.isoformat()}"
    schema = StructType([*spec.schema.fields, StructField(RAW, StringType()), StructField(REASON, StringType())])
    return spark.read.schema(schema).parquet(kept).where(F.col(REASON).isNotNull())


def load_full(table: BatchTable, rows: DataFrame, batch_date: date) -> None:
    """The delivery is the whole new state."""
    write_batch(rows, table, batch_date)


def load_fact(table: BatchTable, rows: DataFrame, batch_date: date, partition_values: int | None = None) -> None:
    """The delivery is one more day of rows; nothing is merged or deduplicated.

    A task can write a few partition values side by side, so only if there are more are rows brought together.
    """
    if partition_values is None:
        partition_values = rows.agg(_partition_values(table.spec)).first()[0]
    write_batch(rows, table, batch_date, gather=partition_values > OPEN_FILES)


# Snapshots above this size are worth reading twice to keep most of them out of the shuffle.
LARGE_SNAPSHOT = 1024 * 1024 * 1024


def load_versions(
    table: BatchTable,
    rows: DataFrame,
    batch_date: date,
    total: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    large_snapshot: int = LARGE_SNAPSHOT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> dict[str, int]:
    """One type 2 step from the previous snapshot, written as one batch in one pass.

    Earlier batches are only read, so the batch can be run again.  ``total`` is the
    number of delivered rows, if known: few rows need no count per key.
    """
    spec = table.spec
    previous = table.previous(batch_date)
    if previous is None and (left := table.unfinished(batch_date)):
        raise LookupError(f"{spec.name}: no finished batch before {batch_date}, but unfinished ones: {left}")
    if isinstance(table, KeyedTable):
        written = _load_by_key(table, rows, batch_date, previous, total, rows_per_task)
        return _filed(table, written)
    existing = table.snapshot(previous)
    large = estimated_bytes(existing) > large_snapshot
    if total is not None and total <= rows_per_task and not large:
        counts = KeyCounts.few(rows, spec.keys, total, rows_per_task)
    else:
        counts = count_keys(rows, spec.keys)
    stepped, counted = _counted(step(existing, rows, spec, batch_date, counts, rows_per_task, large, broadcast_bytes))
    write_batch(stepped, table, batch_date)
    return _filed(table, {name: counted.get.get(name, 0) for name in (CURRENT, CLOSED)})


def _filed(table: BatchTable, written: dict[str, int]) -> dict[str, int]:
    if table.spec.by_day:
        table.file_by_day()
    return written


def _counted(stepped: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and how many of each status there were once they are written."""
    counted = Observation()
    sizes = (F.count_if(F.col(STATUS) == status).alias(status) for status in (CURRENT, CLOSED))
    return stepped.observe(counted, *sizes), counted


def _load_by_key(
    table: KeyedTable, rows: DataFrame, batch_date: date, previous: date | None, total: int | None, rows_per_task: int
) -> dict[str, int]:
    """The step over the buckets that the delivery touches; the report counts the rows of those."""
    spec = table.spec
    if total is not None and total <= rows_per_task:
        counts = KeyCounts.few(rows, spec.keys, total, rows_per_task)
    else:
        counts = count_keys(rows, spec.keys)
    touched = touched_buckets(rows, spec)
    held = {b: path for b, path in table.held(previous).items() if b in touched}
    with table.bucketed(held) as existing:
        stepped, counted = _counted(step_by_key(existing, rows, spec, batch_date, counts, rows_per_task))
        write_keyed(stepped, table, batch_date, touched, previous)
    return {name: counted.get.get(name, 0) for name in (CURRENT, CLOSED)}


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate, for a scan the size of its files; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def load_dataset(
    spark: SparkSession,
    spec: Dataset,
    batch_date: date,
    roots: Roots,
    bad_rows: str = "refuse",
    limits: Mapping[str, int] | None = None,
    repair: bool = False,
    datasets: Sequence[Dataset] = DATASETS,
) -> LoadReport:
    """Check and load one dataset; an error is reported, not raised, so that other loads go on.

    ``limits`` are ``rows_per_task``, ``large_snapshot`` and ``broadcast_bytes`` of :func:`load_versions`.  With
    ``repair`` later batches of a history are brought up to date, without it they are reported as stale.
    """
    table = stored_table(spark, roots.tables, spec)
    try:
        checked = check_delivery(spark, spec, batch_date, roots, bad_rows, datasets)
        written, repaired = {}, ()
        if spec.load == FULL:
            load_full(table, checked.rows, batch_date)
        elif spec.load == FACT:
            load_fact(table, checked.rows, batch_date, checked.partition_values)
        elif repair:
            load = lambda: written.update(load_versions(table, checked.rows, batch_date, checked.accepted, **(limits or {})))
            repaired = rerun(table, batch_date, load, checked.rows)
        else:
            written = load_versions(table, checked.rows, batch_date, checked.accepted, **(limits or {}))
        unfinished = tuple(table.unfinished(batch_date)) if spec.versioned else ()
    except Exception as error:
        return LoadReport(spec.name, batch_date, ok=False, message=f"{type(error).__name__}: {error}")
    stale = tuple(table.batches(after=batch_date)) if spec.versioned and not repair else ()
    counts = {"accepted": checked.accepted, "refused": checked.refused, **written}
    return LoadReport(spec.name, batch_date, True, **counts, stale=stale, unfinished=unfinished, repaired=repaired)


def run_batch(
    spark: SparkSession,
    batch_date: date,
    roots: Roots,
    datasets: Sequence[Dataset] = DATASETS,
    bad_rows: str = "refuse",
    catalog: str | None = None,
    limits: Mapping[str, int] | None = None,
    repair: bool = False,
) -> list[LoadReport]:
    """Load all datasets of one date side by side, those that refer to others after them, then register what was loaded.

    ``catalog`` is the database for the tables; without it nothing is registered.  ``limits`` and ``repair`` as
    for :func:`load_dataset`.
    """
    prepare(spark)
    load = lambda spec: load_dataset(spark, spec, batch_date, roots, bad_rows, limits, repair, datasets)
    loaded: dict[str, LoadReport] = {}
    for wave in _waves(datasets):
        with ThreadPoolExecutor(max_workers=len(wave)) as pool:
            loaded.update(zip((spec.name for spec in wave), pool.map(load, wave)))
    reports = [loaded[spec.name] for spec in datasets]
    if catalog is not None:
        register_loaded(spark, roots, datasets, reports, catalog)
    return reports


def _waves(datasets: Sequence[Dataset]) -> list[list[Dataset]]:
    """Datasets that can be loaded side by side, after those they refer to."""
    waves: list[list[Dataset]] = []
    left = list(datasets)
    while left:
        names = {spec.name for spec in left}
        ready = [spec for spec in left if not names & {name for _, name, _ in spec.references if name != spec.name}]
        waves.append(ready or left)  # those that refer to each other go together
        left = [spec for spec in left if spec not in waves[-1]]
    return waves


def register_loaded(
    spark: SparkSession, roots: Roots, datasets: Sequence[Dataset], reports: Sequence[LoadReport], catalog: str
) -> None:
    """Register the batches that were loaded."""
    for spec in datasets:
        loaded = [day for r in reports if r.ok and r.dataset == spec.name for day in (r.batch_date, *r.repaired)]
        if loaded:
            register_table(stored_table(spark, roots.tables, spec), f"{catalog}.{spec.name}", loaded)


def backfill(table: BatchTable, versions: DataFrame, batch: str) -> bool:
    """Store a whole history in one pass, as the batch of its last delivery.

    Versions may have arrived in any order.  Returns False, having written nothing, if there are no deliveries.
    Rows without a delivery date, and a table that has batches already, are errors.
    """
    if stored := table.batches():
        raise ValueError(f"{table.spec.name} has batches from {stored[0]} to {stored[-1]}; a back-fill would repeat them")
    surveyed = survey(versions, table.spec, batch)
    if surveyed.last is None:
        return False
    history = rebuild(versions, table.spec, batch, surveyed=surveyed)
    if isinstance(table, KeyedTable):
        write_all_keyed(history, table, surveyed.last)
    else:
        write_batch(history, table, surveyed.last)
    _filed(table, {})
    return True
