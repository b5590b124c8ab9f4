"""Making stored batches known to the catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.sql.types import StructType

from tidemark.sources.keyed import KeyedTable
from tidemark.sources.files import NO_VALUE, file_system
from tidemark.sources.tables import BatchTable
from tidemark.specs import BATCH, CURRENT, STATUS

# Partitions named in one statement.
_TOGETHER = 500


def register_table(table: BatchTable, name: str, batches: Sequence[date] | None = None) -> None:
    """Declare an external table over the stored batches and bring its partitions up to date.

    With ``batches`` only those are looked at, which takes as long as they are large;
    without, the whole table is searched.  Partitions that are gone are dropped either way.
    Of a table kept by key the closed versions and the newest snapshot are declared, that is its history.
    """
    spark, spec = table.spark, table.spec
    levels = (BATCH, *spec.stored_partitions)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(spec.stored_schema)}) USING parquet "
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in levels)}) LOCATION '{table.location}'"
    )
    if isinstance(table, KeyedTable):
        # buckets that a batch writes anew were declared with the batches that held them before
        before = [table.previous(b) for b in table.batches() if batches is None or b in batches]
        batches = sorted({*(batches or table.batches()), *(day for b in before for day in table.layout(b).values())})
    if batches is None:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        return
    held = set(table.held(table.newest()).values()) if isinstance(table, KeyedTable) else None
    for batch_date in batches:
        stored = _stored_partitions(table, batch_date, held)
        known = spark.sql(f"SHOW PARTITIONS {name} PARTITION (`{BATCH}` = '{batch_date.isoformat()}')")
        gone = {row[0] for row in known.collect()} - stored
        for change, partitions in (("DROP IF EXISTS", gone), ("ADD IF NOT EXISTS", stored)):
            joint, clauses = ", " if change.startswith("DROP") else " ", [_clause(p) for p in sorted(partitions)]
            for start in range(0, len(clauses), _TOGETHER):
                spark.sql(f"ALTER TABLE {name} {change} {joint.join(clauses[start : start + _TOGETHER])}")


def _stored_partitions(table: BatchTable, batch_date: date, held: set[str] | None) -> set[str]:
    """The innermost partitions of a batch, as ``level=value/...``; of active versions those in ``held`` folders."""
    levels = table.spec.stored_partitions
    pattern = "/".join([table.batch_path(batch_date), *(f"{c}=*" for c in levels)])
    files, path = file_system(table.spark, pattern)
    folders = [str(f.getPath().toString()) for f in files.globStatus(path) or []]
    partitions = {"/".join(folder.split("/")[-1 - len(levels) :]) for folder in folders}
    if held is None:
        return partitions
    return {p for p in partitions if f"/{STATUS}={CURRENT}/" not in p or f"{table.location}/{p}" in held}


def _clause(partition: str) -> str:
    pairs = (level.split("=", 1) for level in partition.split("/"))
    return f"PARTITION ({', '.join(f'`{column}` = {_literal(value)}' for column, value in pairs)})"


def _literal(value: str) -> str:
    if value == NO_VALUE:
        return "NULL"
    text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
