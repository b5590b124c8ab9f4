"""Reading CSV deliveries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.specs import Dataset

RAW = "_raw"
REASON = "_reason"


class HeaderMismatch(ValueError):
    """A delivery names other columns, or in another order, than declared."""


def read_csv(spark: SparkSession, path: str, spec: Dataset, match_header: bool = False) -> DataFrame:
    """Typed rows of a delivery; a cell that cannot be read is NULL.

    Columns are bound by position.  With ``match_header`` every file must name the
    declared columns in order, otherwise the read fails.
    """
    return _reader(spark, spec, match_header).schema(spec.schema).csv(path)


def read_checked(spark: SparkSession, path: str, spec: Dataset, match_header: bool = True) -> DataFrame:
    """As :func:`read_csv`, plus ``_raw`` and ``_reason``, which is NULL for good rows.

    A row is refused if it has too few or too many cells, a cell of the wrong type, or
    no value in a required column.
    """
    schema = StructType([*spec.schema.fields, StructField(RAW, StringType())])
    rows = _reader(spark, spec, match_header).option("columnNameOfCorruptRecord", RAW).schema(schema).csv(path)
    return rows.withColumn(REASON, refusal(spec))


def refusal(spec: Dataset) -> Column:
    """Why a row is refused, or NULL."""
    start = F.when(F.col(RAW).isNotNull(), F.lit("malformed"))
    return reduce(lambda c, name: c.when(F.col(name).isNull(), F.lit(f"missing {name}")), spec.required, start)


def separator(spec: Dataset) -> str:
    return spec.csv_options.get("sep") or spec.csv_options.get("delimiter") or ","


def found_header(spark: SparkSession, path: str, spec: Dataset) -> list[str]:
    """Column names in the first line of a delivery; reads one line, not the file."""
    line = spark.read.text(path).first()
    return [] if line is None else [cell.strip().strip('"') for cell in line[0].split(separator(spec))]


def check_header(spark: SparkSession, path: str, spec: Dataset) -> None:
    """Refuse a delivery by its first line, naming the columns that differ."""
    found, declared = found_header(spark, path, spec), spec.schema.names
    if found != declared:
        raise HeaderMismatch(f"{spec.name}: header of {path} is {found}, declared {declared}")


def _reader(spark: SparkSession, spec: Dataset, match_header: bool):
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not match_header)
        .options(**spec.csv_options)
    )
