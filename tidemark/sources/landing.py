"""Deliveries kept as they came: raw lines with their file and batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from tidemark.sources.csv import RAW, REASON, HeaderMismatch, refusal, separator
from tidemark.specs import BATCH, Dataset

ARRIVAL = "arrival"
DATASET = "dataset"

LANDED = StructType(
    [
        StructField("line", StringType()),
        StructField("file_path", StringType()),
        StructField("file_time", TimestampType()),
        StructField(BATCH, DateType()),
        StructField(ARRIVAL, StringType()),
    ]
)


def landed_folder(landing: str, dataset: str) -> str:
    """The landed lines of one dataset among those of all."""
    return f"{landing}/{DATASET}={dataset}"


def raw_lines(lines: DataFrame) -> DataFrame:
    """Lines of a text scan, with the file each came from."""
    return lines.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def land(spark: SparkSession, source: str, landing: str, batch_date: date) -> None:
    """Store the lines of a delivery under its batch; doing it again replaces them."""
    lines = raw_lines(spark.read.text(source))
    write_landed(lines.withColumn(BATCH, F.lit(batch_date)), landing, "batch")


def write_landed(lines: DataFrame, landing: str, arrival: str) -> None:
    """Replace the partitions of one arrival; other arrivals stay.  Lines may name their dataset."""
    levels = [DATASET] if DATASET in lines.columns else []
    (
        lines.withColumn(ARRIVAL, F.lit(arrival))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*levels, BATCH, ARRIVAL)
        .parquet(landing)
    )


def read_lines(spark: SparkSession, landing: str, batch_date: date | None = None) -> DataFrame:
    """Landed lines of all batches, or of one; other batches are not even listed."""
    path = landing if batch_date is None else f"{landing}/{BATCH}={batch_date.isoformat()}"
    return spark.read.schema(LANDED).option("basePath", landing).parquet(path)


def _is_header(spec: Dataset) -> Column:
    sep = separator(spec)
    ignored = "".join(c for c in '" \t\r' if c != sep)
    header = sep.join(spec.schema.names)
    # translating goes character by character, so only lines that begin as the header does are translated
    return F.ltrim("line", F.lit(ignored)).startswith(header[0]) & (F.translate("line", ignored, "") == F.lit(header))


def files_without_header(lines: DataFrame, spec: Dataset) -> DataFrame:
    """Landed files in which no line is the declared header."""
    return lines.groupBy("file_path").agg(F.max(_is_header(spec)).alias("ok")).where(~F.col("ok")).drop("ok")


def parse_landed(lines: DataFrame, spec: Dataset) -> DataFrame:
    """Typed rows of landed lines with ``_raw`` and ``_reason``, as from a checked CSV read."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
    options = {**spec.csv_options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}
    row = F.from_csv(F.col("line"), f"{fields}, `{RAW}` string", options)
    data = lines.where(~_is_header(spec) & (F.col("line") != ""))
    return data.select(row.alias("r")).select("r.*").withColumn(REASON, refusal(spec))


def read_landed(spark: SparkSession, landing: str, spec: Dataset, batch_date: date) -> DataFrame:
    """Parse the landed lines of one batch; a file without the declared header refuses the batch."""
    if str(spec.csv_options.get("multiLine", "")).lower() == "true":
        raise ValueError(f"{spec.name}: rows with line breaks cannot be landed line by line, load the files directly")
    lines = read_lines(spark, landing, batch_date)
    wrong = files_without_header(lines, spec).first()
    if wrong is not None:
        raise HeaderMismatch(f"{spec.name}: {wrong['file_path']} lacks the header {spec.schema.names}")
    return parse_landed(lines, spec)
