"""Files and folders as Spark's own file systems know them."""

from __future__ import annotations

from pyspark.sql import SparkSession

# How a partition folder spells NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path
