"""Union of stored and delivered rows."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType, decisive: Collection[str] = ()) -> DataFrame:
    """Cast columns to the declared types.

    A value that does not fit becomes NULL, except in a ``decisive`` column, where it is an error: there NULL
    would mean something else, such as that a subscription was never cancelled.
    """
    declared = {f.name: f.dataType for f in schema.fields}

    def fitted(name: str) -> Column:
        value = F.col(name).try_cast(declared[name])
        if name not in decisive:
            return value
        message = F.concat(F.lit(f"{name} does not fit {declared[name].simpleString()}: "), F.col(name).cast("string"))
        return F.when(F.col(name).isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)

    casts = {
        f.name: fitted(f.name)
        for f in df.schema.fields
        if f.name in declared and f.dataType != declared[f.name]
    }
    return df.withColumns(casts) if casts else df


def with_misfits(df: DataFrame, schema: StructType, columns: Collection[str], reason: str) -> DataFrame:
    """Rows cast to the declared types, with a ``reason`` where a value of one of ``columns`` does not fit, else NULL.

    The value itself is kept in the reason, so that refused rows show what came.
    """
    misfit = F.lit(None).cast("string")
    for f in schema.fields:
        if f.name in columns and f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            lost = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            text = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), F.col(f.name).cast("string"))
            misfit = F.coalesce(misfit, F.when(lost, text))
    return conform(df.withColumn(reason, misfit), schema)


def union_by_name(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both, columns matched by name, delivered columns cast to the stored types.

    A column missing on either side is an error.
    """
    return existing.unionByName(conform(incoming, existing.schema))
