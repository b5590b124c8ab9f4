"""What the engine knows about a dataset: columns, keys, version order, activity."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

EFF_START = "eff_start_date"
EFF_END = "eff_end_date"
STATUS = "status"
CURRENT = "current"
CLOSED = "closed"
BATCH = "batch_dt"
KEY_HASH = "key_hash"
BUCKET = "bucket"

_FLOATING = ("float", "double")

FULL = "full"
FACT = "fact"
VERSIONED = "versioned"


def columns(types: Mapping[str, str]) -> StructType:
    """``{"user_id": "integer", ...}`` as a schema."""
    schema = StructType()
    for name, type_name in types.items():
        schema = schema.add(name, type_name)
    return schema


@dataclass(frozen=True)
class Dataset:
    """One table and how its daily delivery is loaded.

    ``load`` is ``full`` (the delivery is the whole new state), ``fact`` (the
    delivery is one more day of rows) or ``versioned`` (type 2 history).  For a
    versioned dataset ``keys`` name the entity, ``version_order`` and then
    ``ties`` say which of two versions is newer, and ``active`` is a SQL
    condition; a version whose condition is false or NULL is not active.
    ``partition_by`` adds partition levels below the batch.  ``buckets`` keeps a versioned dataset by key: its
    rows lie in so many buckets by a hash of their key, and a batch writes only those that its keys fall into.

    ``by_day`` also files closed versions by the days on which they were valid, for reads as of a day long ago.

    ``unique`` columns must not repeat together within a delivery, and a value of a ``references`` column (column,
    dataset, its column) must stand in the stored state of that dataset; rows that break a rule are refused.
    """

    name: str
    schema: StructType
    load: str
    keys: tuple[str, ...] = ()
    version_order: str | None = None
    ties: tuple[str, ...] = ()
    active: str | None = None
    required: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    csv_options: Mapping[str, str] = field(default_factory=dict, hash=False)
    buckets: int = 0
    by_day: bool = False
    unique: tuple[str, ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()

    def __post_init__(self) -> None:
        if self.load not in (FULL, FACT, VERSIONED):
            raise ValueError(f"{self.name}: unknown load {self.load!r}")
        if self.load == VERSIONED and not (self.keys and self.version_order and self.active):
            raise ValueError(f"{self.name}: a versioned dataset needs keys, version_order and active")
        if self.buckets and (self.load != VERSIONED or self.partition_by):
            raise ValueError(f"{self.name}: only a versioned dataset without further levels is kept by key")
        floating = [k for k in self.keys if k in self.schema.names and self.schema[k].dataType.typeName() in _FLOATING]
        if floating:
            raise ValueError(f"{self.name}: floating point keys {floating}")
        known = {*self.schema.names, EFF_START}
        named = {*self.keys, *self.ties, *self.required, *self.partition_by, *self.unique}
        named |= {column for column, _, _ in self.references}
        if self.version_order:
            named.add(self.version_order)
        if named - known:
            raise ValueError(f"{self.name}: unknown columns {sorted(named - known)}")

    @property
    def decisive(self) -> tuple[str, ...]:
        """Columns that decide what becomes of a row of a history: keys, version order, activity."""
        if not self.versioned:
            return ()
        read = set(re.findall(r"\w+", self.active)) | {*self.keys, self.version_order}
        return tuple(name for name in self.schema.names if name in read)

    @property
    def versioned(self) -> bool:
        return self.load == VERSIONED

    @property
    def version_schema(self) -> StructType:
        """Delivered columns followed by the validity interval."""
        return StructType(
            [*self.schema.fields, StructField(EFF_START, DateType()), StructField(EFF_END, DateType())]
        )

    @property
    def stored_schema(self) -> StructType:
        """Columns of the stored table in the order a reader sees them."""
        body = self.version_schema if self.versioned else self.schema
        inner = [body[name] for name in self.partition_by]
        levels = [StructField(BATCH, DateType())]
        if self.versioned:
            levels.append(StructField(STATUS, StringType()))
        plain = [f for f in body.fields if f.name not in self.partition_by]
        if self.buckets:
            plain.append(StructField(KEY_HASH, LongType()))
            inner = [StructField(BUCKET, IntegerType())]
        return StructType([*plain, *levels, *inner])

    @property
    def stored_partitions(self) -> tuple[str, ...]:
        """Partition levels below the batch directory."""
        inner = (BUCKET,) if self.buckets else self.partition_by
        return ((STATUS,) if self.versioned else ()) + inner


# Names, columns and order of the delivered files, and the keys, version order and
# activity condition of their histories.

PRICE_PLANS = Dataset(
    name="price_plans",
    schema=columns(
        {
            "price_plan_id": "integer",
            "price_plan_name": "string",
            "price": "decimal(18,2)",
            "payment_period": "string",
            "price_plan_type": "string",
        }
    ),
    load=FULL,
    keys=("price_plan_id",),
    required=("price_plan_id",),
)

SUBSCRIPTIONS = Dataset(
    name="subscriptions",
    schema=columns(
        {
            "user_id": "integer",
            "price_plan_id": "integer",
            "subs_id": "integer",
            "subs_start_timestamp": "timestamp",
            "subs_end_timestamp": "timestamp",
            "create_timestamp": "timestamp",
            "update_timestamp": "timestamp",
            "subs_cancel_timestamp": "timestamp",
        }
    ),
    load=VERSIONED,
    keys=("user_id", "subs_id"),
    version_order="subs_start_timestamp",
    ties=("update_timestamp",),
    active="subs_cancel_timestamp IS NULL",
    required=("user_id", "subs_id"),
)

TRANSACTIONS = Dataset(
    name="transactions",
    schema=columns(
        {
            "transaction_id": "integer",
            "user_id": "integer",
            "subs_id": "integer",
            "price_plan_id": "integer",
            "transaction_amount": "decimal(18,2)",
            "transaction_created_timestamp": "timestamp",
            "transaction_updated_timestamp": "timestamp",
            "transaction_status": "string",
        }
    ),
    load=FACT,
    required=("transaction_id",),
    partition_by=("price_plan_id",),
)

USERS = Dataset(
    name="users",
    schema=columns(
        {
            "user_id": "integer",
            "user_name": "string",
            "date_of_birth": "date",
            "email": "string",
            "mobile": "string",
            "user_created_timestamp": "timestamp",
            "user_updated_timestamp": "timestamp",
            "is_subs_active": "boolean",
        }
    ),
    load=VERSIONED,
    keys=("user_id",),
    version_order="user_updated_timestamp",
    active="is_subs_active",
    required=("user_id", "is_subs_active"),
)

DATASETS = (PRICE_PLANS, SUBSCRIPTIONS, TRANSACTIONS, USERS)
