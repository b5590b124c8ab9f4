"""What changed between two days of a history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import same_key
from tidemark.specs import EFF_END, EFF_START, Dataset

KIND, BEFORE, AFTER = "kind", "before", "after"
OPENED, CHANGED, ENDED = "opened", "changed", "closed"


def net_changes(ended: DataFrame, begun: DataFrame, spec: Dataset, first: date, second: date) -> DataFrame:
    """Keys whose valid version differs between two days: ``kind``, the version ``before`` and that ``after``.

    ``ended`` holds at least the versions that ended after the first day and up to the second, ``begun`` at least
    those that began in that time and are valid on the second; versions that came and went in between, or did not
    change, are of no interest and may be there or not.  Of a key there is at most one of each kind left, so the
    join is one to one.
    """
    names = spec.version_schema.names
    start, end = F.col(EFF_START), F.col(EFF_END)
    left = ended.where((start <= F.lit(first)) & (end > F.lit(first)) & (end <= F.lit(second)))
    right = begun.where((start > F.lit(first)) & (start <= F.lit(second)) & (end.isNull() | (end > F.lit(second))))
    old = left.select(F.struct(*names).alias(BEFORE), *(F.col(k).alias(f"_old_{k}") for k in spec.keys))
    new = right.select(F.struct(*names).alias(AFTER), *(F.col(k).alias(f"_new_{k}") for k in spec.keys))
    match = same_key([f"_old_{k}" for k in spec.keys], [f"_new_{k}" for k in spec.keys])
    # a NULL key is a key: what tells the two sides apart is the version
    gone, came = F.col(AFTER).isNull(), F.col(BEFORE).isNull()
    keys = [F.when(came, F.col(f"_new_{k}")).otherwise(F.col(f"_old_{k}")).alias(k) for k in spec.keys]
    kind = F.when(came, F.lit(OPENED)).when(gone, F.lit(ENDED)).otherwise(F.lit(CHANGED))
    return old.join(new, match, "full_outer").select(*keys, kind.alias(KIND), BEFORE, AFTER)
