from tidemark.plans.daily import (
    LoadReport,
    Roots,
    backfill,
    check_delivery,
    load_dataset,
    load_fact,
    load_full,
    load_versions,
    refused_rows,
    register_loaded,
    run_batch,
)
from tidemark.plans.repair import rerun

__all__ = [
    "LoadReport",
    "Roots",
    "backfill",
    "check_delivery",
    "load_dataset",
    "load_fact",
    "load_full",
    "load_versions",
    "refused_rows",
    "register_loaded",
    "rerun",
    "run_batch",
]
