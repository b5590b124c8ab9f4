from tidemark.sinks.catalog import register_table
from tidemark.sinks.parquet import drop_old_snapshots, write_all_keyed, write_batch, write_keyed, write_partitioned

__all__ = ["drop_old_snapshots", "register_table", "write_all_keyed", "write_batch", "write_keyed", "write_partitioned"]
