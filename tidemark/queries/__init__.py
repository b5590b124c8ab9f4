from tidemark.queries import storage, versions  # noqa: F401
from tidemark.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
