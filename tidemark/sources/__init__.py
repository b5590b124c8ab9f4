from tidemark.sources.csv import HeaderMismatch, check_header, read_checked, read_csv
from tidemark.sources.keyed import KeyedTable, stored_table
from tidemark.sources.landing import land, read_landed
from tidemark.sources.tables import BatchTable

__all__ = [
    "BatchTable",
    "HeaderMismatch",
    "KeyedTable",
    "check_header",
    "land",
    "read_checked",
    "read_csv",
    "read_landed",
    "stored_table",
]
