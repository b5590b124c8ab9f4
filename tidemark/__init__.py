"""Daily batch loads that keep slowly changing dimensions, written for Spark."""

from tidemark.specs import DATASETS, Dataset

__all__ = ["DATASETS", "Dataset"]
