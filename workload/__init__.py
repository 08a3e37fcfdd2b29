"""The registered queries, by subject."""

from workload import assessment, columns, models, rows, store, streams, text  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
