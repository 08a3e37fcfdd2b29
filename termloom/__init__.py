"""termloom: Spark jobs over labelled, sparse text data."""

from termloom.frame import SparseFrame

__all__ = ["SparseFrame"]
