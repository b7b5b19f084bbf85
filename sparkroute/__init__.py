"""Bulk load, reshard, dump and restore of large collections as Spark jobs."""

__version__ = "0.1.0"
