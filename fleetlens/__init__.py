"""Cluster-operations analytics on PySpark: application, container, node,
log, configuration and file-manifest data as DataFrames."""

__version__ = "0.1.0"
