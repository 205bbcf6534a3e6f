"""Loomwork: record linkage, data consolidation and corpus preparation on PySpark."""

__version__ = "0.1.0"
