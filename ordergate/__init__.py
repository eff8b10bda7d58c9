"""Spark-native data-quality and service-level analytics for order and support data."""

from ordergate.registry import TABLES, TableSpec, table

__all__ = ["TABLES", "TableSpec", "table"]
