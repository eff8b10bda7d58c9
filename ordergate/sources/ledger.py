"""The record of processed files: path, content hash and outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergate.operators.merge import merge

LEDGER_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("md5_hash", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
])


def ledger_rows(file_status: DataFrame, processed_at: str) -> DataFrame:
    """Outcomes of a run as ledger rows; a file that is gone has an unknown hash."""
    values = {
        "file_path": F.col("_file"),
        "md5_hash": F.coalesce(F.col("md5"), F.lit("unknown")),
        "processed_at": F.lit(processed_at),
        "status": F.col("status"),
        "rows_loaded": F.coalesce(F.col("rows_loaded"), F.lit(0)),
        "rows_rejected": F.coalesce(F.col("rows_rejected"), F.lit(0)),
    }
    return file_status.select(*[
        values[f.name].cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA
    ])


def mark_done(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The ledger after recording ``outcomes``; one row per path."""
    return merge(ledger, outcomes, "file_path", order=())


def status_of(ledger: DataFrame, file_path: str) -> DataFrame:
    return ledger.where(F.col("file_path") == file_path)


def list_processed(ledger: DataFrame, run_date: str | None = None) -> DataFrame:
    rows = ledger if run_date is None else ledger.where(F.col("file_path").contains(run_date))
    return rows.orderBy("processed_at", "file_path")
