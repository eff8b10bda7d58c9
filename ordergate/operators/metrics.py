"""Audit rows per file and the summaries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordergate.functions.rounding import ratio
from ordergate.registry import ALERT_SCHEMA, QUALITY_LOG_SCHEMA

SUCCESS, SKIPPED, FAILED = "success", "skipped", "failed"

_COUNTERS = (
    "total", "duplicates_removed", "null_violations", "invalid_email", "invalid_phone",
    "range_violations", "date_violations", "total_rejected", "orphan_count", "orphan_rate",
)


def quality_log_rows(
    stats: DataFrame, run_date: str, run_timestamp: str, table_name: str, latency_ms: int = 0
) -> DataFrame:
    """Counters per file to audit rows.

    ``valid_records`` and ``rejected_records`` are used where ``stats`` has them
    and they are known; else valid is total minus rejected, so that the copies
    and orphans of a file that loaded nothing count as valid.
    """
    have = set(stats.columns)

    def counter(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) if name in have else F.lit(0)

    def known_or(name: str, otherwise: Column) -> Column:
        return F.coalesce(F.col(name), otherwise) if name in have else otherwise

    c = {name: counter(name) for name in _COUNTERS}
    values = {
        "run_date": F.lit(run_date),
        "run_timestamp": F.lit(run_timestamp),
        "table_name": F.lit(table_name),
        "source_file": F.col("_file"),
        "total_records": c["total"],
        "valid_records": known_or("valid_records", c["total"] - c["total_rejected"]),
        "rejected_records": known_or("rejected_records", c["total_rejected"]),
        "duplicate_count": c["duplicates_removed"],
        "null_violation_count": c["null_violations"],
        "invalid_format_count": c["invalid_email"] + c["invalid_phone"]
        + c["range_violations"] + c["date_violations"],
        "orphan_count": c["orphan_count"],
        "orphan_rate": c["orphan_rate"],
        "processing_latency_ms": F.lit(latency_ms),
        "status": known_or("status", F.lit(SUCCESS)),
    }
    return stats.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in QUALITY_LOG_SCHEMA])


ORPHAN_RATE, FILE_FAILED = "orphan_rate", "file_failed"


def alert_rows(outcomes: DataFrame, run_date: str, run_timestamp: str, threshold: float) -> DataFrame:
    """Alerts of a run from its file outcomes (table_name, _file, status, error, orphan_count, tested): files that failed, and
    files whose unrounded share of rows without a parent is above the threshold."""
    failed = F.col("status") == FAILED
    rate = F.col("orphan_count") / F.nullif(F.col("tested"), F.lit(0))
    values = {
        "run_date": F.lit(run_date),
        "run_timestamp": F.lit(run_timestamp),
        "kind": F.when(failed, FILE_FAILED).otherwise(ORPHAN_RATE),
        "table_name": F.col("table_name"),
        "source_file": F.col("_file"),
        "affected_rows": F.when(~failed, F.col("orphan_count")),
        "total_rows": F.when(~failed, F.col("tested")),
        "message": F.when(failed, F.concat(F.lit("not loaded: "), F.col("error"))).otherwise(F.format_string(
            "%.1f%% of the rows refer to nothing known; %.1f%% are tolerated", rate * 100, F.lit(threshold * 100.0))),
    }
    needed = failed | F.coalesce(rate > threshold, F.lit(False))
    return outcomes.where(needed).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA])


def daily_summary(quality_log: DataFrame, run_date: str) -> DataFrame:
    return quality_log.where(F.col("run_date") == F.lit(run_date).cast("date")).orderBy(
        "run_timestamp", "table_name", "source_file")


def file_success_rate(quality_log: DataFrame, run_date: str) -> DataFrame:
    """Share of audited files that succeeded, to four digits; 1.0 when there are none."""
    day = quality_log.where(F.col("run_date") == F.lit(run_date).cast("date"))
    return day.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == SUCCESS).alias("successful"),
    ).select(
        "total", "successful",
        F.coalesce(ratio(F.col("successful"), F.col("total"), digits=4), F.lit(1.0)).alias("success_rate"),
    )


def quality_overview(quality_log: DataFrame, run_date: str) -> DataFrame:
    day = daily_summary(quality_log, run_date)
    return day.select(
        "table_name", "total_records", "valid_records", "rejected_records", "orphan_count",
        F.round(F.col("orphan_rate") * 100, 2).alias("orphan_pct"),
        "processing_latency_ms", "status",
    )


def latest_quality(quality_log: DataFrame, rows: int = 20) -> DataFrame:
    """The most recent audit rows; table and file break ties of the timestamp."""
    return quality_log.orderBy(
        F.desc("run_timestamp"), "table_name", "source_file"
    ).limit(rows).select(
        "table_name", "total_records", "valid_records", "rejected_records", "orphan_count",
        "orphan_rate", "processing_latency_ms", "status",
    )


def run_summary(quality_log: DataFrame, run_date: str) -> DataFrame:
    """Totals of a day's run."""
    day = quality_log.where(F.col("run_date") == F.lit(run_date).cast("date"))
    zero = F.lit(0)
    return day.agg(
        F.coalesce(F.sum("total_records"), zero).alias("total_records"),
        F.coalesce(F.sum("rejected_records"), zero).alias("rejected_records"),
        F.coalesce(F.sum("orphan_count"), zero).alias("orphan_count"),
        F.count(F.lit(1)).alias("files_processed"),
    )


def batch_summary(file_status: DataFrame) -> DataFrame:
    """Files attempted, loaded and skipped, and rows loaded and rejected."""
    done = F.col("status") == SUCCESS
    counted = lambda c: F.coalesce(F.sum(F.when(done, F.col(c))), F.lit(0))
    return file_status.agg(
        F.count(F.lit(1)).alias("files_attempted"),
        F.count_if(done).alias("files_succeeded"),
        F.count_if(F.col("status").isin(SKIPPED, "already_processed")).alias("files_skipped"),
        counted("rows_loaded").alias("total_rows_loaded"),
        counted("rows_rejected").alias("total_rows_rejected"),
    )


_LOADED = {
    "orders_loaded": "orders", "tickets_loaded": "tickets", "events_loaded": "ticket_events",
}


def _loaded_columns() -> list[Column]:
    return [
        F.coalesce(F.sum(F.when(F.col("table_name") == t, F.col("rows_loaded"))), F.lit(0)).alias(name)
        for name, t in _LOADED.items()
    ]


def stream_summary(file_status: DataFrame) -> DataFrame:
    """Rows loaded per fact table over all slots."""
    return file_status.where(F.col("status") == SUCCESS).agg(*_loaded_columns())


def stream_summary_by_slot(file_status: DataFrame) -> DataFrame:
    return file_status.where(F.col("status") == SUCCESS).groupBy("slot").agg(*_loaded_columns())
