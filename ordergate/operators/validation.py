"""Keep-first deduplication and the row-rule waterfall.

Lineage columns every input row carries:

``_file``    the file the row came from,
``_order``   its position in that file (any orderable type).

Rows may also carry ``_seen``, bits that are collected over all copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordergate.functions.rules import first_failure, row_rules
from ordergate.registry import TableSpec

FILE, ORDER, COPIES, REJECT, SEEN = "_file", "_order", "_copies", "_reject", "_seen"


def collapse_copies(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per (file, key): the first copy, with the number of copies seen.

    An aggregate rather than a window: each task keeps one candidate per key
    before the shuffle, so a key (or NULL) that holds most rows moves as a few
    rows. Rows without a key collapse to one row per file that only counts.
    """
    seen = [SEEN] if SEEN in df.columns else []
    rest = [c for c in df.columns if c not in (FILE, spec.key, *seen)]
    first = F.min_by(F.struct(*rest), F.col(ORDER)).alias("_first")
    return (
        df.groupBy(FILE, spec.key)
        .agg(first, F.count(F.lit(1)).alias(COPIES), *[F.bit_or(c).alias(c) for c in seen])
        .select(FILE, COPIES, spec.key, "_first.*", *seen)
    )


def keep_first(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The first copy only, where counts are not wanted.

    ``row_number() = 1`` lets Spark drop later copies in each task before the
    shuffle, which is cheaper than the aggregate and as safe for hot keys.
    """
    copies = Window.partitionBy(FILE, spec.key).orderBy(ORDER)
    keyed = df.where(F.col(spec.key).isNotNull())
    return keyed.withColumn("_n", F.row_number().over(copies)).where("_n = 1").drop("_n")


def label_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Collapse copies, then add ``_reject``: the first failing rule, or NULL."""
    keyed = F.col(spec.key).isNotNull()
    collapsed = collapse_copies(df, spec)
    return collapsed.withColumn(REJECT, F.when(keyed, first_failure(row_rules(spec))))


def valid_rows(labelled: DataFrame, spec: TableSpec) -> DataFrame:
    keep = F.col(REJECT).isNull() & F.col(spec.key).isNotNull()
    return labelled.where(keep).drop(REJECT, COPIES)


def rejected_rows(labelled: DataFrame) -> DataFrame:
    return (
        labelled.where(F.col(REJECT).isNotNull())
        .withColumnRenamed(REJECT, "rejection_reason")
        .drop(COPIES)
    )


def _labelled_as(prefix: str) -> Column:
    return F.col(REJECT).startswith(prefix)


def stats_columns(spec: TableSpec) -> list[Column]:
    """Counters of one validation run, to be used in any ``groupBy(...).agg``."""
    extra_copies = F.when(F.col(spec.key).isNull(), F.col(COPIES)).otherwise(F.col(COPIES) - 1)
    counts = {
        "null_violations": _labelled_as("null_violation"),
        "invalid_email": _labelled_as("invalid_email:"),
        "invalid_phone": _labelled_as("invalid_phone:"),
        "range_violations": _labelled_as("range_violation:"),
        "date_violations": _labelled_as("invalid_date:"),
        "total_rejected": F.col(REJECT).isNotNull(),
    }
    return [
        F.sum(COPIES).alias("total"),
        F.sum(extra_copies).alias("duplicates_removed"),
        F.sum(F.when(F.col(spec.key).isNull(), F.col(COPIES)).otherwise(0)).alias("null_keys"),
        *[F.count_if(test).alias(name) for name, test in counts.items()],
    ]


def validation_stats(labelled: DataFrame, spec: TableSpec) -> DataFrame:
    """One row of counters per file."""
    return labelled.groupBy(FILE).agg(*stats_columns(spec))
