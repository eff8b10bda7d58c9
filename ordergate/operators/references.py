"""Foreign-key checks as equi left joins on distinct keys.

Keys are never collected. The key side is one narrow column of unique values,
so a join cannot multiply rows; adaptive execution broadcasts it when it is
small and splits the fact side when one key value is hot. ``salt`` does the
split ahead of time for sessions that run without adaptive skew handling; with it keys are never
repeated, since every task of a broadcast join would hold all the repeats. Stored rows are tested by
their distinct values, so that only values that fail meet the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordergate.functions.rounding import ratio
from ordergate.operators.validation import FILE
from ordergate.registry import TableSpec, declared_references

ORPHAN, ORPHAN_COLUMN, ORPHAN_VALUE = "_orphan", "_orphan_column", "_orphan_value"

DEFAULT_ORPHAN_THRESHOLD = 0.05
#: Up to this many unknown values of a check are sent to every task (keys are numbers or ids of 36 letters); more are tested by a shuffle of the rows.
FEW_UNKNOWN = 100_000


@dataclass(frozen=True)
class Keys:
    """Keys of a parent. ``near`` gives only those that may equal one of a column of values; ``some`` says whether
    there are any at all, where that is known without looking."""

    frame: DataFrame
    near: Callable[[DataFrame], DataFrame] | None = None
    some: bool = False


@dataclass(frozen=True)
class KeyCheck:
    """One membership test. ``since`` names a column of ``keys`` that holds the
    first slot a key is known from; the row's own slot must not be earlier.
    ``near`` and ``some`` are those of :class:`Keys`."""

    column: str
    keys: DataFrame
    label: str
    null_passes: bool = False
    since: str | None = None
    near: Callable[[DataFrame], DataFrame] | None = None
    some: bool = False

    def narrowed(self, rows: DataFrame) -> KeyCheck:
        """The same test of ``rows``, with no more keys than they may need."""
        if self.near is None or self.column not in rows.columns:
            return self
        return replace(self, keys=self.near(rows.select(self.column)), near=None)


def known_keys(dimension: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Non-NULL keys; ``unique`` saves the shuffle where the table has one row per key."""
    keys = dimension.select(key).where(F.col(key).isNotNull())
    return keys if unique else keys.distinct()


def _any_known(check: KeyCheck, slot: str | None) -> Column:
    """True once there is any key at all: an empty parent switches the check off."""
    if check.some:
        return F.lit(True)
    if check.since is None:
        some = check.keys.select(F.lit(1).alias("one")).limit(1)
        return some.agg(F.count("one")).scalar() > 0
    earliest = check.keys.agg(F.min(check.since)).scalar()
    return F.coalesce(earliest <= F.col(slot), F.lit(False))


def _splits_hot_keys(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return all(conf.get(f"spark.sql.adaptive.{x}").lower() == "true" for x in ("enabled", "skewJoin.enabled"))


def _join_keys(
    df: DataFrame, check: KeyCheck, index: int, row_key: str, salt: int, slot: str | None
) -> tuple[DataFrame, Column]:
    key_column = check.keys.columns[0]
    found, salted = f"_k{index}", f"_s{index}"
    keys = check.keys.select(
        F.col(key_column).alias(found),
        *([F.col(check.since).alias(f"_t{index}")] if check.since else []),
    )
    # Numbers are compared as numbers: a fact's key column may still be double.
    left_type, right_type = df.schema[check.column].dataType, keys.schema[found].dataType
    probe = F.col(check.column)
    if left_type != right_type:
        probe = probe.cast("double")
        keys = keys.withColumn(found, F.col(found).cast("double"))
    matched = probe == F.col(found)
    if salt > 1 and not _splits_hot_keys(df):
        keys = keys.withColumn(salted, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        matched &= F.pmod(F.xxhash64(row_key), F.lit(salt)) == F.col(salted)
    joined = df.join(keys, matched, "left")
    known = F.col(found).isNotNull()
    if check.since:
        known &= F.col(f"_t{index}") <= F.col(slot)
    ok = F.coalesce(known, F.lit(False))
    if check.null_passes:
        ok = ok | F.col(check.column).isNull()
    return joined, ok


def label_orphans(
    df: DataFrame,
    checks: Sequence[KeyCheck],
    row_key: str,
    salt: int = 1,
    slot: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Add the label, column and value of the first failing key check.

    ``where`` restricts the test to some rows; the others get no label.
    A column the rows do not have passes its check.
    """
    checks = [c for c in checks if c.column in df.columns]
    joined, failures = df, []
    for i, check in enumerate(checks):
        joined, ok = _join_keys(joined, check, i, row_key, salt, slot)
        failures.append((check, ~ok & _any_known(check, slot)))
    if not failures:
        nothing = F.lit(None).cast("string")
        return df.withColumns({c: nothing for c in (ORPHAN, ORPHAN_COLUMN, ORPHAN_VALUE)})
    return _labelled(df, joined, failures, where)


def _labelled(df: DataFrame, joined: DataFrame, failures: Sequence[tuple[KeyCheck, Column]], where: Column | None) -> DataFrame:
    """``df`` with the first failing check of each row, from ``joined``, which has what the failures refer to."""
    scope = F.lit(True) if where is None else where
    label = F.coalesce(*[F.when(scope & failed, F.lit(check.label)) for check, failed in failures])
    labelled = joined.select(*[F.col(c) for c in df.columns], label.alias(ORPHAN))
    # Column and value follow from the label, so each test is evaluated once.
    is_label = [(F.col(ORPHAN) == check.label, check.column) for check, _ in failures]
    return labelled.withColumns({
        ORPHAN_COLUMN: F.coalesce(*[F.when(hit, F.lit(column)) for hit, column in is_label]),
        ORPHAN_VALUE: F.coalesce(*[
            F.when(hit, F.coalesce(key_text(df, column), F.lit(""))) for hit, column in is_label]),
    })


def unknown_values(rows: DataFrame, check: KeyCheck, slot: str | None = None) -> DataFrame:
    """Distinct values of a check's column (with the row's slot, if the check asks for it) that fail it, but NULL. Rows are reduced to these before they are shuffled."""
    columns = [check.column, slot] if check.since else [check.column]
    values = rows.where(F.col(check.column).isNotNull()).select(*columns).distinct()
    joined, ok = _join_keys(values, check, 0, check.column, 1, slot)
    return joined.where(~ok & _any_known(check, slot)).select(*columns)


def label_orphans_by_value(
    df: DataFrame,
    checks: Sequence[KeyCheck],
    row_key: str,
    keep: Callable[[DataFrame, str], DataFrame],
    salt: int = 1,
    slot: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """:func:`label_orphans` for rows that are stored and parents that are large.

    Each check's distinct values are tested first, and only the unknown ones meet the rows: no row is shuffled for a
    check with at most ``FEW_UNKNOWN`` of them. ``keep`` writes a frame under a name and reads it again.
    """
    checks = [c for c in checks if c.column in df.columns]
    scoped = df if where is None else df.where(where)
    joined, failures = df, []
    for i, check in enumerate(checks):
        unknown = keep(unknown_values(scoped, check, slot), check.label)
        if unknown.limit(FEW_UNKNOWN + 1).count() > FEW_UNKNOWN:
            joined, ok = _join_keys(joined, check, i, row_key, salt, slot)
            failures.append((check, ~ok & _any_known(check, slot)))
            continue
        names = [f"_u{i}_{n}" for n in range(len(unknown.columns))]
        matched = [F.col(c) == F.col(n) for c, n in zip(unknown.columns, names, strict=True)]
        joined = joined.join(F.broadcast(unknown.toDF(*names)), reduce(Column.__and__, matched), "left")
        failed = F.col(names[0]).isNotNull()
        if not check.null_passes:
            failed |= F.col(check.column).isNull() & _any_known(check, slot)
        failures.append((check, failed))
    return _labelled(df, joined, failures, where) if failures else label_orphans(df, [], row_key)


def key_text(df: DataFrame, column: str) -> Column:
    """A key as text; whole numbers without a fraction."""
    col = F.col(column)
    if df.schema[column].dataType.typeName() == "double":
        whole = col == F.rint(col)
        return F.when(whole, col.try_cast("bigint").cast("string")).otherwise(col.cast("string"))
    return col.cast("string")


def _check(column: str, keys: DataFrame | Keys, label: str, **more) -> KeyCheck:
    if isinstance(keys, Keys):
        return KeyCheck(column, keys.frame, label, near=keys.near, some=keys.some, **more)
    return KeyCheck(column, keys, label, **more)


def fact_checks(
    references: Sequence[tuple[str, str, str]],
    parents: Mapping[str, DataFrame | Keys],
    since: str | None = None,
) -> list[KeyCheck]:
    """Checks for (column, parent, label) triples; ``parents`` maps a parent to its keys."""
    checks = [_check(column, parents[parent], label) for column, parent, label in references if parent in parents]
    return [replace(c, since=since) if since and since in c.keys.columns else c for c in checks]


def declared_checks(spec: TableSpec, parents: Mapping[str, DataFrame | Keys]) -> list[KeyCheck]:
    return [
        _check(column, parents[parent], label, null_passes=True)
        for column, parent, label in declared_references(spec)
        if parent in parents
    ]


def valid_references(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col(ORPHAN).isNull()).drop(ORPHAN, ORPHAN_COLUMN, ORPHAN_VALUE)


def orphan_rows(labelled: DataFrame) -> DataFrame:
    return (
        labelled.where(F.col(ORPHAN).isNotNull())
        .withColumnRenamed(ORPHAN_COLUMN, "orphan_fk_col")
        .withColumnRenamed(ORPHAN_VALUE, "orphan_fk_value")
        .withColumnRenamed(ORPHAN, "rejection_reason")
    )


def orphan_stats(labelled: DataFrame) -> DataFrame:
    """Per file: rows tested, rows kept, orphans and their rate to four digits."""
    return (
        labelled.groupBy(FILE)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(ORPHAN).isNotNull()).alias("orphan_count"))
        .select(
            FILE,
            "total",
            (F.col("total") - F.col("orphan_count")).alias("valid"),
            "orphan_count",
            orphan_rate(F.col("orphan_count"), F.col("total")).alias("orphan_rate"),
        )
    )


def orphan_rate(orphans: Column, total: Column) -> Column:
    """Rate to four digits; 0 of 0 is 0."""
    return F.coalesce(ratio(orphans, total, digits=4), F.lit(0.0))


def warehouse_keys(warehouse, name: str) -> Keys:
    """The keys a warehouse table has, by its key index."""
    many = warehouse.buckets(name) > 1
    return Keys(warehouse.keys(name), (lambda values: warehouse.keys(name, values)) if many else None, warehouse.has_keys(name))


def orphan_alerts(
    stats: DataFrame, table_name: str, threshold: float = DEFAULT_ORPHAN_THRESHOLD
) -> DataFrame:
    """Files whose unrounded orphan rate is strictly above the threshold."""
    rate = F.col("orphan_count") / F.nullif(F.col("total"), F.lit(0))
    percent = lambda c: F.format_string("%.1f%%", c * 100)
    return stats.where(rate > threshold).select(
        F.lit(table_name).alias("table_name"),
        F.col(FILE).alias("source_file"),
        "orphan_count",
        "total",
        "orphan_rate",
        F.concat(
            F.lit("Orphan rate "), percent(rate), F.lit(" exceeds threshold "),
            percent(F.lit(threshold)), F.lit(f" for table '{table_name}'"),
        ).alias("message"),
    )
