"""Upsert of one load into a table, as a full outer join on the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The latest copy of each key.

    ``row_number() = 1`` keeps one candidate per key and task before the
    shuffle, so a key with very many copies moves as a few rows.
    """
    latest_first = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    numbered = rows.where(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(latest_first))
    return numbered.where("_n = 1").drop("_n", *order)


def merge(target: DataFrame, load: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Insert new keys and update the columns ``load`` has; other columns keep their value.

    Later rows of the same load win by ``order``. Without ``order`` the load must
    be unique by key. A load of keys only inserts and changes nothing.
    """
    if order:
        load = last_per_key(load, key, order)
    else:
        load = load.where(F.col(key).isNotNull())
    unknown = set(load.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"load has columns the table lacks: {sorted(unknown)}")
    types = {f.name: f.dataType for f in target.schema}
    # The marker sits beside the data: a NULL in the load is a value to write.
    new = load.select(
        *[F.col(c).cast(types[c]).alias(f"_new_{c}") for c in load.columns],
        F.lit(True).alias("_in_load"),
    )
    joined = target.join(new, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    given = F.col("_in_load").isNotNull()
    return joined.select(*[
        F.when(given, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in load.columns else F.col(c)
        for c in target.columns
    ])
