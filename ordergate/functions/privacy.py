"""Irreversible masking of personal columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordergate.functions.coerce import strip
from ordergate.functions.rules import normalize_phone
from ordergate.registry import TableSpec


def sha256_hex(col: Column) -> Column:
    """SHA-256 of the trimmed text; NULL or blank stays NULL."""
    text = strip(col)
    return F.when(F.length(text) > 0, F.sha2(text, 256))


def mask_pii(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Replace personal columns by their hashes; columns not present are skipped.

    Phones are hashed in normal form, so one number has one hash however the
    file spelled it.
    """
    masked = df
    for c in spec.pii:
        if c.name not in df.columns:
            continue
        value = normalize_phone(F.col(c.name)) if c.name in spec.phone else F.col(c.name)
        masked = masked.withColumn(c.hashed_as, sha256_hex(value)).drop(c.name)
    return masked
