"""Text-to-value coercion. Bad text becomes NULL; nothing here raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergate.registry import DATE, NUMBER, TableSpec

# Cell texts that a CSV reader treats as missing.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Date texts that mean "no date", compared trimmed and lower-case.
DATE_MISSING = ("", "n/a", "na", "null", "none", "invalid", "nan")

# Everything Unicode calls white space; ``F.trim`` alone only knows the blank.
_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(_SPACE))


def csv_missing_to_null(col: Column) -> Column:
    return F.when(~col.isin(*CSV_MISSING), col)


def number(col: Column) -> Column:
    """Text to double. The pattern keeps out Java-only spellings such as '12d'."""
    return F.when(col.rlike(_NUMERIC), col.try_cast("double"))


def timestamp(col: Column, formats: Sequence[str] = ()) -> Column:
    """Text to timestamp without zone: ISO forms first, then ``formats`` in order.

    The cast trims, and none of the missing-date texts parses, so the plain case
    is the cast alone.
    """
    iso = col.try_cast("timestamp_ntz")
    if not formats:
        return iso
    text = F.when(~F.lower(strip(col)).isin(*DATE_MISSING), strip(col))
    others = [
        F.try_to_timestamp(text, F.lit(f)).try_cast("timestamp_ntz") for f in formats
    ]
    return F.coalesce(iso, *others)


def date(col: Column, formats: Sequence[str] = ()) -> Column:
    return timestamp(col, formats).cast("date")


def is_valid_timestamp(col: Column, formats: Sequence[str] = ()) -> Column:
    return timestamp(col, formats).isNotNull()


def is_valid_date(col: Column, formats: Sequence[str] = ()) -> Column:
    return date(col, formats).isNotNull()


def coerce_columns(
    df: DataFrame, spec: TableSpec, date_formats: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Project to the registered columns (plus ``keep``) and coerce each one."""
    out = [F.col(k) for k in keep]
    for c in spec.columns:
        raw = F.col(c.name)
        if c.coerce == NUMBER:
            raw = number(raw)
        elif c.coerce == DATE:
            raw = timestamp(raw, date_formats)
        out.append(raw.alias(c.name))
    return df.select(*out)


def to_stored(col: Column, stored: T.DataType) -> Column:
    """Coerced value to its warehouse type; a value that does not fit is NULL."""
    if isinstance(stored, T.IntegerType):
        return F.rint(col).try_cast("int")
    if isinstance(stored, T.BooleanType):
        return strip(col).try_cast("boolean")
    return col.try_cast(stored)


def warehouse_columns(df: DataFrame, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Project coerced (and masked) rows to the warehouse column types."""
    present = set(df.columns)
    out = [F.col(k) for k in keep]
    for c in spec.columns:
        name = c.stored_name if c.stored_name in present else c.name
        out.append(to_stored(F.col(name), c.stored).alias(c.stored_name))
    return df.select(*out)


def drop_null_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.na.drop(subset=[spec.key])
