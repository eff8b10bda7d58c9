"""Row rules as (label, predicate) pairs, evaluated as a waterfall.

A rejected row carries the label of the first rule it fails, so all rules of a
table fold into one ``coalesce(when(..), when(..), ..)`` column: one projection
over one scan, whatever the number of rules.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergate.functions.coerce import strip, to_stored
from ordergate.registry import TableSpec

# Accepted e-mail and mobile-number shapes. Digits are ASCII.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^01[0125][0-9]{8}$"

Rule = tuple[str, Column]


def normalize_phone(col: Column) -> Column:
    """Undo what numeric parsing does to a number: '.0' suffix, lost leading zero."""
    text = F.regexp_replace(strip(col), r"^([0-9]+)\.0$", "$1")
    return F.when(text.rlike(r"^[0-9]{10}\z"), F.concat(F.lit("0"), text)).otherwise(text)


def bad_email(col: Column) -> Column:
    return col.isNotNull() & ~col.rlike(EMAIL_PATTERN)


def bad_phone(col: Column) -> Column:
    return col.isNotNull() & ~normalize_phone(col).rlike(PHONE_PATTERN)


def out_of_range(col: Column, low: float | None, high: float | None) -> Column:
    """Outside the inclusive bounds; NULL is inside."""
    tests = []
    if low is not None:
        tests.append(col < F.lit(low))
    if high is not None:
        tests.append(col > F.lit(high))
    return F.coalesce(reduce(or_, tests), F.lit(False)) if tests else F.lit(False)


def null_rule(spec: TableSpec) -> Rule:
    return "null_violation", reduce(or_, [F.col(c).isNull() for c in spec.required])


def email_rules(spec: TableSpec) -> list[Rule]:
    return [(f"invalid_email:{c}", bad_email(F.col(c))) for c in spec.email]


def phone_rules(spec: TableSpec) -> list[Rule]:
    return [(f"invalid_phone:{c}", bad_phone(F.col(c))) for c in spec.phone]


def range_rules(spec: TableSpec) -> list[Rule]:
    return [
        (f"range_violation:{c}", out_of_range(F.col(c), low, high))
        for c, low, high in spec.ranges
    ]


def date_rules(spec: TableSpec) -> list[Rule]:
    return [(f"invalid_date:{c}", F.col(c).isNull()) for c in spec.required_dates]


def row_rules(spec: TableSpec) -> list[Rule]:
    return [
        null_rule(spec),
        *email_rules(spec),
        *phone_rules(spec),
        *range_rules(spec),
        *date_rules(spec),
    ]


def constraint_rules(spec: TableSpec) -> list[Rule]:
    """What the warehouse itself would refuse: NOT NULL, CHECK, length, precision."""
    rules: list[Rule] = []
    for c in spec.columns:
        value = F.col(c.name)
        if c.required or c.not_null_stored:
            rules.append((f"not_null:{c.name}", value.isNull()))
        if c.max_length is not None:
            rules.append((f"too_long:{c.name}", F.coalesce(F.length(value) > c.max_length, F.lit(False))))
        if not isinstance(c.stored, T.StringType):
            rules.append((
                f"does_not_fit:{c.name}",
                value.isNotNull() & to_stored(value, c.stored).isNull(),
            ))
    rules += [(f"check:{c}", out_of_range(F.col(c), low, high)) for c, low, high in spec.checks]
    return rules


def first_failure(rules: list[Rule]) -> Column:
    """Label of the first failing rule, NULL when every rule holds."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(failed, F.lit(label)) for label, failed in rules])
