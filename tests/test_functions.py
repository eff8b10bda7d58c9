"""Column functions: coercion, rules, masking, rounding, SLA flags."""

import hashlib
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ordergate import table
from ordergate.functions import coerce, privacy, rounding, rules, sla
from ordergate.registry import BATCH_FILES, STREAM_FILES, TABLES


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, fn, kind="string"):
    return [r.out for r in column(spark, values, kind).select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_registry_is_complete():
    assert len(TABLES) == 16
    assert {n for n, _, _ in BATCH_FILES} | {n for n, _, _ in STREAM_FILES} == set(TABLES)
    assert table("dim_agent") is table("agents")
    with pytest.raises(ValueError):
        table("nope")


def test_number(spark):
    values = ["1", " 2.5 ", "-3e2", ".5", "12d", "0x1p3", "NaN", "abc", "", None, "1,000"]
    assert apply(spark, values, coerce.number) == [1.0, 2.5, -300.0, 0.5] + [None] * 7


@pytest.mark.parametrize("text", [*coerce.DATE_MISSING, "N/A", " Invalid ", "2026-02-30", "02/22/2026", None])
def test_no_timestamp(spark, text):
    assert apply(spark, [text], coerce.timestamp) == [None]


def test_timestamp_forms(spark):
    values = ["2026-02-22 08:15:30", "2026-02-22T08:15:30", "2026-02-22", " 2026-02-22 08:15:30.5 "]
    got = apply(spark, values, coerce.timestamp)
    assert got[0] == got[1] == datetime(2026, 2, 22, 8, 15, 30)
    assert got[2] == datetime(2026, 2, 22) and got[3].microsecond == 500000
    extra = lambda c: coerce.timestamp(c, ["MM/dd/yyyy"])
    assert apply(spark, ["02/22/2026", "n/a", "13/40/2026"], extra) == [datetime(2026, 2, 22), None, None]


def test_csv_sentinels(spark):
    missing = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
    kept = ["none", "x", " NA", " ", "nUll", "N/a"]
    assert apply(spark, missing + kept, coerce.csv_missing_to_null) == [None] * len(missing) + kept


def test_to_stored_rounds_and_nulls(spark):
    money = lambda c: coerce.to_stored(c, table("orders").by_name["total_amount"].stored)
    assert apply(spark, [2.345, 1e9, None], money, "double") == [Decimal("2.35"), None, None]
    whole = lambda c: coerce.to_stored(c, table("orders").by_name["customer_id"].stored)
    assert apply(spark, [123.0, 3e9], whole, "double") == [123, None]
    flag = lambda c: coerce.to_stored(c, table("drivers").by_name["is_active"].stored)
    assert apply(spark, ["True", "false", "maybe"], flag) == [True, False, None]


def test_phone(spark):
    values = ["01012345678", " 1012345678 ", "1012345678.0", "01312345678", "abc12345", "0201234567", None]
    assert apply(spark, values, rules.normalize_phone)[:3] == ["01012345678"] * 3
    assert apply(spark, values, rules.bad_phone) == [False, False, False, True, True, True, False]


def test_email(spark):
    values = ["a.b+c@x-y.co", "notanemail", "missing@domain", "@nodomain.com", "a b@x.com", None]
    assert apply(spark, values, rules.bad_email) == [False, True, True, True, True, False]


def test_range_is_inclusive_and_null_passes(spark):
    both = lambda c: rules.out_of_range(c, 1, 5)
    assert apply(spark, [1.0, 5.0, 0.99, 5.01, None], both, "double") == [False, False, True, True, False]
    low = lambda c: rules.out_of_range(c, 0, None)
    assert apply(spark, [0.0, -0.01], low, "double") == [False, True]


def test_sha256_matches_hashlib(spark):
    values = [" a@x.com ", "", "  ", None, "é"]
    want = [hashlib.sha256(b"a@x.com").hexdigest(), None, None, None, hashlib.sha256("é".encode()).hexdigest()]
    assert apply(spark, values, privacy.sha256_hex) == want


def test_masking_drops_raw_columns(spark):
    df = spark.createDataFrame([("1", "a@x.com")], "customer_id string, email string")
    masked = privacy.mask_pii(df, table("customers"))
    assert masked.columns == ["customer_id", "email_hash"]
    assert privacy.mask_pii(df, table("cities")).columns == df.columns


def test_ratio_is_exact_half_up(spark):
    pairs = [(s, n) for n in range(0, 41) for s in range(0, n + 1)]
    df = spark.createDataFrame(pairs, "s bigint, n bigint")
    for s, n, got in df.select("s", "n", rounding.percent(F.col("s"), F.col("n")).alias("p")).collect():
        if n == 0:
            assert got is None
        else:
            want = (Decimal(100 * s) / Decimal(n)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert got == float(want), (s, n)
    signed = spark.range(1).select(rounding.ratio(F.lit(-5), F.lit(2), 0).alias("x")).collect()[0].x
    assert signed == -3.0


def test_sla_flags_need_all_times(spark):
    t = "timestamp_ntz'2026-01-01 {}'"
    rows = [
        ("late", t.format("10:02:00"), t.format("10:15:01")), ("edge", t.format("10:01:00"), t.format("10:15:00")),
        ("early", t.format("09:59:58.5"), t.format("10:00:00.3")), ("open", t.format("10:02:00"), "null"),
    ]
    union = " union all ".join(
        f"select '{k}' ticket_id, timestamp_ntz'2026-01-01 10:00:00' created_at, {first} first_response_at, "
        f"cast({done} as timestamp_ntz) resolved_at" for k, first, done in rows)
    df = sla.with_sla_flags(sla.with_due_times(spark.sql(union)))
    got = {r.ticket_id: (r.is_first_response_breached, r.is_resolution_breached, r.first_response_seconds,
                         r.resolution_minutes) for r in df.collect()}
    assert got == {
        "late": (True, True, 120, Decimal("15.02")), "edge": (False, False, 60, Decimal("15.00")),
        "early": (False, False, -2, Decimal("0.01")), "open": (None, None, None, None)}
