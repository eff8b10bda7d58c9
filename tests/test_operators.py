"""Validation, references and merge on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from ordergate import table
from ordergate.functions import coerce, rules
from ordergate.operators import merge as merging
from ordergate.operators import metrics
from ordergate.operators import references as refs
from ordergate.operators import validation as val
from ordergate.session import scratch_folder

CUSTOMER = table("customers")


def customers(spark, rows):
    """(file, order, id, email, phone) to coerced customer rows."""
    filled = [(f, o, k, "n", e, p, None, None, None, None, None, None) for f, o, k, e, p in rows]
    columns = ", ".join(f"{c} string" for c in CUSTOMER.column_names)
    df = spark.createDataFrame(filled, f"_file string, _order bigint, {columns}")
    return coerce.coerce_columns(df, CUSTOMER, keep=("_file", "_order"))


ROWS = [
    ("a", 1, "7", "bad", "01012345678"),      # first copy fails its rule ...
    ("a", 2, "7.0", "ok@x.com", "01012345678"),  # ... so the good copy is lost with it
    ("a", 3, None, "ok@x.com", None), ("a", 4, "x", "bad", None),  # no key: copies, not violations
    ("a", 5, "8", "bad", "bad"), ("a", 6, "9", None, "bad"), ("b", 1, "7", "ok@x.com", None),
]


def test_copies_go_first_and_silently(spark):
    labelled = val.label_rows(customers(spark, ROWS), CUSTOMER)
    stats = {r["_file"]: r for r in val.validation_stats(labelled, CUSTOMER).collect()}
    a, b = stats["a"], stats["b"]
    assert (a.total, a.duplicates_removed, a.null_keys, a.null_violations) == (6, 3, 2, 0)
    assert (a.invalid_email, a.invalid_phone, a.date_violations, a.total_rejected) == (2, 1, 0, 3)
    assert (b.total, b.duplicates_removed, b.total_rejected) == (1, 0, 0)
    rejected = {(r["_file"], r.customer_id): r.rejection_reason for r in val.rejected_rows(labelled).collect()}
    assert rejected == {("a", 7.0): "invalid_email:email", ("a", 8.0): "invalid_email:email",
                        ("a", 9.0): "invalid_phone:phone"}
    assert [r["_file"] for r in val.valid_rows(labelled, CUSTOMER).collect()] == ["b"]


def test_every_row_is_accounted_for(spark):
    rng = random.Random(3)
    rows = [("f%d" % rng.randrange(3), i, rng.choice([None, "1", "2", str(rng.randrange(60))]),
             rng.choice([None, "a@b.co", "bad"]), rng.choice([None, "01112345678", "5"])) for i in range(400)]
    labelled = val.label_rows(customers(spark, rows).repartition(7), CUSTOMER)
    stats = val.validation_stats(labelled, CUSTOMER).agg(
        F.sum("total"), F.sum("duplicates_removed"), F.sum("total_rejected")).collect()[0]
    valid = val.valid_rows(labelled, CUSTOMER)
    assert stats[0] == 400 == stats[1] + stats[2] + valid.count()
    # Brute force: first row per file and key, in order.
    first = {}
    for f, o, k, e, p in sorted(rows, key=lambda r: r[1]):
        if k is not None:
            first.setdefault((f, float(k)), o)
    kept = {(r["_file"], r.customer_id): r["_order"]
            for r in labelled.where("customer_id is not null").collect()}
    assert kept == first
    alone = val.keep_first(customers(spark, rows).repartition(5), CUSTOMER)
    assert {(r["_file"], r.customer_id): r["_order"] for r in alone.collect()} == first


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = val.keep_first(customers(spark, ROWS), CUSTOMER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    plan = val.collapse_copies(customers(spark, ROWS), CUSTOMER)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_bad_required_date_counts_as_null(spark):
    spec = table("ticket_events")
    df = spark.createDataFrame(
        [("f", 1, "e1", "t1", "1", "N/A", None, "Open", None)],
        "_file string, _order int, event_id string, ticket_id string, agent_id string, event_ts string, "
        "old_status string, new_status string, notes string")
    labelled = val.label_rows(coerce.coerce_columns(df, spec, keep=("_file", "_order")), spec)
    assert labelled.collect()[0]["_reject"] == "null_violation"


def test_non_numeric_amount_passes_the_range(spark):
    label = rules.first_failure(rules.range_rules(table("tickets")))
    df = spark.createDataFrame([("abc",), ("-1",), ("2",)], "refund_amount string")
    coerced = df.select(coerce.number(F.col("refund_amount")).alias("refund_amount"))
    assert [r[0] for r in coerced.select(label).collect()] == [None, "range_violation:refund_amount", None]


def test_constraints(spark):
    spec = table("priorities")
    rows = [(1.0, "P1", "x", 1.0, 15.0), (2.0, None, "x", 1.0, 15.0), (3.0, "P" * 11, "x", 1.0, 15.0),
            (4.0, "P4", "x", 3e9, 15.0)]
    df = spark.createDataFrame(
        rows, "priority_id double, priority_code string, priority_name string, "
        "sla_first_response_min double, sla_resolution_min double")
    got = [r[0] for r in df.select(rules.first_failure(rules.constraint_rules(spec))).collect()]
    assert got == [None, "not_null:priority_code", "too_long:priority_code", "does_not_fit:sla_first_response_min"]


def orders(spark):
    return spark.createDataFrame(
        [("f", "o1", 1.0, 1.0), ("f", "o2", 9.0, 9.0), ("f", "o3", None, 1.0), ("g", "o4", 1.0, 9.0)],
        "_file string, order_id string, customer_id double, driver_id double")


def keys(spark, name, *values):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


@pytest.mark.parametrize("salt", [1, 5])
def test_first_failing_reference_labels(spark, salt):
    checks = [refs.KeyCheck("customer_id", keys(spark, "customer_id", 1, 2), "orphan_customer"),
              refs.KeyCheck("driver_id", keys(spark, "driver_id", 1), "orphan_driver"),
              refs.KeyCheck("absent", keys(spark, "absent", 1), "orphan_absent")]
    labelled = refs.label_orphans(orders(spark), checks, "order_id", salt=salt)
    got = {r.order_id: (r.rejection_reason, r.orphan_fk_col, r.orphan_fk_value)
           for r in refs.orphan_rows(labelled).collect()}
    assert got == {"o2": ("orphan_customer", "customer_id", "9"), "o3": ("orphan_customer", "customer_id", ""),
                   "o4": ("orphan_driver", "driver_id", "9")}
    stats = {r["_file"]: (r.total, r.valid, r.orphan_count, r.orphan_rate) for r in refs.orphan_stats(labelled).collect()}
    assert stats == {"f": (3, 1, 2, 0.6667), "g": (1, 0, 1, 1.0)}
    alerts = refs.orphan_alerts(refs.orphan_stats(labelled), "orders", threshold=0.7).collect()
    assert [a.message for a in alerts] == ["Orphan rate 100.0% exceeds threshold 70.0% for table 'orders'"]


def test_threshold_is_strict(spark):
    stats = spark.createDataFrame([("a", 20, 1, 0.05), ("b", 19, 1, 0.0526)],
                                  "_file string, total long, orphan_count long, orphan_rate double")
    assert [r.source_file for r in refs.orphan_alerts(stats, "orders").collect()] == ["b"]


def test_empty_parent_switches_the_check_off(spark):
    check = refs.KeyCheck("customer_id", keys(spark, "customer_id"), "orphan_customer")
    assert refs.orphan_rows(refs.label_orphans(orders(spark), [check], "order_id")).count() == 0


def test_keys_are_repeated_only_where_spark_does_not_split_hot_keys(spark):
    check = refs.KeyCheck("customer_id", keys(spark, "customer_id", 1, 2), "orphan_customer")
    found = []
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            labelled = refs.label_orphans(orders(spark), [check], "order_id", salt=5)
            repeated = "Generate" in labelled._jdf.queryExecution().executedPlan().toString()
            assert repeated == (adaptive == "false")
            found.append(sorted(r.order_id for r in refs.orphan_rows(labelled).collect()))
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
    assert found[0] == found[1] == ["o2", "o3"]


def test_null_passes_a_declared_key(spark):
    check = refs.KeyCheck("customer_id", keys(spark, "customer_id", 1), "unknown_customer", null_passes=True)
    bad = refs.orphan_rows(refs.label_orphans(orders(spark), [check], "order_id"))
    assert [r.order_id for r in bad.collect()] == ["o2"]


def test_parent_must_not_come_from_a_later_slot(spark):
    rows = spark.createDataFrame([("t1", "o1", "08"), ("t2", "o2", "08"), ("t3", "o2", "12"), ("t4", "o3", "06")],
                                 "ticket_id string, order_id string, slot string")
    parents = spark.createDataFrame([("o1", "08"), ("o2", "12")], "order_id string, since string")
    check = refs.KeyCheck("order_id", parents, "orphan_order", since="since")
    bad = refs.orphan_rows(refs.label_orphans(rows, [check], "ticket_id", slot="slot"))
    # t4 passes: no order at all is known yet in slot 06.
    assert sorted(r.ticket_id for r in bad.collect()) == ["t2"]


def target(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, kept string")


def test_merge_updates_given_columns_only(spark):
    load = spark.createDataFrame([(2, "new", 5), (2, None, 9), (3, "c", 1), (None, "z", 1)], "id int, name string, o int")
    got = sorted(map(tuple, merging.merge(target(spark), load, "id", ("o",)).collect()))
    assert got == [(1, "a", "x"), (2, None, "y"), (3, "c", None)]


def test_merge_of_keys_only_inserts(spark):
    load = spark.createDataFrame([(1, 1), (4, 1)], "id int, o int")
    got = sorted(map(tuple, merging.merge(target(spark), load, "id", ("o",)).collect()), key=str)
    assert got == [(1, "a", "x"), (2, "b", "y"), (4, None, None)]
    with pytest.raises(ValueError):
        merging.merge(target(spark), load, "id")


def test_merge_twice_is_merge_once(spark):
    load = spark.createDataFrame([(2, "new"), (3, "c")], "id int, name string")
    once = merging.merge(target(spark), load, "id")
    assert sorted(map(tuple, merging.merge(once, load, "id").collect())) == sorted(map(tuple, once.collect()))


def test_success_rate_without_rows_is_one(spark):
    from ordergate.registry import QUALITY_LOG_SCHEMA

    empty = spark.createDataFrame([], QUALITY_LOG_SCHEMA)
    assert metrics.file_success_rate(empty, "2026-01-01").collect()[0].success_rate == 1.0
    assert metrics.run_summary(empty, "2026-01-01").collect()[0].total_records == 0


def test_skipped_file_counts_copies_as_valid(spark):
    stats = spark.createDataFrame([("f", 10, 3, 2)], "_file string, total long, duplicates_removed long, total_rejected long")
    row = metrics.quality_log_rows(stats, "2026-01-01", "2026-01-01 00:00:00", "orders").collect()[0]
    assert (row.valid_records, row.rejected_records, row.duplicate_count, row.status) == (8, 2, 3, "success")


def test_scratch_folder_uses_the_shared_setting(spark):
    class Conf:
        def get(self, name, default=None):
            return {"spark.checkpoint.dir": "/shared/place/"}.get(name, default)

    class Session:
        conf = Conf()

    assert scratch_folder(Session(), "x").startswith("/shared/place/ordergate-x-")
    assert scratch_folder(Session(), "x") != scratch_folder(Session(), "x")


def test_hot_and_missing_keys_are_split_in_a_shuffled_join(spark):
    """A third of the rows share one key, a third have none, and nothing may be broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        hot = F.when(i % 3 == 0, 7).when(i % 3 == 2, i % 90000)
        rows = spark.range(400_000, numPartitions=16).select(
            F.lit("f").alias("_file"), i.cast("string").alias("order_id"), hot.cast("double").alias("customer_id"),
            F.sha2(i.cast("string"), 256).alias("payload"))
        known = spark.range(80_000).select(i.cast("int").alias("customer_id"))
        labelled = refs.label_orphans(rows, [refs.KeyCheck("customer_id", known, "orphan")], "order_id")
        whole = labelled.where(F.length("payload") > 0)
        whole.tail(1)
        assert "skew=true" in whole._jdf.queryExecution().executedPlan().toString()
        salted = refs.label_orphans(rows, [refs.KeyCheck("customer_id", known, "orphan")], "order_id", salt=8)
        count = lambda df: refs.orphan_rows(df).count()
        expected = sum(1 for n in range(400_000) if n % 3 == 1 or (n % 3 == 2 and n % 90_000 >= 80_000))
        assert count(labelled) == count(salted) == expected
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def star_orders(spark, n=4000):
    """Orders with a hot unknown customer, NULL keys, doubles for drivers and slots; row n is the same for every run."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 40).cast("int").alias("customer_id"),
        F.when(F.col("id") % 13 == 0, None).otherwise(F.col("id") % 25).cast("double").alias("driver_id"),
        (F.col("id") % 30).cast("int").alias("region_id"), F.format_string("%02d", F.col("id") % 4).alias("slot"),
        (F.col("id") % 5 != 0).alias("good"), F.repeat(F.lit("wide"), 50).alias("payload"))


@pytest.mark.parametrize("few", [0, 3, 100_000])
def test_labels_by_value_equal_labels_by_row(spark, monkeypatch, tmp_path, few):
    """Unknown, NULL and late keys, an empty parent, a parent without slots, whichever way a check's unknown values take."""
    monkeypatch.setattr(refs, "FEW_UNKNOWN", few)
    late = spark.range(35).select(F.col("id").cast("int").alias("customer_id"), F.format_string("%02d", F.col("id") % 6).alias("since"))
    checks = [refs.KeyCheck("customer_id", late, "orphan_customer", since="since"),
              refs.KeyCheck("driver_id", spark.range(20).select(F.col("id").cast("int").alias("driver_id")), "orphan_driver", null_passes=True),
              refs.KeyCheck("region_id", keys(spark, "region_id"), "orphan_region"),
              refs.KeyCheck("absent", keys(spark, "absent", 1), "orphan_absent")]

    def keep(values, label):
        values.write.parquet(str(tmp_path / label))
        return spark.read.schema(values.schema).parquet(str(tmp_path / label))

    rows = star_orders(spark)
    by_row = refs.label_orphans(rows, checks, "order_id", slot="slot", where=F.col("good"))
    by_value = refs.label_orphans_by_value(rows, checks, "order_id", keep, slot="slot", where=F.col("good"))
    assert by_value.columns == by_row.columns
    assert by_value.exceptAll(by_row).count() == by_row.exceptAll(by_value).count() == 0
    assert {r[0] for r in by_value.select("_orphan").distinct().collect()} == {None, "orphan_customer", "orphan_driver"}
    none = refs.label_orphans_by_value(rows, [], "order_id", keep)
    assert none.columns == by_row.columns and none.where("_orphan is not null").count() == 0


def test_no_row_is_shuffled_for_a_check_by_value(spark, tmp_path):
    """With automatic broadcasting off, the labelled rows' plan has no exchange but that of the few unknown values."""
    def keep(values, label):
        values.write.parquet(str(tmp_path / label))
        return spark.read.schema(values.schema).parquet(str(tmp_path / label))

    checks = [refs.KeyCheck("customer_id", spark.range(40).select(F.col("id").cast("int").alias("customer_id")), "orphan_customer", some=True),
              refs.KeyCheck("driver_id", spark.range(20).select(F.col("id").cast("int").alias("driver_id")), "orphan_driver", some=True)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" in plan(refs.label_orphans(star_orders(spark), checks, "order_id"))
        by_value = refs.label_orphans_by_value(star_orders(spark), checks, "order_id", keep)
        assert "Exchange hashpartitioning" not in plan(by_value) and "BroadcastHashJoin" in plan(by_value)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
