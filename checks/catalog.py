"""Every operator and query as a function of (spark, sf_dir)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import files as fx
from checks.adapters import spark_frame
from ordergate.functions import coerce, privacy, rules, sla
from ordergate.operators import merge as merging
from ordergate.operators import metrics, quarantine
from ordergate.operators import references as refs
from ordergate.operators import validation as val
from ordergate.plans import batch, reports, states, table_job, views
from ordergate.registry import BATCH_FILES, FACT_REFERENCES, STREAM_FILES, TABLES, declared_references
from ordergate.session import local_frame, scratch_folder
from ordergate.sources import csv_files, json_files, ledger
from ordergate.sources import files as sources
from ordergate.streaming import run_once, watch
from ordergate.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE, RUN_TIME = "2024-01-01", "2024-01-01 12:00:00"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def present(df: DataFrame) -> DataFrame:
    """Types both engines hand out alike: text for times, doubles for decimals."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


# Inputs ---------------------------------------------------------------------

def raw(spark, sf_dir, name):
    return spark_frame(spark, sf_dir, name)


def typed(spark, sf_dir, name):
    return coerce.coerce_columns(raw(spark, sf_dir, name), TABLES[name], keep=("_file", "_order"))


def labelled(spark, sf_dir, name):
    return val.label_rows(typed(spark, sf_dir, name), TABLES[name])


def tickets(spark, sf_dir):
    return sla.with_sla_flags(spark_frame(spark, sf_dir, "fact_ticket"))


def star(spark, sf_dir, name):
    return spark_frame(spark, sf_dir, name)


def lineitem_copies(spark, sf_dir):
    """Line items keyed by order and line; a key occurs on several rows."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rest = [c for c in df.columns if c not in ("l_orderkey", "l_linenumber")]
    return df.select(
        F.lit("lineitem").alias("_file"),
        F.struct(*sorted(rest)).alias("_order"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        "l_quantity", "l_extendedprice", "l_shipdate",
    )


# Scans and sources ------------------------------------------------------------

BAD_LINE = "CAST(replace(customer_id, '.0', '') AS INT)"


def _csv_with_bad_lines(spark, sf_dir):
    spec = TABLES["customers"]

    def make(folder):
        rows = raw(spark, sf_dir, "customers").where("customer_id is not null")
        full, short = fx.csv_line(spec.column_names), fx.csv_line(spec.column_names[:-2])
        n = F.expr(BAD_LINE)
        line = F.when(n % 7 == 1, F.concat(full, F.lit(",surplus"))).when(n % 7 == 2, F.concat(full, F.lit(",,x")))
        line = line.when(n % 7 == 3, short).otherwise(full)
        fx.write_csv(rows, folder, spec.column_names, spec.key, {"seg": F.col("segment_id")}, line=line)
    return fx.once(spark, sf_dir, "csv-bad-lines", make)


def _read_csv_folder(spark, folder, spec):
    found = sources.fingerprint(spark, sources.list_files(spark, folder))
    return csv_files.read_csv(spark, found.collect(), spec)


@query
def csv_scan(spark, sf_dir):
    spec = TABLES["customers"]
    return _read_csv_folder(spark, _csv_with_bad_lines(spark, sf_dir), spec).select(*spec.column_names)


@query
def csv_encoding_fallback(spark, sf_dir):
    spec = TABLES["categories"]

    def make(folder):
        rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(
            F.col("p_partkey").cast("string").alias("category_id"), F.col("p_partkey").alias("_order"),
            F.concat(F.lit("café "), "p_name").alias("category_name"), "p_type")
        for name, test in (("ISO-8859-1", F.col("p_type") < "M"), ("UTF-8", F.col("p_type") >= "M")):
            fx.write_csv(rows.where(test), folder, spec.column_names, spec.key,
                         {"enc": F.lit(name)}, options={"encoding": name})
    folder = fx.once(spark, sf_dir, "csv-encodings", make)
    return _read_csv_folder(spark, folder, spec).select(*spec.column_names)


@query
def csv_quoted_lines(spark, sf_dir):
    """Names over two lines, with commas and quotes: each file is read by the splits it has."""
    spec = TABLES["categories"]

    def make(folder):
        name = F.concat(F.replace("p_name", F.lit(" "), F.lit("\n")), F.lit(', ""'), "p_type", F.lit('""\n\n,'))
        rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(
            F.col("p_partkey").cast("string").alias("category_id"), F.col("p_partkey").alias("_order"),
            F.concat(F.lit('"'), name, F.lit('"')).alias("category_name"))
        fx.write_csv(rows, folder, spec.column_names, spec.key, {"all": F.lit("parts")})
    return _read_csv_folder(spark, fx.once(spark, sf_dir, "csv-quoted", make), spec).select(*spec.column_names)


@query
def na_sentinels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/part.parquet")
    # Every sentinel spelling appears, chosen by the part's size, then near-misses that must stay.
    words = F.array(*[F.lit(w) for w in (
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
        "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", " ", "nUll", "N/a")])
    picked = F.get(words, F.col("p_size") - 1)
    cell = F.coalesce(picked, F.col("p_name"))
    return docs.select("p_partkey", coerce.csv_missing_to_null(cell).alias("cell"))


def _json_folder(spark, sf_dir, name):
    rows = raw(spark, sf_dir, name)
    return fx.once(spark, sf_dir, f"json-{name}", lambda folder: fx.write_table(
        rows, name, "json", f"{name}.json", folder, RUN_DATE))


@query
def json_scan(spark, sf_dir):
    spec = TABLES["orders"]
    found = sources.list_files(spark, _json_folder(spark, sf_dir, "orders")).collect()
    return json_files.read_json(spark, found, spec).select(*spec.column_names)


@query
def json_split_scan(spark, sf_dir):
    """Arrays read member by member, with braces, quotes and backslashes in the strings."""
    spec = TABLES["categories"]

    def make(folder):
        rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(
            F.col("p_partkey").cast("string").alias("category_id"), F.col("p_partkey").alias("_order"),
            F.concat("p_name", F.lit('}, {"\\'), "p_type").alias("category_name"))
        fx.write_json(rows, folder, spec.column_names, spec.key, {"all": F.lit("parts")})
    found = sources.list_files(spark, fx.once(spark, sf_dir, "json-split", make)).collect()
    return json_files.read_json(spark, found, spec, split_from=0).select(*spec.column_names)


def _batch_folder(spark, sf_dir):
    """A day's snapshot of all tables of the manifest."""
    def make(folder):
        for name, filename, fmt in BATCH_FILES:
            fx.write_table(raw(spark, sf_dir, name), name, fmt, filename, folder, RUN_DATE)
    return fx.once(spark, sf_dir, "batch", make)


_BATCH_TABLES = tuple(name for name, _, _ in BATCH_FILES)


@query
def batch_manifest_counts(spark, sf_dir):
    found = sources.batch_files(spark, _batch_folder(spark, sf_dir), RUN_DATE)
    marked = sources.fingerprint(spark, found).collect()
    formats = {name: fmt for name, _, fmt in BATCH_FILES}
    counts = {}
    for name in _BATCH_TABLES:
        mine = [f for f in marked if f.table_name == name]
        rows = (json_files.read_json(spark, mine, TABLES[name]) if formats[name] == "json"
                else csv_files.read_csv(spark, mine, TABLES[name]))
        counts[name] = rows
    return reports.row_counts(counts)


@query
def slot_scan(spark, sf_dir):
    found = sources.stream_files(spark, _json_folder(spark, sf_dir, "orders"), RUN_DATE)
    rows = json_files.read_json(spark, found.collect(), TABLES["orders"])
    by_slot = rows.select(table_job.slot_of(RUN_DATE).alias("slot"), "order_id")
    return by_slot.groupBy("slot").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("orders"))


@query
def known_ids_counts(spark, sf_dir):
    dims = {
        "dim_customer": "customer_id", "dim_restaurant": "restaurant_id", "dim_driver": "driver_id",
        "dim_region": "region_id", "dim_agent": "agent_id", "fact_order": "order_id", "fact_ticket": "ticket_id",
    }
    return reports.row_counts({t: refs.known_keys(star(spark, sf_dir, t), k) for t, k in dims.items()})


def _named_files(spark, sf_dir):
    """Text files of parts by size class: contents the oracle can rebuild."""
    def make(folder):
        rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(
            F.col("p_partkey").alias("_order"), F.col("p_partkey").cast("string").alias("k"), "p_name", "p_type",
            F.expr("p_partkey div 1000").alias("block"))
        one_each = rows.repartition("p_type", "block").sortWithinPartitions("p_type", "block", "_order")
        one_each.select(F.concat_ws(",", "k", "p_name"), "p_type", "block").write.partitionBy(
            "p_type", "block").text(folder)
    return fx.once(spark, sf_dir, "fingerprints", make)


@query
def file_fingerprint(spark, sf_dir):
    marked = sources.fingerprint(spark, sources.list_files(spark, _named_files(spark, sf_dir)))
    part = lambda name: F.regexp_extract("_file", rf"/{name}=([^/]+)/", 1)
    return marked.select(part("p_type").alias("p_type"), part("block").cast("bigint").alias("block"), "md5", "length")


def _files_and_ledger(spark, sf_dir):
    """Order files by date and what an earlier run recorded about them."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    per_day = orders.groupBy(F.concat(F.lit("stream/"), day, F.lit("/08/orders.json")).alias("_file")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))
    files = per_day.select("_file", F.md5(F.col("keys").cast("string")).alias("md5"), "rows", "keys")
    status = F.when(F.col("keys") % 5 == 0, "failed").when(F.col("keys") % 5 == 1, "skipped").otherwise("success")
    old = F.when(F.col("rows") % 4 == 0, F.md5(F.lit("old"))).otherwise(F.col("md5"))
    outcomes = files.where(F.col("rows") != 5).select(
        "_file", old.alias("md5"), status.alias("status"), F.col("rows").alias("rows_loaded"),
        (F.col("keys") % 7).alias("rows_rejected"))
    return files, ledger.ledger_rows(outcomes, RUN_TIME)


@query
def ledger_pending(spark, sf_dir):
    files, recorded = _files_and_ledger(spark, sf_dir)
    return sources.pending(files, recorded).select("_file", "md5")


@query
def ledger_status(spark, sf_dir):
    files, recorded = _files_and_ledger(spark, sf_dir)
    return ledger.status_of(recorded, "stream/1996-03-06/08/orders.json")


@query
def ledger_list(spark, sf_dir):
    _, recorded = _files_and_ledger(spark, sf_dir)
    return ledger.list_processed(recorded, "1996-03")


@query
def ledger_mark(spark, sf_dir):
    files, recorded = _files_and_ledger(spark, sf_dir)
    again = files.where(F.col("rows") >= 5).select(
        "_file", "md5", F.lit("success").alias("status"), F.col("rows").alias("rows_loaded"),
        F.lit(0).alias("rows_rejected"))
    return ledger.mark_done(recorded, ledger.ledger_rows(again, "2024-01-02 00:00:00"))


# Schema and coercion -----------------------------------------------------------

@query
def schema_required(spark, sf_dir):
    """Per segment folder: which required columns its files lack."""
    spec = TABLES["customers"]

    def make(folder):
        rows = raw(spark, sf_dir, "customers")
        fewer = [c for c in spec.column_names if c not in ("gender", "email")]
        more = [*spec.column_names, "segment_note"]
        noted = rows.withColumn("segment_note", F.lit("x"))
        fx.write_csv(noted.where("segment_id <= '2'"), folder, fewer, spec.key, {"seg": F.col("segment_id")})
        fx.write_csv(noted.where("segment_id > '2'"), folder, more, spec.key, {"seg": F.col("segment_id")})
    folder = fx.once(spark, sf_dir, "csv-missing-columns", make)
    found = sources.fingerprint(spark, sources.list_files(spark, folder)).collect()
    seg = F.regexp_extract("_file", "/seg=([^/]+)/", 1)
    reasons = local_frame(
        spark, [(f["_file"], ", ".join(csv_files.missing_columns(f.header, spec))) for f in found],
        "_file string, missing string")
    rows = csv_files.read_csv(spark, found, spec).groupBy(seg.alias("seg")).agg(F.count(F.lit(1)).alias("rows"))
    return reasons.select(seg.alias("seg"), "missing").distinct().join(rows, "seg", "left").select(
        "seg", "missing", F.coalesce("rows", F.lit(0)).alias("rows"))


@query
def schema_required_json(spark, sf_dir):
    """The same of JSON files: one that lacks a column gives its reason and no row."""
    spec = TABLES["customers"]

    def make(folder):
        rows = raw(spark, sf_dir, "customers").withColumn("segment_note", F.lit("x"))
        fewer = [c for c in spec.column_names if c not in ("gender", "email")]
        more = [*spec.column_names, "segment_note"]
        fx.write_json(rows.where("segment_id <= '2'"), folder, fewer, spec.key, {"seg": F.col("segment_id")})
        fx.write_json(rows.where("segment_id > '2'"), folder, more, spec.key, {"seg": F.col("segment_id")})
    found = sources.list_files(spark, fx.once(spark, sf_dir, "json-missing-columns", make)).collect()
    seg = F.regexp_extract("_file", "/seg=([^/]+)/", 1)
    missing = F.replace(F.max("_error"), F.lit("Missing required columns: "), F.lit(""))
    return json_files.read_json(spark, found, spec).groupBy(seg.alias("seg")).agg(
        F.coalesce(missing, F.lit("")).alias("missing"), F.count_if(F.col("_error").isNull()).alias("rows"))


@query
def schema_prune(spark, sf_dir):
    spec = TABLES["customers"]
    extra = raw(spark, sf_dir, "customers").withColumns({"surplus_a": F.lit("a"), "surplus_b": F.lit("b")})
    return coerce.coerce_columns(extra, spec).select("*")


@query
def coerce_numeric(spark, sf_dir):
    return typed(spark, sf_dir, "drivers").select(
        "driver_id", "region_id", "rating_avg", "on_time_rate", "cancel_rate", "completed_deliveries")


@query
def coerce_datetime(spark, sf_dir):
    return typed(spark, sf_dir, "customers").select("_order", "signup_date", "created_at", "updated_at")


@query
def date_validity(spark, sf_dir):
    rows = raw(spark, sf_dir, "customers")
    c = F.col("signup_date")
    return rows.select(
        "_order", coerce.is_valid_timestamp(c).alias("valid_ts"), coerce.is_valid_date(c).alias("valid_date"),
        coerce.date(c).alias("parsed"))


@query
def drop_null_pk(spark, sf_dir):
    kept = coerce.drop_null_key(typed(spark, sf_dir, "orders"), TABLES["orders"])
    return kept.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"))


@query
def warehouse_cast(spark, sf_dir):
    return coerce.warehouse_columns(typed(spark, sf_dir, "drivers"), TABLES["drivers"], keep=("_order",)).select(
        "_order", "driver_id", "hire_date", "rating_avg", "on_time_rate", "completed_deliveries", "is_active")


def _masked(spark, sf_dir, name):
    return privacy.mask_pii(typed(spark, sf_dir, name), TABLES[name])


@query
def pii_mask_customers(spark, sf_dir):
    return _masked(spark, sf_dir, "customers").select("_order", "customer_id", "email_hash", "phone_hash")


@query
def pii_mask_agents(spark, sf_dir):
    return _masked(spark, sf_dir, "agents").select("agent_id", "email_hash", "phone_hash")


@query
def pii_mask_drivers(spark, sf_dir):
    return _masked(spark, sf_dir, "drivers").select("_order", "driver_id", "phone_hash", "national_id_hash")


@query
def quarantine_annotate(spark, sf_dir):
    bad = val.rejected_rows(labelled(spark, sf_dir, "customers"))
    return quarantine.annotate(bad, "data_validation", RUN_TIME).select(
        "_order", "rejection_reason", "rejection_detail", "rejection_timestamp", "source_file")


@query
def sla_due_times(spark, sf_dir):
    rows = star(spark, sf_dir, "fact_ticket").drop("sla_first_due_at", "sla_resolve_due_at")
    return sla.with_due_times(rows, star(spark, sf_dir, "dim_priority")).select(
        "ticket_id", "sla_first_due_at", "sla_resolve_due_at")


@query
def sla_flags(spark, sf_dir):
    return tickets(spark, sf_dir).select(
        "ticket_id", "is_first_response_breached", "is_resolution_breached",
        "first_response_seconds", "resolution_minutes")


@query
def sla_flags_incremental(spark, sf_dir):
    """Tickets of the first half month carry old flags; only the others are derived."""
    old = F.col("created_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    prior = star(spark, sf_dir, "fact_ticket").withColumns({
        "is_first_response_breached": F.when(old, F.lit(True)),
        "is_resolution_breached": F.when(old, F.lit(False)),
        "first_response_seconds": F.when(old, F.lit(-1)),
        "resolution_minutes": F.when(old, F.lit(0).cast("decimal(8,2)")),
    })
    return sla.with_sla_flags(prior, incremental=True).select(
        "ticket_id", "is_first_response_breached", "is_resolution_breached",
        "first_response_seconds", "resolution_minutes", sla.needs_refresh().alias("still_due"))


# Row rules ----------------------------------------------------------------------

@query
def dedup_keep_first(spark, sf_dir):
    return val.keep_first(lineitem_copies(spark, sf_dir), TABLES["orders"]).select(
        "order_id", "l_quantity", "l_extendedprice", "l_shipdate")


@query
def dedup_stats(spark, sf_dir):
    collapsed = val.collapse_copies(typed(spark, sf_dir, "orders"), TABLES["orders"])
    null = F.col("order_id").isNull()
    return collapsed.groupBy("_file").agg(
        F.sum("_copies").alias("total"),
        F.sum(F.when(null, F.col("_copies")).otherwise(F.col("_copies") - 1)).alias("duplicates_removed"),
        F.count_if(~null).alias("kept"))


@query
def null_enforcement(spark, sf_dir):
    first = val.keep_first(typed(spark, sf_dir, "orders"), TABLES["orders"])
    return first.where(rules.null_rule(TABLES["orders"])[1]).select("_file", "order_id")


@query
def email_format(spark, sf_dir):
    rows = typed(spark, sf_dir, "customers")
    return rows.where(rules.bad_email(F.col("email"))).select("_order", "email")


@query
def phone_normalize(spark, sf_dir):
    return raw(spark, sf_dir, "customers").select("_order", rules.normalize_phone(F.col("phone")).alias("phone"))


@query
def phone_format(spark, sf_dir):
    rows = raw(spark, sf_dir, "agents")
    return rows.where(rules.bad_phone(F.col("agent_phone"))).select("agent_id", "agent_phone")


@query
def range_check(spark, sf_dir):
    labels = rules.first_failure(rules.range_rules(TABLES["drivers"]))
    return typed(spark, sf_dir, "drivers").select("_order", labels.alias("label")).where("label is not null")


@query
def required_date(spark, sf_dir):
    (label, missing), = rules.date_rules(TABLES["orders"])
    return typed(spark, sf_dir, "orders").where(missing).select("_order", F.lit(label).alias("label"))


@query
def constraint_check(spark, sf_dir):
    """Orders against the warehouse types; widths narrowed by repeating the text."""
    rows = typed(spark, sf_dir, "orders").withColumns({
        "payment_method": F.when(F.col("payment_method") == "cash", F.repeat("payment_method", 6)).otherwise("card"),
        "order_amount": F.col("order_amount") * 500,
    })
    label = rules.first_failure(rules.constraint_rules(TABLES["orders"]))
    return rows.select("_order", label.alias("label")).where("label is not null")


@query
def rejected_rows(spark, sf_dir):
    return val.rejected_rows(labelled(spark, sf_dir, "customers")).select("_file", "customer_id", "rejection_reason")


@query
def valid_rows(spark, sf_dir):
    return val.valid_rows(labelled(spark, sf_dir, "customers"), TABLES["customers"]).select(
        *TABLES["customers"].column_names)


@query
def validation_stats(spark, sf_dir):
    return val.validation_stats(labelled(spark, sf_dir, "customers"), TABLES["customers"]).drop("null_keys")


# References ---------------------------------------------------------------------

def _parents(spark, sf_dir, names):
    return {
        n: refs.known_keys(star(spark, sf_dir, TABLES[n].warehouse_name), TABLES[n].key, unique=True) for n in names
    }


def _checked(spark, sf_dir, name, salt=1):
    rows = val.valid_rows(labelled(spark, sf_dir, name), TABLES[name])
    wanted = [p for _, p, _ in FACT_REFERENCES[name]]
    checks = refs.fact_checks(FACT_REFERENCES[name], _parents(spark, sf_dir, wanted))
    return refs.label_orphans(rows, checks, TABLES[name].key, salt=salt)


@query
def fk_valid_orders(spark, sf_dir):
    return refs.valid_references(_checked(spark, sf_dir, "orders")).select(*TABLES["orders"].column_names)


@query
def fk_orphan_orders(spark, sf_dir):
    return refs.orphan_rows(_checked(spark, sf_dir, "orders", salt=4)).select(
        "_file", "order_id", "rejection_reason", "orphan_fk_col", "orphan_fk_value")


def _keeping(spark, name):
    folder = scratch_folder(spark, name)

    def keep(values, label):
        values.write.parquet(f"{folder}/{label}")
        return spark.read.schema(values.schema).parquet(f"{folder}/{label}")
    return keep


@query
def fk_labels_by_value(spark, sf_dir):
    """The cascade of orders, each key column tested by its distinct values."""
    spec = TABLES["orders"]
    rows = val.valid_rows(labelled(spark, sf_dir, "orders"), spec)
    parents = _parents(spark, sf_dir, [p for _, p, _ in FACT_REFERENCES["orders"]])
    found = refs.label_orphans_by_value(
        rows, refs.fact_checks(FACT_REFERENCES["orders"], parents), spec.key, _keeping(spark, "fk-values"))
    return refs.orphan_rows(found).select("_file", "order_id", "rejection_reason", "orphan_fk_col", "orphan_fk_value")


@query
def fk_declared_all(spark, sf_dir):
    """Every key a table declares, with a third of each parent's keys taken away: orphans by table, label and value."""
    counts = []
    for name, spec in TABLES.items():
        declared = declared_references(spec)
        if not declared:
            continue
        parents = {}
        for _, parent, _ in declared:
            key = TABLES[parent].key
            parents[parent] = refs.known_keys(typed(spark, sf_dir, parent).where(F.col(key).cast("bigint") % 3 != 1), key)
        rows = val.keep_first(typed(spark, sf_dir, name), spec)
        found = refs.label_orphans_by_value(rows, refs.declared_checks(spec, parents), spec.key, _keeping(spark, f"declared-{name}"))
        counts.append(refs.orphan_rows(found).where(F.col(spec.key).isNotNull()).groupBy("rejection_reason", "orphan_fk_value").agg(
            F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("child"), "*"))
    return functools.reduce(DataFrame.unionByName, counts)


@query
def fk_cascade_label(spark, sf_dir):
    return _checked(spark, sf_dir, "tickets").select("_file", "ticket_id", F.col("_orphan").alias("label"))


def _orphan_counts(spark, sf_dir, name):
    return refs.orphan_rows(_checked(spark, sf_dir, name)).groupBy("rejection_reason").agg(
        F.count(F.lit(1)).alias("rows"))


@query
def orphans_orders(spark, sf_dir):
    return _orphan_counts(spark, sf_dir, "orders")


@query
def orphans_tickets(spark, sf_dir):
    return _orphan_counts(spark, sf_dir, "tickets")


@query
def orphans_events(spark, sf_dir):
    return _orphan_counts(spark, sf_dir, "ticket_events")


@query
def dim_fk_check(spark, sf_dir):
    spec = TABLES["customers"]
    segments = typed(spark, sf_dir, "segments").select("segment_id").where("segment_id <> 4")
    parents = {**_parents(spark, sf_dir, ["regions"]), "segments": segments}
    rows = val.keep_first(typed(spark, sf_dir, "customers"), spec)
    found = refs.label_orphans(rows, refs.declared_checks(spec, parents), spec.key)
    return refs.orphan_rows(found).select("customer_id", "rejection_reason", "orphan_fk_value")


@query
def orphan_stats(spark, sf_dir):
    return refs.orphan_stats(_checked(spark, sf_dir, "tickets"))


@query
def orphan_rate_alerts(spark, sf_dir):
    stats = refs.orphan_stats(_checked(spark, sf_dir, "orders"))
    return refs.orphan_alerts(stats, "orders", threshold=0.08)


@query
def late_dimension_orphans(spark, sf_dir):
    """Customers with a negative balance join after the snapshot: their orders are orphans."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    snapshot = customers.where("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"))
    orders = star(spark, sf_dir, "fact_order")
    check = refs.KeyCheck("customer_id", snapshot, "orphan_customer")
    return refs.orphan_rows(refs.label_orphans(orders, [check], "order_id")).select(
        "order_id", "rejection_reason", "orphan_fk_value")


# Views and reports --------------------------------------------------------------

def _restaurants(spark, sf_dir, **more):
    return views.sla_by_restaurant(
        tickets(spark, sf_dir), *[star(spark, sf_dir, t) for t in ("dim_restaurant", "dim_category", "dim_region")],
        **more)


@query
def v_sla_daily(spark, sf_dir):
    return views.sla_daily(tickets(spark, sf_dir))


@query
def v_sla_by_restaurant(spark, sf_dir):
    return _restaurants(spark, sf_dir)


@query
def v_sla_by_driver(spark, sf_dir):
    return views.sla_by_driver(tickets(spark, sf_dir), star(spark, sf_dir, "dim_driver"))


@query
def v_sla_by_region(spark, sf_dir):
    return views.sla_by_region(
        tickets(spark, sf_dir), *[star(spark, sf_dir, t) for t in ("fact_order", "dim_region", "dim_city")])


@query
def v_revenue_impact(spark, sf_dir):
    return views.revenue_impact(tickets(spark, sf_dir), star(spark, sf_dir, "fact_order"))


@query
def v_reopen_rate(spark, sf_dir):
    return views.reopen_rate(tickets(spark, sf_dir), star(spark, sf_dir, "fact_ticket_event"))


@query
def sla_summary_day(spark, sf_dir):
    return reports.sla_summary(tickets(spark, sf_dir), "2024-01-15")


@query
def sla_health_7(spark, sf_dir):
    return reports.sla_health(tickets(spark, sf_dir))


@query
def top_refund_restaurants(spark, sf_dir):
    return reports.top_refund_restaurants(_restaurants(spark, sf_dir, ordered=False))


@query
def worst_drivers(spark, sf_dir):
    by_driver = views.sla_by_driver(tickets(spark, sf_dir), star(spark, sf_dir, "dim_driver"), ordered=False)
    return reports.worst_drivers(by_driver)


@query
def sla_by_restaurant_10(spark, sf_dir):
    return reports.late_restaurants(_restaurants(spark, sf_dir, ordered=False))


@query
def warehouse_counts(spark, sf_dir):
    names = ("dim_customer", "dim_restaurant", "dim_driver", "fact_order", "fact_ticket", "fact_ticket_event")
    return reports.row_counts({t: star(spark, sf_dir, t) for t in names})


# Audit ---------------------------------------------------------------------------

def _order_stats(spark, sf_dir):
    """Counters per order file, references included; every fourth slot loaded nothing."""
    rows = labelled(spark, sf_dir, "orders")
    good = F.col("_reject").isNull() & F.col("order_id").isNotNull()
    wanted = [p for _, p, _ in FACT_REFERENCES["orders"]]
    checks = refs.fact_checks(FACT_REFERENCES["orders"], _parents(spark, sf_dir, wanted))
    tested = refs.label_orphans(rows, checks, "order_id", where=good)
    stats = tested.groupBy("_file").agg(
        *val.stats_columns(TABLES["orders"]),
        F.count_if(F.col("_orphan").isNotNull()).alias("orphan_count"),
        F.count_if(good & F.col("_orphan").isNull()).alias("loaded"),
    )
    skipped = F.regexp_extract("_file", "/([0-9]+)/orders", 1).cast("int") % 4 == 0
    orphans = F.col("orphan_count")
    return stats.withColumns({
        "orphan_rate": refs.orphan_rate(orphans, F.col("loaded") + orphans),
        "status": F.when(skipped, "skipped").otherwise("success"),
        "valid_records": F.when(~skipped, F.col("loaded")),
        "rejected_records": F.when(~skipped, F.col("total_rejected") + orphans),
    })


def _quality_log(spark, sf_dir):
    return metrics.quality_log_rows(_order_stats(spark, sf_dir), RUN_DATE, RUN_TIME, "orders", 340)


@query
def quality_log_rows(spark, sf_dir):
    return _quality_log(spark, sf_dir)


@query
def quality_daily(spark, sf_dir):
    return metrics.daily_summary(_quality_log(spark, sf_dir), RUN_DATE)


@query
def quality_overview(spark, sf_dir):
    return metrics.quality_overview(_quality_log(spark, sf_dir), RUN_DATE)


@query
def quality_latest(spark, sf_dir):
    """The latest run is the one of the busiest files, so that times differ."""
    log = _quality_log(spark, sf_dir)
    minute = F.make_dt_interval(F.lit(0), F.lit(0), F.col("total_records").cast("int"))
    return metrics.latest_quality(log.withColumn("run_timestamp", F.col("run_timestamp") + minute))


@query
def file_success_rate(spark, sf_dir):
    return metrics.file_success_rate(_quality_log(spark, sf_dir), RUN_DATE)


@query
def run_summary(spark, sf_dir):
    return metrics.run_summary(_quality_log(spark, sf_dir), RUN_DATE)


def _file_status(spark, sf_dir):
    stats = _order_stats(spark, sf_dir)
    return stats.select(
        F.lit("orders").alias("table_name"), F.regexp_extract("_file", "/([0-9]+)/orders", 1).alias("slot"), "status",
        F.coalesce("valid_records", F.lit(0)).alias("rows_loaded"),
        F.coalesce("rejected_records", F.lit(0)).alias("rows_rejected"))


@query
def batch_summary(spark, sf_dir):
    return metrics.batch_summary(_file_status(spark, sf_dir))


@query
def stream_summary(spark, sf_dir):
    status = _file_status(spark, sf_dir)
    return metrics.stream_summary_by_slot(status).unionByName(
        metrics.stream_summary(status).withColumn("slot", F.lit("all")))


# Merge and sinks -------------------------------------------------------------------

def _target(spark, sf_dir):
    """The order table before a load: orders of before 1999."""
    return star(spark, sf_dir, "fact_order").where(F.col("order_created_at") < F.lit("1999-01-01").cast("timestamp_ntz"))


def _load(spark, sf_dir):
    """Line items as later versions of their orders: the last line wins."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select(
        F.concat(F.lit("ord-"), "l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("total_amount"),
        F.col("l_shipdate").alias("order_created_at"),
        "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


LOAD_ORDER = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


@query
def upsert_merge(spark, sf_dir):
    load = _load(spark, sf_dir).withColumns({
        "customer_id": F.col("l_partkey").cast("int"), "region_id": F.col("l_suppkey").cast("int")})
    return merging.merge(_target(spark, sf_dir), load, "order_id", LOAD_ORDER)


@query
def upsert_partial_columns(spark, sf_dir):
    return merging.merge(_target(spark, sf_dir), _load(spark, sf_dir), "order_id", LOAD_ORDER)


@query
def upsert_insert_only(spark, sf_dir):
    keys = _load(spark, sf_dir).select("order_id", "l_shipdate")
    return merging.merge(_target(spark, sf_dir), keys, "order_id", ("l_shipdate",))


@query
def quarantine_roundtrip(spark, sf_dir):
    bad = val.rejected_rows(labelled(spark, sf_dir, "customers")).withColumn("row_id", F.col("_order"))
    rows = quarantine.annotate(bad, "data_validation", RUN_TIME)
    folder = scratch_folder(spark, "quarantine")
    quarantine.write(rows, folder, "customers", "data_validation", RUN_DATE)
    back = spark.read.option("header", True).csv(folder)
    return back.select(
        F.col("row_id").cast("bigint"), F.col("run_date").cast("string"), "table_name", "reason",
        "rejection_detail", "source_file")


# Jobs ---------------------------------------------------------------------------------

def _run(spark, root, **more):
    return table_job.Run(
        spark, Warehouse(spark, f"{root}/warehouse"), f"{root}/quarantine", f"{root}/staging", RUN_DATE,
        run_timestamp=RUN_TIME, **more)


@query
def batch_job_customers(spark, sf_dir):
    run = _run(spark, scratch_folder(spark, "batch-job"))
    batch.run_batch(run, _batch_folder(spark, sf_dir), ["cities", "regions", "segments", "customers"])
    return run.warehouse.read("customers")


def _stream_folder(spark, sf_dir):
    def make(folder):
        for name, filename, fmt in STREAM_FILES:
            fx.write_table(raw(spark, sf_dir, name), name, fmt, filename, folder, RUN_DATE)
    return fx.once(spark, sf_dir, "stream", make)


def _stream_run(spark, sf_dir):
    """A warehouse with clean dimensions, ready for the day's slots."""
    run = _run(spark, scratch_folder(spark, "stream-job"))
    for name in ("customers", "restaurants", "drivers", "regions", "agents"):
        spec = TABLES[name]
        keys = star(spark, sf_dir, spec.warehouse_name).select(spec.key)
        run.warehouse.upsert(name, keys)
    return run


def _streamed(spark, sf_dir, table, *stages):
    """The table after its stage and the ones before it."""
    run = _stream_run(spark, sf_dir)
    folder = _stream_folder(spark, sf_dir)
    found = sources.stream_files(spark, folder, RUN_DATE).where(F.col("table_name").isin(table, *stages))
    run_once(run, folder, found)
    return run.warehouse.read(table)


@query
def stream_job_orders(spark, sf_dir):
    return _streamed(spark, sf_dir, "orders")


@query
def stream_job_tickets(spark, sf_dir):
    return _streamed(spark, sf_dir, "tickets", "orders")


@query
def stream_job_events(spark, sf_dir):
    return _streamed(spark, sf_dir, "ticket_events", "orders", "tickets")


@query
def rerun_idempotent(spark, sf_dir):
    """The day run twice, the second time with an empty ledger: same orders."""
    run = _stream_run(spark, sf_dir)
    folder = _stream_folder(spark, sf_dir)
    found = sources.stream_files(spark, folder, RUN_DATE).where("table_name = 'orders'")
    for terminal in (("success",), ()):
        again = table_job.Run(**{**vars(run), "terminal_statuses": terminal, "run_id": f"run-{len(terminal)}"})
        run_once(again, folder, found)
    return run.warehouse.read("orders").select("order_id", "customer_id", "order_status", "total_amount")


@query
def stream_watch_once(spark, sf_dir):
    """The same load through the file stream, as one available-now run."""
    run = _stream_run(spark, sf_dir)
    folder = fx.once(spark, sf_dir, "stream-orders", lambda f: fx.write_table(
        raw(spark, sf_dir, "orders"), "orders", "json", "orders.json", f, RUN_DATE))
    watch(run, folder, scratch_folder(spark, "watch"), poll_seconds=None).awaitTermination()
    return run.warehouse.read("orders").select("order_id", "customer_id", "order_status", "total_amount")


# What a whole day leaves: all thirteen tables, then the day's slots ------------------------

def _day(spark, sf_dir):
    """The warehouse after the snapshot and the scan of one day, run once per session."""
    def make(folder):
        batch.run_batch(_run(spark, folder), _batch_folder(spark, sf_dir))
        run_once(_run(spark, folder), _stream_folder(spark, sf_dir))
    return _run(spark, fx.once(spark, sf_dir, "day", make)).warehouse


def _table_and_slot(file):
    """Which table and slot a delivered file belongs to, by the manifests; snapshot files have no slot."""
    name = F.lit(None).cast("string")
    for table, filename, _ in (*BATCH_FILES, *STREAM_FILES):
        name = F.when(F.col(file).contains(f"/file={filename}/"), table).otherwise(name)
    return {"table_name": name, "slot": F.regexp_extract(file, "/slot=([0-9]+)/", 1)}


@query
def job_quality_log(spark, sf_dir):
    counters = ("total_records", "valid_records", "rejected_records", "duplicate_count", "null_violation_count",
                "invalid_format_count", "orphan_count")
    log = _day(spark, sf_dir).quality_log().withColumn("slot", _table_and_slot("source_file")["slot"])
    return log.groupBy("table_name", "slot", "status").agg(*[F.sum(c).alias(c) for c in counters])


def _day_files(spark, sf_dir):
    return _day(spark, sf_dir).ledger().withColumns(_table_and_slot("file_path"))


@query
def job_ledger(spark, sf_dir):
    return _day_files(spark, sf_dir).groupBy("table_name", "slot", "status").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))


@query
def job_quarantine(spark, sf_dir):
    found = []
    for name in TABLES:
        for reason in (quarantine.DATA_VALIDATION, quarantine.ORPHAN_REFERENCE, quarantine.CONSTRAINT):
            rows = _day(spark, sf_dir).quarantined(name, reason, RUN_DATE)
            if rows is not None:
                column = F.col("orphan_fk_col") if "orphan_fk_col" in rows.columns else F.lit(None).cast("string")
                found.append(rows.select(F.lit(name).alias("table_name"), F.lit(reason).alias("reason"), "rejection_detail", column.alias("orphan_fk_col")))
    return functools.reduce(DataFrame.unionByName, found).groupBy("table_name", "reason", "rejection_detail", "orphan_fk_col").agg(
        F.count(F.lit(1)).alias("rows"))


@query
def job_alerts(spark, sf_dir):
    alerts = _day(spark, sf_dir).alerts().withColumn("slot", _table_and_slot("source_file")["slot"])
    return alerts.groupBy("kind", "table_name", "slot").agg(
        F.sum("affected_rows").alias("affected_rows"), F.sum("total_rows").alias("total_rows"))


@query
def job_star_counts(spark, sf_dir):
    warehouse = _day(spark, sf_dir)
    return reports.row_counts({spec.warehouse_name: warehouse.read(name) for name, spec in TABLES.items()})


@query
def job_key_index(spark, sf_dir):
    """Keys by the index, which must be those of the table."""
    warehouse = _day(spark, sf_dir)
    return reports.row_counts({spec.warehouse_name: warehouse.keys(name) for name, spec in TABLES.items()})


@query
def job_summaries(spark, sf_dir):
    """The summaries of the snapshot and of the scan, by slot and in all."""
    files = _day_files(spark, sf_dir)
    scanned = files.where("slot <> ''")
    by_slot = metrics.stream_summary_by_slot(scanned).unionByName(
        metrics.stream_summary(scanned).withColumn("slot", F.lit("all")))
    loaded = metrics.batch_summary(files.where("slot = ''")).select(F.lit("snapshot").alias("slot"), "total_rows_loaded", "total_rows_rejected")
    return by_slot.unionByName(loaded, allowMissingColumns=True)


# Views kept as states by day ----------------------------------------------------------------

def _kept_states(spark, sf_dir):
    """A warehouse whose tickets came in two loads, with states refreshed after each."""
    def make(folder):
        warehouse = Warehouse(spark, f"{folder}/warehouse")
        for name in ("restaurants", "categories", "regions", "drivers"):
            rows = star(spark, sf_dir, TABLES[name].warehouse_name)
            warehouse.upsert(name, rows.select(*[c for c in rows.columns if c in TABLES[name].by_name]))
        rows = tickets(spark, sf_dir)
        late = F.pmod(F.xxhash64("ticket_id"), F.lit(3)) == 0
        for part in (rows.where(~late), rows.where(late)):
            warehouse.upsert("tickets", part.select(*[c for c in part.columns if c in TABLES["tickets"].warehouse_schema.names]))
            states.refresh(warehouse)
    return Warehouse(spark, fx.once(spark, sf_dir, "states", make) + "/warehouse")


@query
def state_sla_daily(spark, sf_dir):
    return states.sla_daily(_kept_states(spark, sf_dir))


@query
def state_sla_by_restaurant(spark, sf_dir):
    return states.sla_by_restaurant(_kept_states(spark, sf_dir))


@query
def state_sla_by_driver(spark, sf_dir):
    return states.sla_by_driver(_kept_states(spark, sf_dir))


@query
def state_sla_summary_day(spark, sf_dir):
    return states.sla_summary(_kept_states(spark, sf_dir), "2024-01-15")


@query
def state_sla_health_7(spark, sf_dir):
    return states.sla_health(_kept_states(spark, sf_dir))
