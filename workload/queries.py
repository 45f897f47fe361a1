"""One Spark query per operator of the inventory."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions.audit import row_fingerprint
from tidemark.functions.layout import to_layout
from tidemark.functions.marks import batch_id
from tidemark.operators import (
    add_columns,
    change_feed,
    changed_rows,
    dedupe_latest,
    deleted_keys,
    dq_profile,
    high_water_mark,
    inserted_rows,
    matched_rows,
    repeated_keys,
    require_unique_keys,
    schema_drift,
    soft_delete,
    type_drift_profile,
    upsert,
)
from tidemark.operators.upsert import fits_broadcast
from tidemark.plans.catalog import CatalogTarget
from tidemark.plans.control import Process, select_processes
from tidemark.plans.ledger import ledger_current, ledger_metadata, read_ledger, run_metrics
from tidemark.plans.store import TargetStore, stage_table
from tidemark.plans.sync import sync, sync_all
from tidemark.session import fresh_dir
from tidemark.sources import incremental_scan, preview, read_files
from workload.inputs import (
    MARK,
    RUN,
    SOURCE,
    audited,
    control_rows,
    delta,
    delta_with_nulls,
    ntz,
    old_target,
    run_rows,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDERS = Process(
    name="SYNC_ORDERS",
    source_table="orders",
    target_table="orders",
    source_system=SOURCE,
    incremental_column="o_orderdate",
    keys=("o_orderkey",),
    enddate=MARK,
)

CONTROL_SCHEMA = """
    PROCESS_NAME string, ACTIVE_FLAG string, SOURCE_SYSTEM string, TARGET_SYSTEM string, LOAD_TYPE string,
    SOURCE_TABLE_NAME string, TARGET_TABLE_NAME string, _CONDITION string, PRIMARY_KEY string, ENDDATE timestamp_ntz
"""


def query(name: str) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        QUERIES[name] = make
        return make

    return register


def _named(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("table_name"), "*") for n, df in parts.items()])


# Scans


@query("scan_table")
def scan_table(spark, sf_dir):
    return read_files(spark, f"{sf_dir}/lineitem.parquet")


@query("scan_target")
def scan_target(spark, sf_dir):
    store = TargetStore(spark, fresh_dir(spark, "scan"), "orders")
    store.adopt(old_target(table(spark, sf_dir, "orders")))
    return store.read()


@query("scan_pushdown_ordered")
def scan_pushdown_ordered(spark, sf_dir):
    return incremental_scan(table(spark, sf_dir, "orders"), "o_orderdate", MARK).orderBy("o_orderdate", "o_orderkey")


@query("preview")
def preview_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "customer"), 10, "c_custkey")


@query("incremental_ts")
def incremental_ts(spark, sf_dir):
    return incremental_scan(table(spark, sf_dir, "orders"), "o_orderdate", MARK)


@query("incremental_inclusive")
def incremental_inclusive(spark, sf_dir):
    return incremental_scan(table(spark, sf_dir, "lineitem"), "l_shipdate", "2001-06-01", inclusive=True)


@query("incremental_events")
def incremental_events(spark, sf_dir):
    return incremental_scan(table(spark, sf_dir, "events"), "ts", "2024-01-15")


@query("incremental_id")
def incremental_id(spark, sf_dir):
    return incremental_scan(table(spark, sf_dir, "documents"), "doc_id", 100)


# Control table and ledger


@query("control_select")
def control_select(spark, sf_dir):
    control = control_rows(table(spark, sf_dir, "customer"))
    return select_processes(
        control, source_system="BUILDING", target_system="DWH", load_type="INCREMENTAL"
    )


@query("high_water_mark")
def high_water_marks(spark, sf_dir):
    columns = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return _named({n: high_water_mark(table(spark, sf_dir, n), c).select("enddate") for n, c in columns.items()})


@query("ledger_current")
def ledger_newest(spark, sf_dir):
    runs = run_rows(table(spark, sf_dir, "orders"))
    return ledger_current(runs, "process_name", "run_id", "enddate")


@query("ledger_metadata")
def ledger_json(spark, sf_dir):
    return ledger_metadata(run_rows(table(spark, sf_dir, "orders")))


@query("run_metrics")
def run_metrics_of_runs(spark, sf_dir):
    return run_metrics(run_rows(table(spark, sf_dir, "orders")))


@query("batch_id")
def batch_ids(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", batch_id(F.col("ts")).alias("batch_id"))


@query("ledger_advance")
def ledger_advance(spark, sf_dir):
    """Three processes from a control table, then the newest ledger row of each."""
    rows = [
        ("ORDERS", "Y", SOURCE, "DWH", "INCREMENTAL", "orders", "orders", "o_orderdate", "o_orderkey", None),
        ("EVENTS", "Y", SOURCE, "DWH", "INCREMENTAL", "events", "events", "ts", None, None),
        ("CUSTOMER", "Y", SOURCE, "DWH", "FULL", "customer", "customer", None, None, None),
        ("PART", "N", SOURCE, "DWH", "FULL", "part", "part", None, None, None),
    ]
    control = spark.createDataFrame(rows, CONTROL_SCHEMA)
    root = fresh_dir(spark, "advance")
    chosen = select_processes(control, source_system=SOURCE, target_system="DWH")
    sync_all(spark, chosen, lambda p: table(spark, sf_dir, p.source_table), root, run_ts=RUN)
    newest = ledger_current(read_ledger(spark, f"{root}/*/ledger"), "process_name")
    return newest.select("process_name", "mode", "enddate", "batch_id", "rows_read")


# Projections


@query("append_audit")
def append_audit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    root = fresh_dir(spark, "append")
    TargetStore(spark, root, "orders").adopt(old_target(orders))
    return sync(spark, replace(ORDERS, keys=()), orders, root, run_ts=RUN).target


@query("warehouse_layout")
def warehouse_layout(spark, sf_dir):
    shipped = F.concat(F.col("l_shipdate").cast("string"), F.lit("Z")).cast("timestamp")
    nested = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_shipdate",
        F.array(shipped, F.lit(None).cast("timestamp")).alias("times"),
        F.create_map("l_returnflag", shipped).alias("flag_time"),
        F.struct(shipped.alias("at"), F.array(shipped).alias("all")).alias("sent"),
        F.array("l_partkey", "l_suppkey", F.col("l_linenumber").cast("long")).alias("ids"),
        F.create_map(F.col("l_returnflag"), F.col("l_linenumber")).alias("flag_line"),
        F.struct(F.col("l_linestatus").alias("status"), F.col("l_partkey").alias("part")).alias("state"),
        shipped.alias("shipped_at"),
    )
    return to_layout(nested, flat=True)


@query("warehouse_layout_nested")
def warehouse_layout_nested(spark, sf_dir):
    """Instants inside nested values as wall-clock times of a zone, nested values kept or as variants."""
    at = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.array(at).alias("times"), F.create_map("event_type", at).alias("by_type"), F.struct("user_id", at.alias("at")).alias("who")
    )
    kept = to_layout(events, zone="Asia/Kolkata").selectExpr("event_id", "times[0] AS first_time", "element_at(map_values(by_type), 1) AS type_time", "who.at AS who_time")
    variants = to_layout(events, zone="Asia/Kolkata", nested="variant").selectExpr("event_id", "variant_get(who, '$.user_id', 'bigint') AS user_id")
    return kept.join(variants, "event_id")


@query("row_fingerprint")
def row_fingerprints(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    # Doubles have no one text in all engines: the price goes in as cents.
    cents = part.withColumn("cents", F.floor(F.col("p_retailprice") * 100))
    return cents.select("p_partkey", row_fingerprint("p_partkey", "p_name", "p_brand", "p_type", "p_size", "cents").alias("md5"))


# Schema comparison and evolution


def _drifted(orders: DataFrame) -> DataFrame:
    return (
        old_target(orders)
        .drop("o_orderpriority")
        .withColumn("o_custkey", F.col("o_custkey").cast("string"))
        .withColumn("legacy_note", F.when(F.col("o_orderstatus") == "F", "kept"))
    )


@query("schema_drift")
def schema_drift_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return schema_drift(orders, _drifted(orders))


@query("schema_add_columns")
def schema_add_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return add_columns(old_target(orders).drop("o_orderpriority"), orders.schema)


@query("schema_evolve")
def schema_evolve(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    root = fresh_dir(spark, "evolve")
    TargetStore(spark, root, "orders").adopt(old_target(orders).drop("o_orderpriority"))
    return sync(spark, ORDERS, orders, root, run_ts=RUN).target


@query("type_drift_profile")
def type_drift(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.regexp_replace("c_name", "[^0-9]", "").alias("c_digits"), "c_mktsegment"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_quantity", (F.col("l_extendedprice") * 1000).alias("l_mills"), F.col("l_extendedprice").cast("decimal(12,2)").alias("l_price"), F.col("l_orderkey"), F.expr("l_shipdate + make_dt_interval(0, l_linenumber - 1)").alias("l_shipped")
    )
    narrower = "l_quantity int, l_mills int, l_price decimal(12,0), l_orderkey tinyint, l_shipped date"

    def ints(df: DataFrame, *keep: str) -> StructType:
        return StructType([f if f.name in keep else StructField(f.name, IntegerType()) for f in df.schema.fields])

    return _named(
        {
            "customer": type_drift_profile(customer, ints(customer, "c_custkey")),
            "part": type_drift_profile(part, ints(part, "p_partkey")),
            "lineitem": type_drift_profile(lines, StructType.fromDDL(narrower), strict=True),
        }
    )


# Upsert


def _merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    stage = stage_table(audited(delta(orders)), fresh_dir(spark, "stage"))
    return old_target(orders), require_unique_keys(stage, "o_orderkey")


@query("upsert")
def upsert_orders(spark, sf_dir):
    target, stage = _merge_inputs(spark, sf_dir)
    return upsert(target, stage, "o_orderkey", broadcast=fits_broadcast(stage))


@query("upsert_shuffled")
def upsert_shuffled(spark, sf_dir):
    target, stage = _merge_inputs(spark, sf_dir)
    return upsert(target, stage, "o_orderkey")


@query("upsert_full_outer")
def upsert_full_outer(spark, sf_dir):
    target, stage = _merge_inputs(spark, sf_dir)
    return upsert(require_unique_keys(target, "o_orderkey"), stage, "o_orderkey", unique_target=True)


@query("upsert_matched")
def upsert_matched(spark, sf_dir):
    target, stage = _merge_inputs(spark, sf_dir)
    return matched_rows(target, stage, "o_orderkey", broadcast=fits_broadcast(stage))


@query("upsert_inserted")
def upsert_inserted(spark, sf_dir):
    target, stage = _merge_inputs(spark, sf_dir)
    return inserted_rows(target, stage, "o_orderkey", broadcast=fits_broadcast(stage))


@query("upsert_repeated_target")
def upsert_repeated_target(spark, sf_dir):
    """Late orders merged into the lines by the order key, which the lines repeat."""
    orders = table(spark, sf_dir, "orders")
    status = delta(orders).selectExpr("o_orderkey AS l_orderkey", "o_orderstatus AS l_linestatus")
    target = table(spark, sf_dir, "lineitem")
    stage = stage_table(status, fresh_dir(spark, "stage"))
    return upsert(target, require_unique_keys(stage, "l_orderkey"), "l_orderkey")


@query("upsert_nulls")
def upsert_nulls(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stage = stage_table(audited(delta_with_nulls(orders)), fresh_dir(spark, "stage"))
    return upsert(old_target(orders), require_unique_keys(stage, "o_orderkey"), "o_orderkey")


@query("upsert_composite")
def upsert_composite(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    lineitem = table(spark, sf_dir, "lineitem")
    past = F.col("l_shipdate") > ntz(MARK)
    # The upsert reads its target twice, so the rows of the earlier load are found once and written.
    older = dedupe_latest(lineitem.filter(~past), keys, "l_shipdate").select(
        "*", F.lit("OLD").alias("source_system"), ntz("2024-01-01 00:00:00").alias("loaded_at")
    )
    target = stage_table(older, fresh_dir(spark, "target"))
    newest = dedupe_latest(lineitem.filter(past), keys, "l_shipdate")
    stage = stage_table(audited(newest), fresh_dir(spark, "stage"))
    return upsert(target, stage, keys, broadcast=fits_broadcast(stage))


@query("upsert_dup_guard")
def upsert_dup_guard(spark, sf_dir):
    return repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dedupe_latest")
def dedupe_newest(spark, sf_dir):
    return dedupe_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


# Quality


@query("dq_profile")
def dq_profiles(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    keys = {"orders": "o_orderkey", "lineitem": ["l_orderkey", "l_linenumber"]}
    profiles = {name: dq_profile(table(spark, sf_dir, name), k) for name, k in keys.items()}
    profiles["events"] = dq_profile(
        events.select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id")), "user_id"
    )
    return _named(profiles)


# Loads


@query("stage_roundtrip")
def stage_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = fresh_dir(spark, "stage")
    stage_table(orders.select("o_orderkey"), path)
    return stage_table(delta(orders), path)


@query("first_load")
def first_load(spark, sf_dir):
    process = replace(ORDERS, enddate=None)
    return sync(spark, process, table(spark, sf_dir, "orders"), fresh_dir(spark, "first"), run_ts=RUN).target


@query("full_load")
def full_load(spark, sf_dir):
    """A full load over an older version: nothing of it is left."""
    customer = table(spark, sf_dir, "customer")
    process = Process("FULL_CUSTOMER", "customer", "customer", SOURCE, load_type="FULL")
    root = fresh_dir(spark, "full")
    TargetStore(spark, root, "customer").adopt(audited(customer.filter("c_acctbal < 0")))
    return sync(spark, process, customer, root, run_ts=RUN).target


def _synced(
    spark: SparkSession, sf_dir: str, runs: int = 1, process: Process = ORDERS, **options
) -> tuple[str, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    root = fresh_dir(spark, "sync")
    TargetStore(spark, root, "orders").adopt(old_target(orders))
    results = [sync(spark, process, orders, root, run_ts=RUN, inclusive=i > 0, **options) for i in range(runs)]
    return root, results[-1].target


@query("sync_orders")
def sync_orders(spark, sf_dir):
    """Flagship: read past the mark, merge into the old target, commit, read the new version."""
    return _synced(spark, sf_dir)[1]


@query("sync_shuffled")
def sync_shuffled(spark, sf_dir):
    """The same run with a stage that counts as too large to broadcast."""
    return _synced(spark, sf_dir, broadcast_bytes=-1)[1]


@query("sync_cast")
def sync_cast(spark, sf_dir):
    """The source's key and customer arrive as text; the target keeps its types."""
    orders = table(spark, sf_dir, "orders")
    root = fresh_dir(spark, "cast")
    TargetStore(spark, root, "orders").adopt(old_target(orders))
    text = orders.withColumns({c: F.col(c).cast("string") for c in ("o_orderkey", "o_custkey")})
    return sync(spark, ORDERS, text, root, run_ts=RUN).target


@query("sync_two_sources")
def sync_two_sources(spark, sf_dir):
    """Two processes feed one target; each goes on from its own mark."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    root = fresh_dir(spark, "two")
    people = customer.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    firms = supplier.selectExpr("s_suppkey * 20 AS id", "s_name AS name", "s_nationkey AS nation")
    shared = {"target_table": "party", "incremental_column": "id", "keys": ("id",)}
    crm, erp = Process("CUSTOMERS", "customer", source_system="CRM", **shared), Process("SUPPLIERS", "supplier", source_system="ERP", **shared)
    half = customer.count() // 2
    # The first run of the one reads past what the first run of the other leaves unread.
    sync(spark, crm, people.filter(F.col("id") <= half), root, run_ts=RUN)
    sync(spark, erp, firms.filter("id % 40 = 0"), root, run_ts=RUN)
    sync(spark, crm, people, root, run_ts=RUN)
    return sync(spark, erp, firms, root, run_ts=RUN, from_mark=0).target


@query("sync_idempotent")
def sync_idempotent(spark, sf_dir):
    """Two more runs, reading the mark's own rows again, change nothing."""
    return _synced(spark, sf_dir, runs=3)[1]


@query("sync_empty")
def sync_empty(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    latest = high_water_mark(orders, "o_orderdate").first().mark
    return _synced(spark, sf_dir, process=replace(ORDERS, enddate=latest))[1]


@query("sync_metrics")
def sync_metrics(spark, sf_dir):
    root, _ = _synced(spark, sf_dir)
    newest = ledger_current(read_ledger(spark, f"{root}/*/ledger"), "target_table")
    return newest.select(
        "process_name", "mode", "mark", "mark_type", "batch_id", "rows_read", "rows_updated", "rows_inserted",
        "status", "null_keys", "repeated_keys", F.size("drift").cast("bigint").alias("drifted"),
    )


@query("sync_quality")
def sync_quality(spark, sf_dir):
    """The run record of a load with repeated and missing keys, a new column and one of another type."""
    lineitem = table(spark, sf_dir, "lineitem")
    keyed = lineitem.withColumn("l_orderkey", F.when(F.col("l_returnflag") != "A", F.col("l_orderkey")))
    process = Process("SYNC_LINEITEM", "lineitem", "lineitem", SOURCE, incremental_column="l_shipdate", keys=("l_orderkey", "l_linenumber"))
    root = fresh_dir(spark, "quality")
    old = keyed.filter(F.col("l_shipdate") <= ntz(MARK)).drop("l_tax")
    sync(spark, process, old, root, run_ts=RUN, duplicates="latest")
    sync(spark, process, keyed.withColumn("l_suppkey", F.col("l_suppkey").cast("string")), root, run_ts=RUN, duplicates="latest")
    runs = read_ledger(spark, f"{root}/*/ledger")
    drift = F.array_join(F.array_sort(F.transform("drift", lambda d: F.concat_ws(" ", d["column"], d["status"], d["source_type"], d["target_type"]))), "; ")
    return runs.select("run_id", "status", "rows_read", "null_keys", "repeated_keys", drift.alias("drift"))


@query("sync_latest")
def sync_latest(spark, sf_dir):
    """Repeated stage keys, newest kept, merged into a target made the same way."""
    keys = ("l_orderkey", "l_linenumber")
    process = Process(
        "SYNC_LINEITEM", "lineitem", "lineitem", SOURCE, incremental_column="l_shipdate", keys=keys
    )
    lineitem = table(spark, sf_dir, "lineitem")
    root = fresh_dir(spark, "latest")
    sync(spark, process, lineitem.filter(F.col("l_shipdate") <= ntz(MARK)), root, run_ts=RUN, duplicates="latest")
    return sync(spark, process, lineitem, root, run_ts=RUN, duplicates="latest").target


@query("sync_after_spread")
def sync_after_spread(spark, sf_dir):
    """A first load, an update spread over all keys with both sides shuffled, then one of neighbouring keys."""
    orders = table(spark, sf_dir, "orders").withColumn("version", F.lit(1))
    process = replace(ORDERS, incremental_column="version", enddate=None)
    root = fresh_dir(spark, "spread")
    urgent = orders.filter("o_orderpriority = '1-URGENT'").selectExpr("* EXCEPT (version, o_totalprice)", "2 AS version", "o_totalprice + 1 AS o_totalprice")
    near = orders.filter("o_orderkey <= 100").selectExpr("* EXCEPT (version, o_totalprice)", "3 AS version", "o_totalprice + 2 AS o_totalprice")
    results = [sync(spark, process, rows, root, run_ts=RUN, broadcast_bytes=-1, file_bytes=1 << 18) for rows in (orders, urgent, near)]
    return results[-1].target


def _catalog(spark: SparkSession, process: Process) -> CatalogTarget:
    """A new table of the session's catalog, its files in the shared folder."""
    path = fresh_dir(spark, "catalog")
    return CatalogTarget(spark, f"{process.target_table}_{path[-32:]}", fresh_dir(spark, "ledgers"), location=path)


def _catalog_synced(spark: SparkSession, process: Process, *sources: DataFrame, **options) -> CatalogTarget:
    target = _catalog(spark, process)
    for source in sources:
        sync(spark, process, source, "", run_ts=RUN, target=target, **options)
    return target


@query("sync_catalog_append")
def sync_catalog_append(spark, sf_dir):
    """Two runs of a process without a key append to a catalog table, each past the mark of the one before."""
    events = table(spark, sf_dir, "events")
    process = Process("EVENTS", "events", "events", SOURCE, incremental_column="ts")
    return _catalog_synced(spark, process, events.filter("ts <= '2024-01-15'"), events).read()


@query("sync_catalog_full")
def sync_catalog_full(spark, sf_dir):
    """A full load replaces what a catalog table held."""
    customer = table(spark, sf_dir, "customer")
    process = Process("FULL_CUSTOMER", "customer", "customer", SOURCE, load_type="FULL")
    return _catalog_synced(spark, process, customer.withColumn("c_acctbal", F.lit(0.0)), customer).read()


@query("sync_catalog_merge")
def sync_catalog_merge(spark, sf_dir):
    """A merge into a catalog table writes back the partitions of the key that it touches."""
    orders = table(spark, sf_dir, "orders").withColumn("version", F.lit(1))
    urgent = orders.filter("o_orderpriority = '1-URGENT'").selectExpr("* EXCEPT (version, o_totalprice)", "2 AS version", "o_totalprice + 1 AS o_totalprice")
    process = replace(ORDERS, incremental_column="version", enddate=None)
    return _catalog_synced(spark, process, orders.filter("o_orderkey % 3 <> 0 OR o_orderpriority <> '1-URGENT'"), urgent, file_bytes=1 << 18).read()


@query("catalog_add_columns")
def catalog_add_columns(spark, sf_dir):
    """A column that the source gains is added to the catalog table; rows of before have NULL."""
    orders = table(spark, sf_dir, "orders")
    early = orders.filter(F.col("o_orderdate") <= ntz(MARK)).drop("o_orderpriority")
    return _catalog_synced(spark, replace(ORDERS, enddate=None), early, orders).read()


@query("sync_zoned")
def sync_zoned(spark, sf_dir):
    """Instants around the end of daylight saving time, appended in two runs and a third that finds nothing."""
    shifted = table(spark, sf_dir, "events").selectExpr("event_id", "CAST(concat(CAST(ts + INTERVAL '300' DAY AS string), 'Z') AS timestamp) AS happened", "value")
    process = Process("ZONED", "events", "zoned", SOURCE, incremental_column="happened")
    root = fresh_dir(spark, "zoned")
    for cut in ("2024-11-03 05:30:00Z", "2025-01-01 00:00:00Z", "2025-01-01 00:00:00Z"):
        done = sync(spark, process, shifted.filter(F.col("happened") <= F.lit(cut).cast("timestamp")), root, run_ts=RUN, zone="America/New_York")
    return done.target


@query("sync_changed_only")
def sync_changed_only(spark, sf_dir):
    """All orders again over a version in which only the late and urgent ones differ: the others keep their load time."""
    orders = table(spark, sf_dir, "orders")
    old = orders.withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice")))
    root = fresh_dir(spark, "changed")
    TargetStore(spark, root, "orders").adopt(old.select("*", F.lit("OLD").alias("source_system"), ntz("2024-01-01 00:00:00").alias("loaded_at")), "o_orderkey", 1 << 18)
    return sync(spark, ORDERS, orders, root, run_ts=RUN, skip_unchanged=True, file_bytes=1 << 18).target


# Changes


@query("upsert_changed_only")
def upsert_changed_only(spark, sf_dir):
    """The upsert without rows that would only get a new load time."""
    target, stage = _merge_inputs(spark, sf_dir)
    return upsert(target, changed_rows(target, stage, "o_orderkey"), "o_orderkey")


@query("change_feed")
def change_feed_of_orders(spark, sf_dir):
    """Both values of every order that is new, changed or gone since the older target."""
    orders = table(spark, sf_dir, "orders")
    source = orders.filter("o_orderstatus <> 'F' OR o_orderpriority <> '5-LOW'")
    feed = change_feed(old_target(orders), source, "o_orderkey")
    return feed.selectExpr("o_orderkey", "kind", "before.o_totalprice AS price_before", "after.o_totalprice AS price_after", "after.o_orderdate AS date_after")


@query("deleted_keys")
def deleted_order_keys(spark, sf_dir):
    """Orders of customers that the lines do not name any more."""
    return deleted_keys(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS o_orderkey"), "o_orderkey")


@query("soft_delete")
def soft_delete_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return soft_delete(old_target(orders), table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS o_orderkey"), "o_orderkey", ntz(str(RUN)))


@query("sync_rewind")
def sync_rewind(spark, sf_dir):
    """A control row set back to an earlier day reads again from there."""
    root, _ = _synced(spark, sf_dir)
    back = replace(ORDERS, enddate="1997-01-01 00:00:00")
    return sync(spark, back, table(spark, sf_dir, "orders"), root, run_ts=RUN).target
