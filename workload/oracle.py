"""The same results in plain SQL."""

from __future__ import annotations

_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_MARK = "TIMESTAMP '2000-01-01 00:00:00'"
_RUN = "TIMESTAMP '2025-01-01 00:00:00'"
_OLD = "o_orderdate <= TIMESTAMP '2000-12-31 00:00:00'"
_OLD_LOAD = "TIMESTAMP '2024-01-01 00:00:00'"

_T0 = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(floor(o_totalprice) AS DOUBLE) AS o_totalprice,
       o_orderdate, o_orderpriority, 'OLD' AS source_system, {_OLD_LOAD} AS loaded_at
FROM orders WHERE {_OLD}"""

_S = f"SELECT * FROM orders WHERE o_orderdate > {_MARK}"

_S_NULLS = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate > {_MARK}
UNION ALL
SELECT CAST(NULL AS BIGINT), o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate > {_MARK} AND o_orderstatus = 'P'"""


def _merged(target: str, stage: str, keys: list[str], columns: list[str]) -> dict[str, str]:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    hit = f"s.{keys[0]} IS NOT NULL"
    taken = ", ".join(f"CASE WHEN {hit} THEN s.{c} ELSE t.{c} END AS {c}" for c in columns)
    loaded = f"CASE WHEN {hit} THEN {_RUN} ELSE t.loaded_at END AS loaded_at"
    with_ = f"WITH t AS ({target}), s AS ({stage})"
    kept = f"SELECT {taken}, t.source_system, {loaded} FROM t %s JOIN s ON {on}"
    own = ", ".join(f"s.{c}" for c in columns)
    added = f"""SELECT {own}, 'SRC' AS source_system, {_RUN} AS loaded_at
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {on})"""
    return {
        "all": f"{with_} {kept % 'LEFT'} UNION ALL {added}",
        "matched": f"{with_} {kept % 'INNER'}",
        "inserted": f"{with_} {added}",
    }


_ORDERS_MERGE = _merged(_T0, _S, ["o_orderkey"], _ORDERS)

_LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _newest_lines(where: str, extra: str = "") -> str:
    ties = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
    return f"""SELECT {", ".join(_LINEITEM)}{extra} FROM (
SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {ties}) AS rn
FROM lineitem WHERE {where}) WHERE rn = 1"""


def _lines_merge(source_system: str, loaded_at: str) -> str:
    old = _newest_lines(f"l_shipdate <= {_MARK}", f", '{source_system}' AS source_system, {loaded_at} AS loaded_at")
    new = _newest_lines(f"l_shipdate > {_MARK}")
    return _merged(old, new, ["l_orderkey", "l_linenumber"], _LINEITEM)["all"]


def _profile(table: str, keys: str, source: str) -> str:
    null_key = " OR ".join(f"{k.strip()} IS NULL" for k in keys.split(","))
    return f"""SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows,
CAST(coalesce(sum(CASE WHEN {null_key} THEN n END), 0) AS BIGINT) AS null_keys,
count(*) AS distinct_keys, CAST(sum(n) - count(*) AS BIGINT) AS duplicates
FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})"""


def _lost(table: str, column: str, value: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column.upper()}' AS "column", 'string' AS source_type,
'int' AS target_type, count({value}) AS non_null,
count(*) FILTER ({value} IS NOT NULL AND try_cast({value} AS INTEGER) IS NULL) AS lost FROM {table}"""


def _cut(column: str, source: str, target: str, value: str, lost: str) -> str:
    return f"""SELECT 'lineitem' AS table_name, '{column.upper()}' AS "column", '{source}' AS source_type,
'{target}' AS target_type, count({value}) AS non_null, count(*) FILTER ({lost}) AS lost FROM lineitem"""


def _drift(column: str, status: str, source: str | None, target: str | None, value: str, rows: str) -> str:
    def text(t):
        return f"'{t}'" if t else "CAST(NULL AS VARCHAR)"

    return f"""SELECT '{column}' AS "column", '{status}' AS status, {text(source)} AS source_type,
{text(target)} AS target_type, (SELECT count({value}) FROM {rows}) AS non_null"""


ORACLE: dict[str, str] = {
    "scan_table": "SELECT * FROM lineitem",
    "scan_target": _T0,
    "scan_pushdown_ordered": f"{_S} ORDER BY o_orderdate, o_orderkey",
    "preview": "SELECT * FROM customer ORDER BY c_custkey LIMIT 10",
    "incremental_ts": _S,
    "incremental_inclusive": "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01 00:00:00'",
    "incremental_events": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
    "incremental_id": "SELECT * FROM documents WHERE doc_id > 100",
    "control_select": """
SELECT c_name AS "PROCESS_NAME", 'Y' AS "ACTIVE_FLAG", c_mktsegment AS "SOURCE_SYSTEM",
       'DWH' AS "TARGET_SYSTEM", 'INCREMENTAL' AS "LOAD_TYPE"
FROM customer
WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING' AND c_nationkey < 12 AND c_acctbal <= 5000""",
    "high_water_mark": """
SELECT 'orders' AS table_name, max(o_orderdate) AS enddate FROM orders
UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
UNION ALL SELECT 'events', max(ts) FROM events""",
    "ledger_current": """
SELECT 'P' || CAST(o_custkey AS VARCHAR) AS process_name, max(o_orderkey) AS run_id,
       arg_max(o_orderdate, o_orderkey) AS enddate
FROM orders GROUP BY o_custkey""",
    "ledger_metadata": """
SELECT 'P' || CAST(o_custkey AS VARCHAR) AS process_name,
       '{"last_run":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","watermark":"'
       || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '","job_name":"P' || CAST(o_custkey AS VARCHAR)
       || '","table":"' || o_orderpriority || '"}' AS metadata
FROM orders""",
    "run_metrics": """
SELECT 'P' || CAST(o_custkey AS VARCHAR) AS process_name, o_orderkey AS run_id, o_orderkey * 3 AS rows_read,
       o_orderkey AS rows_updated, o_orderkey * 2 AS rows_inserted, CAST(o_custkey AS DOUBLE) AS seconds,
       o_orderdate AS finished_at
FROM orders""",
    "batch_id": "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS batch_id FROM events",
    "ledger_advance": """
SELECT 'ORDERS' AS process_name, 'merge' AS mode, max(o_orderdate) AS enddate,
       '20250101000000' AS batch_id, count(*) AS rows_read FROM orders
UNION ALL SELECT 'EVENTS', 'append', max(ts), '20250101000000', count(*) FROM events
UNION ALL SELECT 'CUSTOMER', 'full', CAST(NULL AS TIMESTAMP), '20250101000000', count(*) FROM customer""",
    "append_audit": f"{_T0} UNION ALL SELECT *, 'SRC', {_RUN} FROM ({_S})",
    "warehouse_layout": """
SELECT l_orderkey, l_shipdate,
       '[' || l_partkey || ',' || l_suppkey || ',' || l_linenumber || ']' AS ids,
       '{"' || l_returnflag || '":' || l_linenumber || '}' AS flag_line,
       '{"status":"' || l_linestatus || '","part":' || l_partkey || '}' AS state,
       '["' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') || '",null]' AS times,
       '{"' || l_returnflag || '":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') || '"}' AS flag_time,
       '{"at":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') || '","all":["' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') || '"]}' AS sent,
       l_shipdate AS shipped_at
FROM lineitem""",
    "warehouse_layout_nested": """
SELECT event_id, ts + INTERVAL 330 MINUTE AS first_time, ts + INTERVAL 330 MINUTE AS type_time,
       ts + INTERVAL 330 MINUTE AS who_time, user_id
FROM events""",
    "row_fingerprint": "SELECT p_partkey, md5(coalesce(length(cast(p_partkey as varchar)) || ':' || cast(p_partkey as varchar), '-') || coalesce(length(cast(p_name as varchar)) || ':' || cast(p_name as varchar), '-') || coalesce(length(cast(p_brand as varchar)) || ':' || cast(p_brand as varchar), '-') || coalesce(length(cast(p_type as varchar)) || ':' || cast(p_type as varchar), '-') || coalesce(length(cast(p_size as varchar)) || ':' || cast(p_size as varchar), '-') || length(cast(cast(floor(p_retailprice * 100) as bigint) as varchar)) || ':' || cast(cast(floor(p_retailprice * 100) as bigint) as varchar)) AS md5 FROM part",
    "schema_drift": " UNION ALL ".join(
        [
            _drift("O_CUSTKEY", "type_mismatch", "bigint", "string", "o_custkey", "orders"),
            _drift("O_ORDERPRIORITY", "new", "string", None, "o_orderpriority", "orders"),
            _drift("SOURCE_SYSTEM", "target_only", None, "string", "*", f"orders WHERE {_OLD}"),
            _drift("LOADED_AT", "target_only", None, "timestamp_ntz", "*", f"orders WHERE {_OLD}"),
            _drift(
                "LEGACY_NOTE", "target_only", None, "string",
                "CASE WHEN o_orderstatus = 'F' THEN 1 END", f"orders WHERE {_OLD}",
            ),
        ]
    ),
    "schema_add_columns": f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM ({_T0})",
    "schema_evolve": _merged(
        f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM ({_T0})", _S, ["o_orderkey"], _ORDERS
    )["all"],
    "type_drift_profile": " UNION ALL ".join(
        [
            _lost("customer", "c_name", "c_name"),
            _lost("customer", "c_digits", "regexp_replace(c_name, '[^0-9]', '', 'g')"),
            _lost("customer", "c_mktsegment", "c_mktsegment"),
            _lost("part", "p_name", "p_name"),
            _cut("l_quantity", "double", "int", "l_quantity", "trunc(l_quantity) <> l_quantity"),
            _cut("l_mills", "double", "int", "l_extendedprice", "trunc(l_extendedprice * 1000) <> l_extendedprice * 1000 OR l_extendedprice * 1000 >= 2147483648"),
            _cut("l_price", "decimal(12,2)", "decimal(12,0)", "l_extendedprice", "CAST(l_extendedprice AS DECIMAL(12,2)) % 1 <> 0"),
            _cut("l_orderkey", "bigint", "tinyint", "l_orderkey", "l_orderkey > 127"),
            _cut("l_shipped", "timestamp_ntz", "date", "l_shipdate", "l_linenumber > 1"),
        ]
    ),
    "upsert": _ORDERS_MERGE["all"],
    "upsert_shuffled": _ORDERS_MERGE["all"],
    "upsert_full_outer": _ORDERS_MERGE["all"],
    "upsert_matched": _ORDERS_MERGE["matched"],
    "upsert_inserted": _ORDERS_MERGE["inserted"],
    "upsert_repeated_target": f"""
WITH t AS (SELECT * FROM lineitem),
     s AS (SELECT o_orderkey AS l_orderkey, o_orderstatus AS l_linestatus FROM orders WHERE o_orderdate > {_MARK})
SELECT {", ".join(f"t.{c}" for c in _LINEITEM if c != "l_linestatus")},
       CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_linestatus ELSE t.l_linestatus END AS l_linestatus
FROM t LEFT JOIN s ON t.l_orderkey = s.l_orderkey
UNION ALL BY NAME SELECT l_orderkey, l_linestatus FROM s WHERE l_orderkey NOT IN (SELECT l_orderkey FROM t)""",
    "upsert_nulls": _merged(_T0, _S_NULLS, ["o_orderkey"], _ORDERS)["all"],
    "upsert_composite": _lines_merge("OLD", _OLD_LOAD),
    "upsert_dup_guard": """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dedupe_latest": _newest_lines("TRUE"),
    "dq_profile": " UNION ALL ".join(
        [
            _profile("orders", "o_orderkey", "orders"),
            _profile("lineitem", "l_orderkey, l_linenumber", "lineitem"),
            _profile(
                "events", "user_id", "(SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events)"
            ),
        ]
    ),
    "stage_roundtrip": _S,
    "first_load": f"SELECT *, {_RUN} AS loaded_at, 'SRC' AS source_system FROM orders",
    "full_load": f"SELECT *, {_RUN} AS loaded_at, 'SRC' AS source_system FROM customer",
    "sync_orders": _ORDERS_MERGE["all"],
    "sync_idempotent": _ORDERS_MERGE["all"],
    "sync_shuffled": _ORDERS_MERGE["all"],
    "sync_cast": _ORDERS_MERGE["all"],
    "sync_two_sources": f"""
WITH c AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer),
     s AS (SELECT s_suppkey * 20 AS id, s_name AS name, s_nationkey AS nation FROM supplier)
SELECT coalesce(c.id, s.id) AS id, coalesce(s.name, c.name) AS name, c.balance, s.nation, {_RUN} AS loaded_at,
       CASE WHEN c.id IS NULL OR (s.id % 40 = 0 AND c.id > (SELECT count(*) // 2 FROM customer)) THEN 'ERP' ELSE 'CRM' END AS source_system
FROM c FULL JOIN s ON c.id = s.id""",
    "sync_empty": _T0,
    "sync_metrics": f"""
WITH t AS ({_T0}), s AS ({_S})
SELECT 'SYNC_ORDERS' AS process_name, 'merge' AS mode, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS mark,
       'timestamp_ntz' AS mark_type, '20250101000000' AS batch_id, count(*) AS rows_read,
       count(*) FILTER (o_orderkey IN (SELECT o_orderkey FROM t)) AS rows_updated,
       count(*) FILTER (o_orderkey NOT IN (SELECT o_orderkey FROM t)) AS rows_inserted,
       'committed' AS status, CAST(0 AS BIGINT) AS null_keys, CAST(0 AS BIGINT) AS repeated_keys, CAST(0 AS BIGINT) AS drifted
FROM s""",
    "sync_quality": f"""
WITH k AS (SELECT CASE WHEN l_returnflag <> 'A' THEN l_orderkey END AS l_orderkey, l_linenumber, l_shipdate > {_MARK} AS late FROM lineitem),
     r AS (SELECT late, count(*) AS repeated FROM (SELECT late FROM k WHERE l_orderkey IS NOT NULL GROUP BY late, l_orderkey, l_linenumber HAVING count(*) > 1) GROUP BY late)
SELECT CASE WHEN k.late THEN 2 ELSE 1 END::BIGINT AS run_id, 'committed' AS status, count(*) AS rows_read,
       count(*) FILTER (l_orderkey IS NULL) AS null_keys, coalesce(any_value(repeated), 0) AS repeated_keys,
       CASE WHEN k.late THEN 'L_SUPPKEY type_mismatch string bigint; L_TAX new double' ELSE '' END AS drift
FROM k LEFT JOIN r ON k.late = r.late GROUP BY k.late""",
    "sync_catalog_append": f"SELECT *, {_RUN} AS loaded_at, 'SRC' AS source_system FROM events",
    "sync_catalog_full": f"SELECT *, {_RUN} AS loaded_at, 'SRC' AS source_system FROM customer",
    "sync_catalog_merge": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS version, {_RUN} AS loaded_at, 'SRC' AS source_system
FROM orders""",
    "catalog_add_columns": f"""
SELECT * REPLACE (CASE WHEN o_orderdate > {_MARK} THEN o_orderpriority END AS o_orderpriority),
       {_RUN} AS loaded_at, 'SRC' AS source_system
FROM orders""",
    "sync_zoned": f"""
SELECT event_id, value, CASE WHEN happened < TIMESTAMP '2024-11-03 06:00:00' THEN happened - INTERVAL 4 HOUR ELSE happened - INTERVAL 5 HOUR END AS happened,
       {_RUN} AS loaded_at, 'SRC' AS source_system
FROM (SELECT event_id, value, ts + INTERVAL 300 DAY AS happened FROM events)""",
    "sync_changed_only": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderdate <= {_MARK} THEN CAST(floor(o_totalprice) AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
       'OLD' AS source_system,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderdate > {_MARK} AND floor(o_totalprice) <> o_totalprice THEN {_RUN} ELSE {_OLD_LOAD} END AS loaded_at
FROM orders""",
    "upsert_changed_only": f"""
WITH m AS ({_ORDERS_MERGE["all"]}), t AS ({_T0})
SELECT m.* REPLACE (CASE WHEN t.o_totalprice = m.o_totalprice THEN t.loaded_at ELSE m.loaded_at END AS loaded_at)
FROM m LEFT JOIN t ON m.o_orderkey = t.o_orderkey""",
    "change_feed": f"""
WITH t AS ({_T0}), s AS (SELECT * FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority <> '5-LOW')
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS kind,
       t.o_totalprice AS price_before, s.o_totalprice AS price_after, s.o_orderdate AS date_after
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
WHERE t.o_orderkey IS NULL OR s.o_orderkey IS NULL OR t.o_totalprice <> s.o_totalprice""",
    "deleted_keys": "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "soft_delete": f"""
SELECT *, CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) THEN {_RUN} END AS deleted_at FROM ({_T0})""",
    "sync_latest": _lines_merge("SRC", _RUN),
    "sync_after_spread": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
       CASE WHEN o_orderkey <= 100 THEN o_totalprice + 2 WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1
            ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey <= 100 THEN 3 WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS version,
       {_RUN} AS loaded_at, 'SRC' AS source_system
FROM orders""",
    "sync_rewind": _merged(
        _T0, "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01 00:00:00'", ["o_orderkey"], _ORDERS
    )["all"],
}
