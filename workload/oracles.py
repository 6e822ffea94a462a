"""The same answers in SQL, for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

# Column types as the SQL sees them: 's' text, 'n' number, 't' time.
LINEITEM = {
    "l_orderkey": "n", "l_partkey": "n", "l_suppkey": "n", "l_linenumber": "n", "l_quantity": "n",
    "l_extendedprice": "n", "l_discount": "n", "l_tax": "n", "l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t",
}
DOCUMENTS = {"doc_id": "n", "text": "s", "lang": "s", "source": "s", "n_chars": "n"}
EVENTS = {"event_id": "n", "ts": "t", "user_id": "n", "event_type": "s", "value": "n", "props": "s"}
ORDERS = {"o_orderkey": "n", "o_custkey": "n", "o_orderstatus": "s", "o_totalprice": "n", "o_orderdate": "t", "o_orderpriority": "s"}


def union(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def profile(table: str, columns: dict[str, str], integers_first: bool = False) -> str:
    def part(c: str, kind: str) -> str:
        low, high = f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)"
        if integers_first and kind == "n":
            low, high = f"CAST(min(CAST({c} AS INTEGER)) AS VARCHAR)", f"CAST(max(CAST({c} AS INTEGER)) AS VARCHAR)"
        length = f"CAST(max(length({c})) AS INTEGER)" if kind == "s" else "CAST(NULL AS INTEGER)"
        return (
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
            f"CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / greatest(count(*), 1) AS null_rate, "
            f"count(DISTINCT {c}) AS distinct_count, {low} AS min_value, {high} AS max_value, {length} AS max_length "
            f"FROM {table}"
        )

    return union([part(c, kind) for c, kind in columns.items()])


def key_check(table: str, key: Sequence[str], source: str | None = None) -> str:
    names = ", ".join(key)
    no_null = " AND ".join(f"{k} IS NOT NULL" for k in key)
    return f"""
SELECT '{table}' AS table_name, '{",".join(key)}' AS key_columns,
  CAST(sum(copies) AS BIGINT) AS row_count,
  count(*) FILTER ({no_null}) AS distinct_keys,
  CAST(coalesce(sum(copies) FILTER (NOT ({no_null})), 0) AS BIGINT) AS null_key_rows,
  CAST(coalesce(sum(copies - 1) FILTER ({no_null}), 0) AS BIGINT) AS surplus_rows,
  CAST(coalesce(max(copies) FILTER ({no_null}), 0) AS BIGINT) AS most_copies,
  coalesce(sum(copies) FILTER (NOT ({no_null})), 0) = 0 AND coalesce(sum(copies - 1) FILTER ({no_null}), 0) = 0 AS is_unique
FROM (SELECT {names}, count(*) AS copies FROM {source or table} GROUP BY {names})"""


def cast_loss(table: str, column: str, canonical: str, uncastable="false", fraction="false", altered="false", long="false") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{canonical}' AS canonical_type, count({column}) AS non_null, "
        f"count(*) FILTER ({uncastable}) AS uncastable, count(*) FILTER ({fraction}) AS fraction_lost, "
        f"count(*) FILTER ({altered}) AS altered, count(*) FILTER ({long}) AS too_long FROM {table}"
    )


def foreign_key(table: str, column: str, parent: str, parent_column: str) -> str:
    orphans = f"FROM {table} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{parent}.{parent_column}' AS parent, "
        f"(SELECT count(DISTINCT {column}) {orphans}) AS orphan_keys, (SELECT count(*) {orphans}) AS orphan_rows, "
        f"NOT EXISTS (SELECT 1 {orphans}) AS pass"
    )


GOOD = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
    o_orderdate AS ordered_at, o_orderstatus AS status, o_orderpriority AS priority FROM orders"""
SHIFTED = f"SELECT * REPLACE (ordered_at + INTERVAL 160 MILLISECOND AS ordered_at) FROM ({GOOD})"
DEFECTIVE = f"""SELECT
    CASE WHEN status = 'O' AND total > 495000 THEN -order_id - 1 ELSE order_id END AS order_id,
    customer_id,
    CAST(CASE WHEN priority = '1-URGENT' THEN total + 1000 ELSE total END AS DECIMAL(18,2)) AS total,
    CASE WHEN total < 5000 THEN NULL ELSE ordered_at END AS ordered_at, status, priority
  FROM ({GOOD}) WHERE NOT (status = 'P' AND total > 495000)"""
LINES = """SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS part_id, l_suppkey AS supplier_id,
    CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    l_returnflag AS return_flag, l_shipdate AS shipped_at FROM lineitem"""
LINES_ONCE = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_no
    ORDER BY part_id, supplier_id, quantity, price, return_flag, shipped_at) AS rn FROM ({LINES})) WHERE rn = 1"""
CUSTOMERS = """SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS name, c_mktsegment AS segment,
    CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer"""

NUMERIC = "CASE WHEN s IS NULL AND t IS NULL THEN true WHEN s IS NULL OR t IS NULL THEN false \
WHEN CAST(s AS DOUBLE) = 0 THEN abs(CAST(t AS DOUBLE)) < 1e-9 \
ELSE abs(CAST(s AS DOUBLE) - CAST(t AS DOUBLE)) / abs(CAST(s AS DOUBLE)) <= 1e-4 END"
TEMPORAL = "CASE WHEN s IS NULL AND t IS NULL THEN true WHEN s IS NULL OR t IS NULL THEN false \
ELSE date_trunc('second', CAST(s AS TIMESTAMP)) = date_trunc('second', CAST(t AS TIMESTAMP)) END"


def checks(
    table: str, source: str, target: str, columns: dict[str, str], key: Sequence[str], missing: Sequence[str] = (), share: float = 0.0
) -> str:
    """All checks of one table. `columns` maps each checked column to 'n' (number) or 't' (time)."""
    parts = []

    def measure(check: str, column: str | None, expression: str, rule: str) -> None:
        name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
        head = f"SELECT '{table}' AS table_name, '{check}' AS \"check\", {name} AS column_name"
        if column in missing:
            parts.append(
                f"{head}, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS VARCHAR) AS target, false AS pass, "
                f"'target column {column} is missing' AS error"
            )
            return
        value = f"CAST({expression} AS VARCHAR)"
        parts.append(
            f"{head}, s AS source, t AS target, {rule} AS pass, CAST(NULL AS VARCHAR) AS error "
            f"FROM (SELECT (SELECT {value} FROM ({source})) AS s, (SELECT {value} FROM ({target})) AS t)"
        )

    measure(
        "L1_ROW_COUNT", None, "count(*)",
        f"CASE WHEN CAST(s AS BIGINT) > 0 THEN abs(CAST(s AS BIGINT) - CAST(t AS BIGINT)) <= CAST(s AS BIGINT) * {share} "
        "ELSE CAST(t AS BIGINT) = 0 END",
    )
    for column, kind in columns.items():
        if kind == "n":
            measure("L2_SUM", column, f"coalesce(sum({column}), 0)", NUMERIC)
        rule = NUMERIC if kind == "n" else TEMPORAL
        measure("L2_MIN", column, f"min({column})", rule)
        measure("L2_MAX", column, f"max({column})", rule)
    for column in key:
        measure("L3_DISTINCT", column, f"count(DISTINCT {column})", "s = t")
    return union(parts)


ORDER_COLUMNS = {"order_id": "n", "customer_id": "n", "total": "n", "ordered_at": "t"}
LINE_COLUMNS = {"order_id": "n", "line_no": "n", "part_id": "n", "supplier_id": "n", "quantity": "n", "price": "n", "shipped_at": "t"}
DEFECT_CHECKS = checks("orders", GOOD, DEFECTIVE, ORDER_COLUMNS, ["order_id"], missing=["customer_id"])
ALL_CHECKS = union([
    checks("orders", GOOD, DEFECTIVE, ORDER_COLUMNS, ["order_id"], missing=["customer_id"], share=0.01),
    checks("lineitem", LINES, LINES + " WHERE l_linestatus = 'F'", LINE_COLUMNS, ["order_id", "line_no"], share=0.01),
    checks("customer", CUSTOMERS, CUSTOMERS, {"customer_id": "n", "balance": "n"}, ["customer_id"], share=0.01),
])
VERDICTS = f"""SELECT table_name, count(*) AS checks, count(*) FILTER (pass) AS passed,
  count(*) FILTER (NOT pass) AS failed, bool_and(pass) AS pass FROM ({ALL_CHECKS}) GROUP BY table_name"""

LOADED = """
SELECT 'orders' AS table_name, count(*) AS rows_read, count(*) AS rows_loaded, 0 AS rows_rejected, 0 AS rows_ignored FROM orders
UNION ALL SELECT 'customer', count(*), count(*) FILTER (length(c_mktsegment) <= 9), count(*) FILTER (length(c_mktsegment) > 9), 0 FROM customer
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)), 0,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'events', count(*), count(*) FILTER (length(event_type) <= 6), count(*) FILTER (length(event_type) > 6), 0 FROM events"""



def counted(source: str, group: Sequence[str], measures: dict[str, str]) -> str:
    """Distinct non-empty values of each measure per group, counted over one list of (group, measure, value)."""
    names = ", ".join(group)
    triples = "\nUNION\n".join(
        f"SELECT {names}, '{name}' AS measure, CAST({value} AS VARCHAR) AS value FROM {source}" for name, value in measures.items()
    )
    counts = ", ".join(f"count(value) FILTER (WHERE measure = '{name}' AND value <> '') AS {name}" for name in measures)
    return f"SELECT {names}, {counts} FROM ({triples}) GROUP BY {names}"


V1 = f"""
WITH finished AS (
  SELECT *, o_totalprice >= 250000 AS large FROM orders WHERE o_orderstatus = 'F'),
summed AS ({counted("finished", ["o_custkey", "o_orderpriority", "large"], {
    "dashboard_cnt": "year(o_orderdate)",
    "sheet_cnt": "month(o_orderdate)",
    "field_cnt": "o_orderkey",
    "workbook_cnt": "CASE WHEN month(o_orderdate) > 6 THEN year(o_orderdate) END",
    "table_cnt": "nullif(day(o_orderdate), 1)",
    "column_cnt": "CAST(o_orderdate AS DATE)",
})})
SELECT o_custkey AS datasource_id, o_orderpriority AS datasource, large AS contains_extract, lower(o_orderpriority) AS ds_project,
  * EXCLUDE (o_custkey, o_orderpriority, large),
  CAST(o_custkey IN (SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL) AS BIGINT) AS custom_query_cnt
FROM summed"""

V4 = f"""
WITH returned AS (SELECT * FROM lineitem WHERE l_returnflag = 'R'),
offers AS ({counted("returned", ["l_suppkey"], {
    "datasources": "l_linestatus",
    "fields": "l_partkey",
    "columns": "concat(l_linestatus, '||', nullif(year(l_shipdate), 1999))",
    "tables": "concat(l_linestatus, '||', l_linenumber)",
})}),
uses AS ({counted("orders", ["o_custkey", "o_orderpriority"], {
    "dashboard_cnt": "o_orderdate",
    "sheet_cnt": "year(o_orderdate)",
    "used_field_cnt": "o_orderkey",
    "used_column_cnt": "concat(nullif(o_orderstatus, 'P'), '||', nullif(month(o_orderdate), 2))",
    "used_table_cnt": "concat(nullif(o_orderstatus, 'P'), '||', day(o_orderdate))",
})})
SELECT CAST(o_custkey AS VARCHAR) AS workbook_id, o_orderpriority AS workbook, uses.* EXCLUDE (o_custkey, o_orderpriority),
  coalesce((SELECT max(datasources) FROM offers WHERE l_suppkey = o_custkey), 0) AS datasource_cnt,
  coalesce((SELECT max(fields) FROM offers WHERE l_suppkey = o_custkey), 0) AS total_field_cnt,
  coalesce((SELECT max(columns) FROM offers WHERE l_suppkey = o_custkey), 0) AS total_column_cnt,
  coalesce((SELECT max(tables) FROM offers WHERE l_suppkey = o_custkey), 0) AS total_table_cnt,
  (SELECT count(DISTINCT nullif(c_nationkey, 7)) FROM customer WHERE c_custkey = o_custkey) AS custom_query_cnt,
  coalesce((SELECT CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) FROM lineitem WHERE l_partkey = o_custkey), 0) AS view_cnt
FROM uses"""

REJECT_SPLIT = """
WITH raw AS (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority, o_totalprice, o_orderdate,
    CASE WHEN o_totalprice > 400000 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS grade FROM orders),
judged AS (
  SELECT *, concat_ws(';',
    CASE WHEN status IS NULL THEN 'status:null' END,
    CASE WHEN length(o_orderpriority) > 8 THEN 'priority:too_long' END,
    CASE WHEN try_cast(grade AS INTEGER) IS NULL THEN 'grade:uncastable' END) AS reject_reasons FROM raw)
SELECT reject_reasons, CAST(o_orderkey AS VARCHAR) AS order_id, status, o_orderpriority AS priority, grade,
  CAST(o_totalprice AS VARCHAR) AS total, CAST(o_orderdate AS VARCHAR) AS ordered_at
FROM judged WHERE reject_reasons <> ''"""

ORACLES: dict[str, str] = {
    "v1_status_summary": V1,
    "v2_load_log": """
SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS load_time, event_type AS datasource, user_id AS datasource_id
FROM events GROUP BY ALL ORDER BY load_time DESC""",
    "v3_interactions": """
SELECT o_orderkey AS event_id, c_name AS datasource, c_nationkey AS datasource_id,
  o_orderpriority AS interaction_type, o_orderdate AS interaction_date
FROM customer JOIN orders ON CAST(c_custkey AS VARCHAR) = CAST(o_custkey AS VARCHAR)
WHERE c_mktsegment = 'BUILDING'""",
    "v4_entity_summary": V4,
    "v5_load_log": """
SELECT o_orderdate AS load_time, o_orderstatus AS workbook, o_orderpriority AS workbook_id
FROM orders GROUP BY ALL ORDER BY load_time DESC""",
    "v6_interactions": """
SELECT o_orderkey AS event_id, l_returnflag AS workbook, l_linestatus AS workbook_id,
  o_orderpriority AS event_type, o_orderdate AS event_date
FROM lineitem JOIN orders ON CAST(l_orderkey AS VARCHAR) = CAST(o_orderkey AS VARCHAR)""",
    "scan_filter": """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-01-01'""",
    "range_pages": """
SELECT o_orderkey, CAST((o_orderkey - low) * 16 // (high - low + 1) AS INTEGER) AS page
FROM orders, (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders)""",
    "page_shares": """
SELECT 'clustered' AS key_name, count(*) AS rows_paged, CAST(8 AS BIGINT) AS pages, true AS balanced FROM orders
UNION ALL SELECT 'pages.url', count(*), 8, true FROM pages""",
    "row_counts": union([
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
                  "benchmark labels conversations").split()
    ]),
    "conform_orders": """
SELECT o_orderkey AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, o_orderstatus = 'F' AS is_final,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(o_orderdate AS DATE) AS ordered_on, CAST(NULL AS VARCHAR) AS note,
  CAST(NULL AS SMALLINT) AS ship_weight, o_orderpriority AS priority FROM orders""",
    "conform_labels": """
SELECT toxic = 1 AS is_toxic, quality = 1 AS is_good, CAST(doc_id AS VARCHAR) AS document FROM labels""",
    "conform_doubles": """
SELECT CAST(c_custkey AS INTEGER) AS customer_id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM customer""",
    "conform_json": """
SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS props, upper(event_type) AS kind,
  CAST(value AS DECIMAL(12,2)) AS amount FROM events""",
    "reject_split": REJECT_SPLIT,
    "reject_files": REJECT_SPLIT,
    "reject_json_null": """
SELECT 'props:null' AS reject_reasons, CAST(event_id AS VARCHAR) AS event_id, '{}' AS props FROM events
WHERE NOT coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) > 50""",
    "reject_transform": """
SELECT concat_ws(';', CASE WHEN o_orderstatus = 'P' THEN 'level:transform_failed' END,
    CASE WHEN o_orderkey % 5 = 0 THEN 'share:transform_failed' END) AS reject_reasons,
  CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderstatus <> 'P' THEN '7' END AS level,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey // nullif(o_orderkey % 5, 0) AS VARCHAR) END AS share
FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 5 = 0""",
    "reject_scale": """
SELECT 'price:scale_lost' AS reject_reasons, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_no,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price
FROM lineitem WHERE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) % 10 <> 0""",
    "accepted_rows": """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS SMALLINT) AS line_no, CAST(l_extendedprice AS INTEGER) AS whole_price,
  l_returnflag AS return_flag FROM lineitem
WHERE l_returnflag <> 'N' AND l_extendedprice = floor(l_extendedprice)""",
    "cast_loss": union([
        cast_loss("lineitem", "l_orderkey", "INT2", uncastable="l_orderkey > 32767"),
        cast_loss("lineitem", "l_quantity", "INT4", fraction="l_quantity <> floor(l_quantity)", altered="l_quantity <> floor(l_quantity)"),
        cast_loss("lineitem", "l_tax", "INT4", fraction="l_tax <> floor(l_tax)", altered="l_tax <> floor(l_tax)"),
        cast_loss("lineitem", "l_discount", "DECIMAL",
                  altered="CAST(l_discount AS DECIMAL(4,2)) <> CAST(CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(3,1))"),
        cast_loss("lineitem", "l_extendedprice", "DECIMAL", uncastable="l_extendedprice >= 10000"),
        cast_loss("lineitem", "l_returnflag", "INT1", uncastable="l_returnflag IS NOT NULL"),
        cast_loss("lineitem", "l_shipdate", "DATE", altered="l_shipdate <> CAST(l_shipdate AS DATE)"),
        cast_loss("events", "event_id", "INT2", uncastable="event_id > 32767"),
        cast_loss("events", "ts", "DATE", altered="ts <> CAST(ts AS DATE)"),
        cast_loss("events", "event_type", "TEXT", long="length(event_type) > 5"),
        cast_loss("events", "value", "INT4", fraction="value <> floor(value)", altered="value <> floor(value)"),
        cast_loss("events", "props", "TEXT", long="length(props) > 8"),
    ]),
    "profile_lineitem": profile("lineitem", LINEITEM),
    "profile_documents": profile("documents", DOCUMENTS),
    "profile_events": profile("events", EVENTS),
    "profile_file": profile(
        "customer", {"c_custkey": "n", "c_name": "s", "c_nationkey": "n", "c_mktsegment": "s", "c_acctbal": "n"}
    ),
    "profile_integers_first": profile("orders", ORDERS, integers_first=True),
    "key_check": union([
        key_check("orders", ["o_orderkey"]),
        key_check("orders", ["o_custkey"]),
        key_check("customer", ["c_custkey"]),
        key_check("lineitem", ["l_orderkey", "l_linenumber"]),
        key_check("events", ["event_id"]),
        key_check("documents", ["doc_id"]),
        key_check("conversations", ["conv_id", "turn"]),
        key_check("conversations", ["conv_id"]),
        key_check("pages", ["url"]),
    ]),
    "key_check_nulls": key_check(
        "orders", ["o_custkey", "priority"], "(SELECT o_custkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)"
    ),
    "orphans": """
SELECT o_orderkey, count(*) AS row_count FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_orderkey""",
    "orphan_rows": "SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "foreign_keys": union([
        foreign_key("lineitem", "l_orderkey", "orders", "o_orderkey"),
        foreign_key("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        foreign_key("orders", "o_custkey", "customer", "c_custkey"),
        foreign_key("orders", "o_orderkey", "lineitem", "l_orderkey"),
        foreign_key("documents", "doc_id", "labels", "doc_id"),
        foreign_key("events", "user_id", "supplier", "s_suppkey"),
    ]),
    "dedupe_lineitem": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
FROM lineitem) WHERE rn = 1""",
    "latest_per_key": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
FROM events) WHERE rn = 1""",
    "load_anti": f"""
SELECT * FROM ({LINES_ONCE}) n WHERE NOT EXISTS (SELECT 1 FROM lineitem d
  WHERE d.l_linestatus = 'F' AND d.l_orderkey = n.order_id AND d.l_linenumber = n.line_no)""",
    "load_stream": GOOD,
    "load_overlap": LINES_ONCE,
    "load_null_keys": f"SELECT * FROM ({LINES_ONCE}) WHERE line_no <> 3",
    "load_batches": f"SELECT *, true AS several_batches FROM ({LINES_ONCE})",
    "load_progress": f"SELECT * FROM ({LOADED}) WHERE table_name = 'lineitem'",
    "load_summary": f"""
SELECT table_name, 'run-1' AS load_run, CAST(0 AS BIGINT) AS load_batch, rows_read, rows_loaded, CAST(rows_rejected AS BIGINT) AS rows_rejected,
  CAST(rows_ignored AS BIGINT) AS rows_ignored, CAST(NULL AS VARCHAR) AS error FROM ({LOADED}) ORDER BY table_name""",
    "load_totals": f"""
SELECT 'run-1' AS load_run, count(*) AS tables, CAST(0 AS BIGINT) AS failures, CAST(sum(rows_read) AS BIGINT) AS rows_read,
  CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded, CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected,
  CAST(sum(rows_ignored) AS BIGINT) AS rows_ignored FROM ({LOADED})""",
    "reconcile_orders": checks("orders", GOOD, SHIFTED, ORDER_COLUMNS, ["order_id"]),
    "reconcile_defects": DEFECT_CHECKS,
    "reconcile_verdict": VERDICTS,
    "reconcile_run": f"""
SELECT count(*) AS tables, count(*) FILTER (pass) AS tables_passed, count(*) FILTER (NOT pass) AS tables_failed,
  CAST(sum(passed) AS BIGINT) AS checks_passed, CAST(sum(failed) AS BIGINT) AS checks_failed, bool_and(pass) AS all_pass
FROM ({VERDICTS})""",
    "report_file": f"""
SELECT 'shop' AS source_engine, 'warehouse' AS target_engine, (SELECT bool_and(pass) FROM ({VERDICTS})) AS all_pass,
  table_name, pass AS table_pass, CAST(checks AS INTEGER) AS checks FROM ({VERDICTS})""",
    "row_diff": f"""
SELECT coalesce(s.order_id, t.order_id) AS order_id,
  CASE WHEN t.order_id IS NULL THEN 'missing' WHEN s.order_id IS NULL THEN 'extra' ELSE 'changed' END AS difference,
  CAST(CASE WHEN s.order_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS source_rows,
  CAST(CASE WHEN t.order_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS target_rows
FROM ({GOOD}) s FULL OUTER JOIN ({DEFECTIVE}) t ON s.order_id = t.order_id
WHERE s.order_id IS NULL OR t.order_id IS NULL OR s.customer_id IS DISTINCT FROM t.customer_id OR s.total IS DISTINCT FROM t.total
  OR s.ordered_at IS DISTINCT FROM t.ordered_at OR s.status IS DISTINCT FROM t.status OR s.priority IS DISTINCT FROM t.priority""",
}
ORACLES["diff_tree"] = ORACLES["row_diff"]
ORACLES["load_filtered"] = ORACLES["load_overlap"]
ORACLES["views_incremental"] = ORACLES["v4_entity_summary"]
ORACLES["views_incremental_source"] = ORACLES["v1_status_summary"]
ORACLES["load_stateful"] = ORACLES["load_overlap"]
ORACLES["profile_incremental"] = f"""
SELECT table_name, column_name, (SELECT count(*) FROM lineitem) AS rows, null_rate, min_value, max_value, max_length, true AS near
FROM ({ORACLES["profile_lineitem"]})"""
ORACLES["page_sketch"] = """
SELECT 'clustered' AS key_name, count(*) AS rows_paged, CAST(8 AS BIGINT) AS pages, true AS balanced FROM orders
UNION ALL SELECT 'customer.c_name', count(*), 4, true FROM customer"""
SAMPLED = "substr(md5(CAST(order_id AS VARCHAR)), 1, 8) < '40000000'"
ORACLES["diff_sample"] = f"""
SELECT *, (SELECT count(*) FROM (SELECT order_id FROM ({GOOD}) UNION SELECT order_id FROM ({DEFECTIVE})) WHERE {SAMPLED}) AS sampled_keys,
  true AS bound_holds FROM ({ORACLES["row_diff"]}) WHERE {SAMPLED}"""
ORACLES["interactions_salted"] = """
SELECT o_orderkey AS event_id, c_name AS datasource, c_nationkey AS datasource_id, o_orderpriority AS interaction_type,
  o_orderdate AS interaction_date
FROM orders JOIN customer ON c_custkey = CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE o_custkey END"""

# Column types as they are stored: 'i' int, 'l' bigint, 'd' double, 's' string, 't' time stamp without zone, 'a' array of float.
STORED = {
    "region": "i r_regionkey s r_name",
    "nation": "i n_nationkey s n_name i n_regionkey",
    "customer": "l c_custkey s c_name i c_nationkey d c_acctbal s c_mktsegment",
    "supplier": "l s_suppkey s s_name i s_nationkey d s_acctbal",
    "part": "l p_partkey s p_name s p_brand s p_type i p_size d p_retailprice",
    "orders": "l o_orderkey l o_custkey s o_orderstatus d o_totalprice t o_orderdate s o_orderpriority",
    "lineitem": "l l_orderkey l l_partkey l l_suppkey i l_linenumber d l_quantity d l_extendedprice d l_discount d l_tax s l_returnflag"
    " s l_linestatus t l_shipdate",
    "events": "l event_id t ts l user_id s event_type d value s props",
    "documents": "l doc_id s text s lang s source l n_chars",
    "embeddings": "l vec_id a embedding i label",
    "pages": "l page_id s url s html",
    "benchmark": "l item_id s text",
    "labels": "l doc_id i quality i toxic",
    "conversations": "l conv_id l turn s role s text",
}
STORED_NAMES = {"i": "int", "l": "bigint", "d": "double", "s": "string", "t": "timestamp_ntz", "a": "array<float>"}


def fitted(table: str, kind: str, c: str) -> str:
    """The ladder of a column's types, with how many values each of them loses."""

    def whole(bits: int) -> str:
        if kind == "s":
            return f"count(*) FILTER ({c} IS NOT NULL AND coalesce(CAST(TRY_CAST({c} AS INT{bits // 8}) AS VARCHAR) <> {c}, true))"
        return f"count(*) FILTER ({c} <> floor({c}) OR {c} NOT BETWEEN -{2 ** (bits - 1)} AND {2 ** (bits - 1) - 1})"

    rungs = [(f"INT{bits // 8}", whole(bits)) for bits in (16, 32, 64)] if kind in "ilds" else []
    if kind == "d":
        rungs += [("FLOAT4", f"count(*) FILTER (CAST(CAST({c} AS FLOAT) AS DOUBLE) <> {c})"), ("FLOAT8", "0")]
    if kind == "s":
        rungs += [("TEXT", "0")]
    if kind == "t":
        rungs = [("DATE", f"count(*) FILTER ({c} <> date_trunc('day', {c}))"), ("DATETIME", "0")]
    if kind == "a":
        rungs = [("JSON", "count(*) FILTER (false)")]
    size = f"'(' || greatest(max(length({c})), 1) || ')'" if kind == "s" else "''"
    names = "[" + ", ".join(f"'{n}'" for n, _ in rungs) + "]"
    losses = "[" + ", ".join(n for _, n in rungs) + "]"
    return f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{STORED_NAMES[kind]}' AS stored_type, {names} AS names, {losses}::BIGINT[] AS losses, coalesce({size}, '') AS size FROM {table}"


def _columns(table: str) -> list[tuple[str, str]]:
    parts = STORED[table].split()
    return list(zip(parts[::2], parts[1::2], strict=True))


ORACLES["fit_types"] = f"""
SELECT table_name, column_name, stored_type, names[rung] || CASE WHEN names[rung] = 'TEXT' THEN size ELSE '' END AS fitted_type,
  losses[rung] AS lost, CASE WHEN rung > 1 THEN names[rung - 1] END AS narrower_type, CASE WHEN rung > 1 THEN losses[rung - 1] END AS narrower_lost
FROM (SELECT *, list_position(losses, 0) AS rung FROM ({union([fitted(t, kind, c) for t in STORED for kind, c in _columns(t)])}))"""
