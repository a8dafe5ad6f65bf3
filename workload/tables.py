"""Registered queries of the table-level operators and pipelines, each with its SQL."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.functions.names import EXTRACTED_AT, GENERATION_ID, META, RAW_ID, layer_db, q, resolve_db
from strata.operators.layers import RUN_AT as RUN_AT_COLUMN
from strata.operators.layers import RUN_SOURCE, RUN_TARGET, run_log_table
from strata.plans import relational, schedules, sheets, tickets
from strata.session import in_parallel, scratch_dir
from strata.sources.odata import rejected_pages
from workload.inputs import (
    amount_text,
    fresh_db,
    fresh_subject,
    in_db,
    money,
    raw_tickets,
    source_db,
    table,
    text_orders,
)
from workload.scalar import GAPS, TEXT_ORDERS, _gaps, plain_text_sql

RUN_AT = datetime(2024, 1, 1)


def layer_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = source_db(spark, sf_dir, ["customer", "lineitem", "orders", "supplier"])
    target = resolve_db(fresh_subject(spark, "lines", ("copy",)), "copy")
    strata.copy_layer(spark, source, target)
    rows = in_db(spark, target, "customer").withColumn("table_name", F.lit("customer"))
    for name in ("lineitem", "orders", "supplier"):
        copied = in_db(spark, target, name).withColumn("table_name", F.lit(name))
        rows = rows.unionByName(copied, allowMissingColumns=True)
    return rows.withColumns({n: F.col(n).cast("string") for n in ("o_orderdate", "l_shipdate")})


LAYER_COPY = """
SELECT 'customer' AS table_name, * FROM customer
UNION ALL BY NAME
SELECT 'lineitem' AS table_name, * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem
UNION ALL BY NAME
SELECT 'orders' AS table_name, * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders
UNION ALL BY NAME
SELECT 'supplier' AS table_name, * FROM supplier
"""


def _gap_tables(spark: SparkSession, sf_dir: str) -> str:
    """A database with two tables that hold NULLs."""
    database = fresh_db(spark, "gaps")
    strata.write_table(_gaps(spark, sf_dir), database, "lines")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.nullif("c_nationkey", F.lit(7)).alias("value_nation"),
    )
    strata.write_table(customers, database, "customers")
    return database


def _gap_rows(spark: SparkSession, database: str, money_type: str) -> DataFrame:
    lines = in_db(spark, database, "lines").select(
        F.lit("lines").alias("table_name"),
        F.col("l_orderkey").alias("key"),
        F.col("l_returnflag").alias("label"),
        F.col("unit_cost").cast(money_type).alias("cost"),
        "sale_value",
        F.col("shipped").cast("string").alias("shipped"),
        F.col("l_linenumber").alias("line"),
        "active",
        F.col("ship_day").cast("string").alias("ship_day"),
    )
    customers = in_db(spark, database, "customers").select(
        F.lit("customers").alias("table_name"),
        F.col("c_custkey").alias("key"),
        F.col("segment").alias("label"),
        F.lit(None).cast(money_type).alias("cost"),
        F.col("value_nation").cast("string").alias("sale_value"),
        F.lit(None).cast("string").alias("shipped"),
        F.lit(None).cast("int").alias("line"),
        F.lit(None).cast("boolean").alias("active"),
        F.lit(None).cast("string").alias("ship_day"),
    )
    return lines.unionAll(customers)


def _gap_sql(cost: str, sale: str, date: str, nation: str, cost_type: str) -> str:
    return f"""
SELECT 'lines' AS table_name, coalesce(l_orderkey, 0) AS key, coalesce(l_returnflag, '') AS label,
       {cost} AS cost, {sale} AS sale_value, {date.format("shipped")} AS shipped,
       coalesce(l_linenumber, 0) AS line, active, {date.format("ship_day")} AS ship_day
FROM ({GAPS})
UNION ALL
SELECT 'customers', c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), ''),
       CAST(NULL AS {cost_type}), {nation}, NULL, NULL, NULL, NULL
FROM customer
"""


def layer_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_db(spark, "filled")
    strata.transform_layer(spark, _gap_tables(spark, sf_dir), target, strata.null_fill)
    return _gap_rows(spark, target, "double")


LAYER_NULL_FILL = _gap_sql(
    cost="CAST(coalesce(unit_cost, 0) AS DOUBLE)",
    sale="coalesce(sale_value, '')",
    date="CAST({} AS VARCHAR)",
    nation="CAST(coalesce(nullif(c_nationkey, 7), 0) AS VARCHAR)",
    cost_type="DOUBLE",
)


def finance_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    subject = fresh_subject(spark, "finance", ("mart",))
    relational.run_finance(spark, _gap_tables(spark, sf_dir), subject, RUN_AT)
    return _gap_rows(spark, layer_db("mart", subject), "double")


FINANCE_MART = _gap_sql(
    cost="CAST(coalesce(unit_cost, 0) AS DOUBLE)",
    sale="coalesce(sale_value, '')",
    date="coalesce(CAST({} AS VARCHAR), '0000-00-00 00:00:00.000')",
    nation="CAST(coalesce(nullif(c_nationkey, 7), 0) AS VARCHAR)",
    cost_type="DOUBLE",
)


def crm_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    subject = fresh_subject(spark, "crm", ("mart",))
    relational.run_crm(spark, _gap_tables(spark, sf_dir), subject, RUN_AT)
    return _gap_rows(spark, layer_db("mart", subject), "string")


CRM_MART = _gap_sql(
    cost="'R$ ' || coalesce(CAST(unit_cost AS VARCHAR), '0')",
    sale="'R$ ' || coalesce(sale_value, '')",
    date="coalesce(CAST({} AS VARCHAR), '0000-00-00 00:00:00.000')",
    nation="'R$ ' || CAST(coalesce(nullif(c_nationkey, 7), 0) AS VARCHAR)",
    cost_type="VARCHAR",
)

PROFILED = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def layer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two recorded profiles, with the time of the first."""
    source, history = source_db(spark, sf_dir, PROFILED), fresh_db(spark, "audit")
    strata.record_profile(spark, source, history, profiled_at=RUN_AT)
    latest = strata.record_profile(spark, source, history, profiled_at=RUN_AT + timedelta(days=1))
    return latest.select(
        "table_name", "row_count", "column_count", (F.col("size_in_bytes") > 0).alias("has_size"),
        F.col("profiled_at").cast("string").alias("profiled_at"),
        F.col("first_seen").cast("string").alias("first_seen"),
    )


LAYER_PROFILE = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, "
    f"(SELECT count(*) FROM (DESCRIBE {t})) AS column_count, true AS has_size, "
    "'2024-01-02 00:00:00' AS profiled_at, '2024-01-01 00:00:00' AS first_seen"
    for t in PROFILED
)


def _altered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with lost, new, changed and filled rows."""
    orders = table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    kept = orders.filter((status != "P") | (priority != "5-LOW"))
    changed = kept.select(
        "o_orderkey",
        "o_custkey",
        F.coalesce(F.nullif(status, F.lit("O")), F.lit("open")).alias("o_orderstatus"),
        F.when(priority == "1-URGENT", F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
        "o_orderdate",
        F.when(priority != "2-HIGH", priority).alias("o_orderpriority"),
    )
    extra = orders.filter(status == "F").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return changed.unionAll(extra.select(changed.columns))


ORDERS_BEFORE = """
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'O') AS o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
"""

ORDERS_AFTER = """
SELECT o_orderkey, o_custkey, coalesce(nullif(o_orderstatus, 'O'), 'open') AS o_orderstatus,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, nullif(o_orderpriority, '2-HIGH') AS o_orderpriority
FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'
UNION ALL
SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'F'
"""


def layer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = fresh_db(spark, "before"), fresh_db(spark, "after")
    orders = table(spark, sf_dir, "orders")
    blanked = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    strata.write_table(blanked, before, "orders")
    strata.write_table(_altered_orders(spark, sf_dir), after, "orders")
    return strata.reconcile_layers(spark, before, after, key="o_orderkey")


def _reconcile_sql(column: str) -> str:
    return f"""
SELECT 'orders' AS table_name, '{column}' AS column_name,
       count(*) FILTER (WHERE a.o_orderkey = b.o_orderkey AND a.{column} IS NOT DISTINCT FROM b.{column}) AS matched,
       count(*) FILTER (WHERE a.o_orderkey = b.o_orderkey AND a.{column} IS DISTINCT FROM b.{column}
                        AND a.{column} IS NOT NULL) AS changed,
       count(*) FILTER (WHERE a.o_orderkey = b.o_orderkey AND a.{column} IS NULL
                        AND b.{column} IS NOT NULL) AS null_filled,
       count(*) FILTER (WHERE b.o_orderkey IS NULL) AS missing,
       count(*) FILTER (WHERE a.o_orderkey IS NULL) AS extra,
       CAST(0 AS BIGINT) AS unpaired_source, CAST(0 AS BIGINT) AS unpaired_target
FROM ({ORDERS_BEFORE}) a FULL OUTER JOIN ({ORDERS_AFTER}) b ON a.o_orderkey = b.o_orderkey
"""


LAYER_RECONCILE = " UNION ALL ".join(
    _reconcile_sql(c)
    for c in ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
)


def reconcile_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    after = lines.filter(F.col("l_returnflag") != "A").withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    return strata.reconcile(lines, after, key="l_orderkey", table="lineitem")


def _repeated_sql(column: str, equal: str) -> str:
    return f"""
SELECT 'lineitem' AS table_name, '{column}' AS column_name,
       count(*) FILTER (WHERE ns = 1 AND nt = 1 AND {equal}) AS matched,
       count(*) FILTER (WHERE ns = 1 AND nt = 1 AND NOT {equal}) AS changed,
       CAST(0 AS BIGINT) AS null_filled,
       count(*) FILTER (WHERE ns = 1 AND nt = 0) AS missing,
       CAST(0 AS BIGINT) AS extra,
       CAST(coalesce(sum(ns) FILTER (WHERE ns > 1), 0) AS BIGINT) AS unpaired_source,
       CAST(coalesce(sum(nt) FILTER (WHERE ns > 1), 0) AS BIGINT) AS unpaired_target
FROM (SELECT l_orderkey, count(*) AS ns, count(*) FILTER (WHERE l_returnflag <> 'A') AS nt
      FROM lineitem GROUP BY l_orderkey)
"""


RECONCILE_REPEATED_KEYS = (
    _repeated_sql("l_quantity", "false") + " UNION ALL " + _repeated_sql("l_returnflag", "true")
)


def reconcile_differing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that differ between orders and an altered copy, old beside new."""
    orders = table(spark, sf_dir, "orders")
    before = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    return strata.differing_rows(before, _altered_orders(spark, sf_dir), key="o_orderkey")


def _differing_sql(column: str) -> str:
    shown = lambda side: f"regexp_replace(CAST({side}.{column} AS VARCHAR), '\\.0$', '')"
    return f"""
SELECT CAST(a.o_orderkey AS VARCHAR) AS key, '{column}' AS column_name,
       CASE WHEN a.{column} IS NULL THEN 'filled' WHEN b.{column} IS NULL THEN 'cleared' ELSE 'changed' END AS kind,
       {shown("a")} AS old_value, {shown("b")} AS new_value
FROM ({ORDERS_BEFORE}) a JOIN ({ORDERS_AFTER}) b ON a.o_orderkey = b.o_orderkey WHERE a.{column} IS DISTINCT FROM b.{column}
"""


_COMPARED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
RECONCILE_DIFFERING_ROWS = " UNION ALL ".join(_differing_sql(c) for c in _COMPARED) + f"""
UNION ALL
SELECT CAST(coalesce(a.o_orderkey, b.o_orderkey) AS VARCHAR), NULL, CASE WHEN b.o_orderkey IS NULL THEN 'missing' ELSE 'extra' END, NULL, NULL
FROM ({ORDERS_BEFORE}) a FULL OUTER JOIN ({ORDERS_AFTER}) b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL
"""


def layer_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of two layers: one renamed, two pairs merged, one table on each side alone, all with their filled values."""
    before, after = fresh_db(spark, "before"), fresh_db(spark, "after")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    pairs = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(status != "F", priority).alias("_LEVEL_"), F.when(status != "O", priority).alias("LEVEL"),
        F.col("o_totalprice").alias("price"), status.alias("dropped"),
    )
    strata.write_table(pairs, before, "orders")
    strata.write_table(table(spark, sf_dir, "supplier"), before, "supplier")
    strata.write_table(table(spark, sf_dir, "nation"), before, "nation")
    merged = strata.merge_pairs(in_db(spark, before, "orders"), [("_LEVEL_", "LEVEL", "level.")])
    plan = merged.drop("dropped").withColumnRenamed("o_orderkey", "order_id").withColumn("source", F.lit("orders"))
    strata.write_table(plan, after, "orders")
    strata.write_table(table(spark, sf_dir, "customer"), after, "customer")
    strata.write_table(table(spark, sf_dir, "nation").drop("n_regionkey"), after, "nation")
    return strata.layer_lineage(spark, before, after, {"orders": plan}, counts=True)


def _alone_sql(side: str, name: str, columns: dict[str, str]) -> str:
    here = lambda c, t: f"'{name}', '{c}', '{t}'"
    none = "NULL, NULL, NULL"
    rows = lambda c: f"count(*), count({c}), NULL, NULL" if side == "source" else f"NULL, NULL, count(*), count({c})"
    both = lambda c, t: f"{here(c, t)}, {none}" if side == "source" else f"{none}, {here(c, t)}"
    return " UNION ALL ".join(f"SELECT {both(c, t)}, '{side}_only', {rows(c)} FROM {name}" for c, t in columns.items())


LAYER_LINEAGE = f"""
WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS a,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS b, o_totalprice AS price, o_orderstatus AS dropped
  FROM orders)
SELECT 'orders' AS source_table, 'o_orderkey' AS source_column, 'bigint' AS source_type, 'orders' AS target_table,
       'order_id' AS target_column, 'bigint' AS target_type, 'renamed' AS relation, count(*) AS source_rows,
       count(o_orderkey) AS source_filled, count(*) AS target_rows, count(o_orderkey) AS target_filled FROM o
UNION ALL SELECT 'orders', '_LEVEL_', 'string', 'orders', 'level.', 'string', 'merged', count(*), count(a), count(*), count(coalesce(a, b)) FROM o
UNION ALL SELECT 'orders', 'LEVEL', 'string', 'orders', 'level.', 'string', 'merged', count(*), count(b), count(*), count(coalesce(a, b)) FROM o
UNION ALL SELECT 'orders', 'price', 'double', 'orders', 'price', 'double', 'same', count(*), count(price), count(*), count(price) FROM o
UNION ALL SELECT 'orders', 'dropped', 'string', NULL, NULL, NULL, 'source_only', count(*), count(dropped), NULL, NULL FROM o
UNION ALL SELECT NULL, NULL, NULL, 'orders', 'source', 'string', 'target_only', NULL, NULL, count(*), count(*) FROM o
UNION ALL SELECT 'nation', 'n_nationkey', 'int', 'nation', 'n_nationkey', 'int', 'same', count(*), count(*), count(*), count(*) FROM nation
UNION ALL SELECT 'nation', 'n_name', 'string', 'nation', 'n_name', 'string', 'same', count(*), count(*), count(*), count(*) FROM nation
UNION ALL SELECT 'nation', 'n_regionkey', 'int', NULL, NULL, NULL, 'source_only', count(*), count(*), NULL, NULL FROM nation
UNION ALL {_alone_sql("source", "supplier", {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"})}
UNION ALL {_alone_sql("target", "customer", {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"
})}
"""


def land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, database = scratch_dir(spark, "tabs"), fresh_db(spark, "raw")
    customers = table(spark, sf_dir, "customer")
    stored = customers.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    strata.write_sheet(stored, folder)
    strata.land(strata.read_sheet(spark, folder, multiline=True), database, "customer", generation_id=3)
    landed = in_db(spark, database, "customer")
    ids = landed.groupBy(RAW_ID).agg(F.count("*").alias("uses"))
    repeated = ids.filter("uses > 1").select(RAW_ID).withColumn("id_repeated", F.lit(True))
    return landed.join(repeated, RAW_ID, "left").select(
        *customers.columns,
        (F.col(RAW_ID).isNotNull() & F.col("id_repeated").isNull()).alias("has_own_id"),
        F.col(EXTRACTED_AT).isNotNull().alias("has_load_time"),
        F.col(META).alias("changes"),
        F.col(GENERATION_ID).alias("generation_id"),
    )


LAND_ROUNDTRIP = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) AS c_acctbal, c_mktsegment,
       true AS has_own_id, true AS has_load_time, '{"changes":[]}' AS changes,
       CAST(3 AS BIGINT) AS generation_id
FROM customer
"""


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "export")
    strata.export_layer(spark, source_db(spark, sf_dir, ["documents", "region"]), folder)
    tab = lambda name: strata.read_sheet(spark, f"{folder}/{name}", multiline=True).withColumn(
        "table_name", F.lit(name)
    )
    return tab("documents").unionByName(tab("region"), allowMissingColumns=True)


EXPORT_ROUNDTRIP = """
SELECT 'documents' AS table_name, CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text,
       nullif(lang, '') AS lang, nullif(source, '') AS source, CAST(n_chars AS VARCHAR) AS n_chars
FROM documents
UNION ALL BY NAME
SELECT 'region' AS table_name, CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region
"""


def sheet_header_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as one tab a segment, each with its columns in another order."""
    folder, customers = scratch_dir(spark, "tabs"), table(spark, sf_dir, "customer")
    names, tabs = customers.columns, []
    stored = customers.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    segments = sorted(r[0] for r in customers.select("c_mktsegment").distinct().collect())
    for i, segment in enumerate(segments):
        path = f"{folder}/{segment.lower()}"
        rows, turn = stored.filter(F.col("c_mktsegment") == segment), i % len(names)
        strata.write_sheet(rows.select(names[turn:] + names[:turn]), path)
        tabs.append((segment, strata.read_sheet(spark, path)))
    return strata.union_relations(spark, tabs)


SHEET_HEADER_ORDER = """
SELECT c_mktsegment AS tabela_origem, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
"""


def sheet_header_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tabs in five orders of columns, one of which lacks a column, read by one call."""
    folder, customers = scratch_dir(spark, "groups"), table(spark, sf_dir, "customer")
    names = customers.columns
    stored = customers.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    for i in range(5):
        order = [n for n in names[i:] + names[:i] if i or n != "c_mktsegment"]
        strata.write_sheet(stored.filter(F.col("c_nationkey") % 5 == i).select(order), f"{folder}/{i}")
    return strata.read_sheet(spark, folder, by_name=True)


SHEET_HEADER_GROUPS = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) AS c_acctbal,
       CASE WHEN c_nationkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment
FROM customer
"""


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is replaced by other columns while it is read: the reader sees the old rows, the next one the new."""
    database, lines = fresh_db(spark, "replaced"), table(spark, sf_dir, "lineitem")
    strata.write_table(lines.select("l_orderkey", "l_linenumber", "l_quantity"), database, "lines")
    before = in_db(spark, database, "lines").groupBy("l_linenumber").agg(F.sum("l_quantity").alias("total"))
    strata.write_table(
        in_db(spark, database, "lines").filter("l_quantity > 25").select(F.col("l_linenumber").alias("line"), (F.col("l_quantity") * 2).alias("double")),
        database, "lines",
    )
    after = in_db(spark, database, "lines").groupBy(F.col("line").alias("l_linenumber")).agg(F.sum("double").alias("total"))
    return before.withColumn("seen", F.lit("before")).unionAll(after.withColumn("seen", F.lit("after")))


REPLACED_TABLE = """
SELECT l_linenumber, sum(l_quantity) AS total, 'before' AS seen FROM lineitem GROUP BY ALL
UNION ALL
SELECT l_linenumber, sum(l_quantity * 2), 'after' FROM lineitem WHERE l_quantity > 25 GROUP BY ALL
"""


def odata_found_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without a schema: all fields of all entities are found, each as text."""
    folder = scratch_dir(spark, "pages")
    status = F.col("o_orderstatus")
    entity = F.struct(
        F.col("o_orderkey").alias("Id"), F.when(status != "F", status).alias("Status"),
        F.when(status == "P", F.struct(F.col("o_custkey").alias("Customer"))).alias("Detail"),
    )
    page = F.to_json(F.struct(F.array(entity).alias("value")))
    table(spark, sf_dir, "orders").select(page.alias("page")).write.text(folder)
    return strata.read_pages(spark, folder)


ODATA_FOUND_FIELDS = """
SELECT CAST(o_orderkey AS VARCHAR) AS Id, nullif(o_orderstatus, 'F') AS Status,
       CASE WHEN o_orderstatus = 'P' THEN '{"Customer":' || o_custkey || '}' END AS Detail
FROM orders
"""


def odata_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "pages")
    detail = F.struct(
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")
    ).alias("Detail")
    entity = lambda role: F.struct(
        F.col("c_custkey").alias("Id"), F.lit(role).alias("Role"), F.col("c_name").alias("Name"), detail
    )
    page = F.to_json(F.struct(F.array(entity("buyer"), entity("payer")).alias("value")))
    table(spark, sf_dir, "customer").select(page.alias("page")).write.text(folder)
    read = strata.read_pages(spark, folder, "Id bigint, Role string, Name string, Detail string")
    return read.withColumn("Segment", strata.json_field(F.col("Detail"), "segment"))


ODATA_PAGES = """
SELECT c_custkey AS Id, role AS Role, c_name AS Name,
       '{"segment":"' || c_mktsegment || '","nation":' || c_nationkey || '}' AS Detail,
       c_mktsegment AS Segment
FROM customer, (VALUES ('buyer'), ('payer')) r(role)
"""


def odata_bad_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages; those of one status are cut short, those of one priority are error documents."""
    folder, schema = scratch_dir(spark, "pages"), "Id bigint, Status string"
    entity = F.struct(F.col("o_orderkey").alias("Id"), F.col("o_orderstatus").alias("Status"))
    page = F.to_json(F.struct(F.array(entity).alias("value")))
    sent = (
        F.when(F.col("o_orderstatus") == "P", F.left(page, F.length(page) - 4))
        .when(F.col("o_orderpriority") == "5-LOW", '{"error":"busy"}')
        .otherwise(page)
    )
    table(spark, sf_dir, "orders").select(sent.alias("page")).write.text(folder)
    entities = strata.read_pages(spark, folder, schema, lenient=True)
    counts = rejected_pages(spark, folder, schema)
    return entities.unionByName(counts, allowMissingColumns=True)


ODATA_BAD_PAGES = """
SELECT o_orderkey AS Id, o_orderstatus AS Status, CAST(NULL AS BIGINT) AS n_pages, CAST(NULL AS BIGINT) AS n_rejected
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
UNION ALL
SELECT NULL, NULL, count(*), count(*) FILTER (WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW') FROM orders
"""

# ---------------------------------------------------------------- tickets

TICKET_CLEAN = rf"""
SELECT 'r' || o_orderkey AS _airbyte_raw_id, o_orderdate AS _airbyte_extracted_at,
       '{{}}' AS _airbyte_meta, CAST(CASE WHEN o_orderstatus <> 'O' THEN 7 END AS BIGINT) AS _airbyte_generation_id,
       o_orderkey AS ID_, {plain_text_sql("html")} AS Body,
       o_orderstatus AS Status, replace(regexp_replace(o_orderpriority, '^\d-', ''), '-', '_') AS Priority,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN replace(o_orderpriority, ' ', ', ') END AS Followers,
       o_orderpriority AS Department,
       CASE WHEN o_orderstatus <> 'P' THEN '2h' END AS Estimation,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS TicketType,
       o_orderstatus = 'F' AS CanBeClosed, o_orderdate AS changedDate,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS createdDate,
       'u' || o_custkey || '@example.com'
           || CASE WHEN o_orderstatus <> 'F' THEN ', ' || lower(o_orderstatus) ELSE '' END AS Accountables,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS ExpectedDate,
       CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS Satisfaction,
       url AS BriefDescription, CAST(NULL AS VARCHAR) AS RequesterDepartment,
       CASE WHEN o_orderstatus <> 'P' THEN true END AS IsConclusionNotified
FROM orders LEFT JOIN pages ON o_orderkey = page_id
"""


def _dates_as_text(df: DataFrame) -> DataFrame:
    dates = ["_airbyte_extracted_at", "changedDate", "createdDate", "ExpectedDate"]
    return df.withColumns({n: F.col(n).cast("string") for n in dates})


_TICKET_DATES = """
CAST(_airbyte_extracted_at AS VARCHAR) AS _airbyte_extracted_at, CAST(changedDate AS VARCHAR) AS changedDate,
CAST(createdDate AS VARCHAR) AS createdDate, CAST(ExpectedDate AS VARCHAR) AS ExpectedDate
"""


def tickets_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(tickets.staging(raw_tickets(spark, sf_dir)))


TICKETS_STAGING = f"SELECT * REPLACE ({_TICKET_DATES}) FROM ({TICKET_CLEAN})"


def tickets_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: raw tickets to mart rows in one plan."""
    return _dates_as_text(tickets.mart(tickets.staging(raw_tickets(spark, sf_dir))))


TICKETS_MART = f"""
SELECT * REPLACE ({_TICKET_DATES},
    coalesce(_airbyte_generation_id, 0) AS _airbyte_generation_id, coalesce(ID_, 0) AS ID_,
    coalesce(Body, '') AS Body, coalesce(Status, '') AS Status, coalesce(Priority, '') AS Priority,
    coalesce(Followers, '') AS Followers, coalesce(Department, '') AS Department,
    coalesce(Estimation, '') AS Estimation, coalesce(TicketType, '') AS TicketType,
    coalesce(Accountables, '') AS Accountables, coalesce(Satisfaction, 0) AS Satisfaction,
    coalesce(BriefDescription, '') AS BriefDescription,
    coalesce(RequesterDepartment, '') AS RequesterDepartment)
FROM ({TICKET_CLEAN})
"""


def tickets_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through written layers."""
    raw, subject = fresh_db(spark, "raw"), fresh_subject(spark, "tickets", ("stg", "mart"))
    strata.write_table(raw_tickets(spark, sf_dir), raw, "tickets")
    return _dates_as_text(tickets.run(spark, f"{q(raw)}.tickets", subject))


# -------------------------------------------------------------- schedules


def _schedules(spark: SparkSession, raw: dict[str, DataFrame], kind: schedules.Kind) -> DataFrame:
    subject = fresh_subject(spark, "schedules", ("raw", "stg", "int", "mart"))
    raw_db = layer_db("raw", subject)
    in_parallel(spark, lambda item: strata.write_table(item[1], raw_db, item[0]), raw.items())
    return schedules.run(spark, raw_db, kinds=[kind], subject=subject)[kind.table]


def _raw_id(*keys: str):
    return F.concat_ws("-", *[F.col(k).cast("string") for k in keys]).alias("_airbyte_raw_id")


def schedules_bank_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bank tables of three schedules that differ in columns and notation."""
    orders = table(spark, sf_dir, "orders")
    part = lambda status: orders.filter(F.col("o_orderstatus") == status)
    key, level = F.col("o_orderkey").cast("string").alias("MK"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    price = money(F.col("o_totalprice")).alias("Valor_entregue__Cliente_")
    raw = {
        "mk101_00___BANCO": part("F").select(_raw_id("o_orderkey"), key, day.alias("Status_Data"), price),
        "mk202_00___BANCO": part("O").select(
            _raw_id("o_orderkey"), key, level.alias("Licoes_Aprendidas"), price
        ),
        "mk303_00___BANCO": part("P").select(
            _raw_id("o_orderkey"), key, day.alias("Status_Data"),
            F.when(level != "5-LOW", level).alias("Licoes_Aprendidas"),
        ),
    }
    mart = _schedules(spark, raw, schedules.BANK)
    return mart.select(
        "codigo_cronograma", "tabela_origem", "_airbyte_raw_id",
        F.col("MK").cast("bigint").alias("MK"),
        F.col("Status_Data").cast("string").alias("Status_Data"),
        "Licoes_Aprendidas",
        F.col("Valor_entregue__Cliente_").cast("double").alias("Valor_entregue__Cliente_"),
    )


SCHEDULES_BANK_MART = """
SELECT code AS codigo_cronograma, code || '_00___BANCO' AS tabela_origem,
       CAST(o_orderkey AS VARCHAR) AS _airbyte_raw_id, o_orderkey AS MK,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS Status_Data,
       CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderpriority <> '5-LOW')
            THEN o_orderpriority ELSE '' END AS Licoes_Aprendidas,
       CASE WHEN o_orderstatus = 'P' THEN 0
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END AS Valor_entregue__Cliente_
FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'mk101' WHEN 'O' THEN 'mk202' ELSE 'mk303' END AS code
      FROM orders)
"""


def schedules_missing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bank tables; one wanted code has no table, and one kind has none at all."""
    orders = table(spark, sf_dir, "orders")
    price = money(F.col("o_totalprice")).alias("Valor_entregue__Cliente_")
    subject = fresh_subject(spark, "schedules", ("raw", "stg", "int", "mart"))
    raw_db = layer_db("raw", subject)
    for status, code in (("F", "mk101"), ("O", "mk202"), ("P", "mk303")):
        part = orders.filter(F.col("o_orderstatus") == status).select(_raw_id("o_orderkey"), price)
        strata.write_table(part, raw_db, f"{code}_00___BANCO")
    marts = schedules.run(
        spark, raw_db, ["mk101", "mk202", "mk303", "mk404"], [schedules.BANK, schedules.ACTIVITIES], subject
    )
    bank = marts["fct_banco"].withColumn(
        "Valor_entregue__Cliente_", F.col("Valor_entregue__Cliente_").cast("double")
    )
    empty = marts["fct_atividades"]
    width = empty.agg(F.count("*").alias("empty_rows"), F.lit(",".join(empty.columns)).alias("empty_columns"))
    return bank.unionByName(width, allowMissingColumns=True)


SCHEDULES_MISSING_TABLES = """
SELECT CASE o_orderstatus WHEN 'F' THEN 'mk101' WHEN 'O' THEN 'mk202' ELSE 'mk303' END AS codigo_cronograma,
       CASE o_orderstatus WHEN 'F' THEN 'mk101' WHEN 'O' THEN 'mk202' ELSE 'mk303' END || '_00___BANCO' AS tabela_origem,
       CAST(o_orderkey AS VARCHAR) AS _airbyte_raw_id,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS Valor_entregue__Cliente_,
       CAST(NULL AS BIGINT) AS empty_rows, CAST(NULL AS VARCHAR) AS empty_columns
FROM orders
UNION ALL
SELECT NULL, NULL, NULL, NULL, 0, 'codigo_cronograma,tabela_origem'
"""


def schedules_activities_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as activity tables; the column names hold nothing in common but two."""
    lines = table(spark, sf_dir, "lineitem")
    part = lambda flag: lines.filter(F.col("l_returnflag") == flag)
    item = F.col("l_partkey").cast("string").alias("No_EAP")
    cost = money(F.col("l_extendedprice")).alias("VALOR_DA_ATIVIDADE")
    start = F.date_format("l_shipdate", "yyyy-MM-dd").alias("DATA_DE_INICIO")
    raw = {
        "mk7_00___ATIVIDADES": part("A").select(_raw_id("l_orderkey", "l_linenumber"), item, cost),
        "mk8_00___ATIVIDADES": part("N").select(_raw_id("l_orderkey", "l_linenumber"), start, item),
        "mk9_00___ATIVIDADES": part("R").select(
            _raw_id("l_orderkey", "l_linenumber"), item, start, F.col("l_linestatus").alias("RESUMO")
        ),
    }
    mart = _schedules(spark, raw, schedules.ACTIVITIES)
    return mart.select(
        "codigo_cronograma", "tabela_origem", "_airbyte_raw_id",
        F.col("No_EAP").cast("bigint").alias("No_EAP"),
        F.col("VALOR_DA_ATIVIDADE").cast("double").alias("VALOR_DA_ATIVIDADE"),
        F.col("DATA_DE_INICIO").cast("string").alias("DATA_DE_INICIO"), "RESUMO",
    )


SCHEDULES_ACTIVITIES_MART = """
SELECT code AS codigo_cronograma, code || '_00___ATIVIDADES' AS tabela_origem,
       l_orderkey || '-' || l_linenumber AS _airbyte_raw_id, l_partkey AS No_EAP,
       CASE WHEN l_returnflag = 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE)
            ELSE 0 END AS VALOR_DA_ATIVIDADE,
       CASE WHEN l_returnflag <> 'A' THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS DATA_DE_INICIO,
       CASE WHEN l_returnflag = 'R' THEN l_linestatus ELSE '' END AS RESUMO
FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'mk7' WHEN 'N' THEN 'mk8' ELSE 'mk9' END AS code
      FROM lineitem)
"""


def schedules_deliveries_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as delivery tables with alternating money columns, two of them placeholders."""
    lines = table(spark, sf_dir, "lineitem")
    part = lambda flag: lines.filter(F.col("l_returnflag") == flag)
    price, tax = money(F.col("l_extendedprice")), money(F.col("l_tax"))
    item = F.col("l_partkey").cast("string").alias("ENTREGA")
    nothing = F.lit("R$ -")
    first = [
        price.alias("_COMISSAO_"), price.alias("_FAT__PRODUTO_"), tax.alias("_FAT__SERVICO_"),
        nothing.alias("FAT__PESSOAL_PRD_"), price.alias("FAT__PESSOAL_SERV_"),
    ]
    second = [
        tax.alias("COMISSAO"), nothing.alias("FAT__PRODUTO"), price.alias("FAT__SERVICO"),
        tax.alias("_FAT__PESSOAL_PRD__"), tax.alias("_FAT__PESSOAL_SERV__"),
    ]
    raw = {
        "mk11_00___ENTREGAS": part("A").select(_raw_id("l_orderkey", "l_linenumber"), item, *first),
        "mk12_00___ENTREGAS": part("N").select(_raw_id("l_orderkey", "l_linenumber"), item, *second),
        "mk13_00___ENTREGAS": part("R").select(_raw_id("l_orderkey", "l_linenumber"), item, *first, *second),
    }
    mart = _schedules(spark, raw, schedules.DELIVERIES)
    merged = {
        "COMISSAO": "comissao", "FAT. PRODUTO": "fat_produto", "FAT. SERVICO": "fat_servico",
        "FAT. PESSOAL PRD.": "fat_pessoal_prd", "FAT. PESSOAL SERV.": "fat_pessoal_serv",
    }
    return mart.select(
        "codigo_cronograma", "tabela_origem", "_airbyte_raw_id",
        F.col("ENTREGA").cast("bigint").alias("ENTREGA"),
        *[F.col(q(name)).cast("double").alias(short) for name, short in merged.items()],
    )


SCHEDULES_DELIVERIES_MART = """
SELECT code AS codigo_cronograma, code || '_00___ENTREGAS' AS tabela_origem,
       l_orderkey || '-' || l_linenumber AS _airbyte_raw_id, l_partkey AS ENTREGA,
       CASE WHEN l_returnflag <> 'N' THEN price ELSE tax END AS comissao,
       CASE WHEN l_returnflag <> 'N' THEN price ELSE 0 END AS fat_produto,
       CASE WHEN l_returnflag <> 'N' THEN tax ELSE price END AS fat_servico,
       CASE WHEN l_returnflag = 'A' THEN 0 ELSE tax END AS fat_pessoal_prd,
       CASE WHEN l_returnflag <> 'N' THEN price ELSE tax END AS fat_pessoal_serv
FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) AS price,
             CAST(CAST(l_tax AS DECIMAL(18, 2)) AS DOUBLE) AS tax,
             CASE l_returnflag WHEN 'A' THEN 'mk11' WHEN 'N' THEN 'mk12' ELSE 'mk13' END AS code
      FROM lineitem)
"""

# ----------------------------------------------------------- spreadsheets


def sheets_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers as text-only sheets, through three layers."""
    source = fresh_db(spark, "sheets")
    subject = fresh_subject(spark, "sheets", ("raw", "stg", "mart"))
    strata.land(text_orders(spark, sf_dir), source, "orders")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer.key"),
        amount_text(F.col("c_acctbal")).alias("balance"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )
    strata.land(customers, source, "customers")
    sheets.run(spark, source, subject, RUN_AT)
    mart = layer_db("mart", subject)
    orders = in_db(spark, mart, "orders").select(
        F.lit("orders").alias("table_name"),
        F.col("order_key").cast("bigint").alias("key"),
        F.col("total").cast("double").alias("amount"),
        F.col("plain_total").cast("double").alias("plain_amount"),
        F.col("day").cast("string").alias("day"),
        F.col("iso_day").cast("string").alias("iso_day"),
        F.concat_ws("/", "status", "placeholder", "priority").alias("label"),
    )
    rest = in_db(spark, mart, "customers").select(
        F.lit("customers").alias("table_name"),
        F.col("`customer.key`").cast("bigint").alias("key"),
        F.col("balance").cast("double").alias("amount"),
        F.lit(None).cast("double").alias("plain_amount"),
        F.lit(None).cast("string").alias("day"),
        F.lit(None).cast("string").alias("iso_day"),
        F.col("segment").alias("label"),
    )
    rows = orders.unionAll(rest)
    # The run logs, without the part of a name that is new in every run.
    plain = lambda name: F.replace(F.replace(name, F.lit(subject), F.lit("sheets")), F.lit(source), F.lit("source"))
    for layer in ("raw", "stg", "mart"):
        log = in_db(spark, layer_db(layer, subject), run_log_table(subject))
        runs = log.select(
            F.lit("log").alias("table_name"),
            F.col(RUN_AT_COLUMN).cast("string").alias("day"),
            F.concat_ws("/", plain(F.col(RUN_SOURCE)), plain(F.col(RUN_TARGET))).alias("label"),
        )
        rows = rows.unionByName(runs, allowMissingColumns=True)
    return rows


SHEETS_MART = f"""
SELECT 'orders' AS table_name, CAST(order_key AS BIGINT) AS key,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS amount,
       CASE WHEN status = 'P' THEN 0 ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END AS plain_amount,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, iso_day,
       status || '/' || placeholder || '/' || priority AS label
FROM ({TEXT_ORDERS}) JOIN orders ON CAST(order_key AS BIGINT) = o_orderkey
UNION ALL
SELECT 'customers', c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS DOUBLE), NULL, NULL, NULL,
       coalesce(nullif(c_mktsegment, 'BUILDING'), '')
FROM customer
UNION ALL
SELECT 'log', NULL, NULL, NULL, '2024-01-01 00:00:00', NULL, step
FROM (VALUES ('source/raw_sheets'), ('raw_sheets/stg_sheets'), ('stg_sheets/mart_sheets')) s(step)
"""

QUERIES = {
    "layer_copy": (layer_copy, LAYER_COPY),
    "layer_null_fill": (layer_null_fill, LAYER_NULL_FILL),
    "layer_profile": (layer_profile, LAYER_PROFILE),
    "layer_reconcile": (layer_reconcile, LAYER_RECONCILE),
    "reconcile_repeated_keys": (reconcile_repeated_keys, RECONCILE_REPEATED_KEYS),
    "reconcile_differing_rows": (reconcile_differing_rows, RECONCILE_DIFFERING_ROWS),
    "layer_lineage": (layer_lineage, LAYER_LINEAGE),
    "land_roundtrip": (land_roundtrip, LAND_ROUNDTRIP),
    "export_roundtrip": (export_roundtrip, EXPORT_ROUNDTRIP),
    "sheet_header_order": (sheet_header_order, SHEET_HEADER_ORDER),
    "sheet_header_groups": (sheet_header_groups, SHEET_HEADER_GROUPS),
    "replaced_table": (replaced_table, REPLACED_TABLE),
    "odata_found_fields": (odata_found_fields, ODATA_FOUND_FIELDS),
    "odata_pages": (odata_pages, ODATA_PAGES),
    "odata_bad_pages": (odata_bad_pages, ODATA_BAD_PAGES),
    "tickets_staging": (tickets_staging, TICKETS_STAGING),
    "tickets_mart": (tickets_mart, TICKETS_MART),
    "tickets_layers": (tickets_layers, TICKETS_MART),
    "schedules_bank_mart": (schedules_bank_mart, SCHEDULES_BANK_MART),
    "schedules_missing_tables": (schedules_missing_tables, SCHEDULES_MISSING_TABLES),
    "schedules_activities_mart": (schedules_activities_mart, SCHEDULES_ACTIVITIES_MART),
    "schedules_deliveries_mart": (schedules_deliveries_mart, SCHEDULES_DELIVERIES_MART),
    "sheets_mart": (sheets_mart, SHEETS_MART),
    "finance_mart": (finance_mart, FINANCE_MART),
    "crm_mart": (crm_mart, CRM_MART),
}
