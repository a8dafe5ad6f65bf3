"""Registered queries of the column-level operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.operators.nullfill import CURRENCY_KEYWORDS
from workload.inputs import amount_text, fresh_db, in_db, money, table, text_orders, words


def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", strata.strip_html(F.col("html")).alias("body"))


# What becomes a blank in the text of a page, one after the other.
BLANKED = ["<[^>]*>", "&[a-zA-Z]+;|&#[0-9]+;", r"\s+"]


def plain_text_sql(column: str) -> str:
    for pattern in BLANKED:
        column = f"regexp_replace({column}, '{pattern}', ' ', 'g')"
    return f"trim({column})"


HTML_STRIP = f"SELECT page_id, {plain_text_sql('html')} AS body FROM pages"


def enum_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    stored = F.concat(F.lit("_"), F.replace("o_orderpriority", F.lit("-"), F.lit("_")))
    return orders.select("o_orderkey", strata.strip_enum_prefix(stored).alias("priority"))


ENUM_PREFIX = r"""
SELECT o_orderkey,
       regexp_replace('_' || replace(o_orderpriority, '-', '_'), '^_\d+_', '') AS priority
FROM orders
"""


def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        strata.json_field(F.col("props"), "k").alias("k"),
        strata.json_field(F.col("props"), "absent").alias("absent"),
    )


JSON_FIELD = """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       json_extract_string(props, '$.absent') AS absent
FROM events
"""


def json_array_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    stored = documents.select("doc_id", words(F.col("text"), "FullName").alias("followers"))
    return stored.select(
        "doc_id", strata.json_array_join(F.col("followers"), "FullName").alias("followers")
    )


JSON_ARRAY_JOIN = """
SELECT doc_id,
       nullif(array_to_string(list_filter(string_split(text, ' '), lambda w: w <> ''), ', '), '')
           AS followers
FROM documents
"""


def br_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    stored = lines.select("l_orderkey", "l_linenumber", money(F.col("l_extendedprice")).alias("price"))
    return stored.withColumn("price", strata.parse_number(F.col("price")).cast("double"))


BR_NUMBER = """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) AS price
FROM lineitem
"""


def forced_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    discount = F.col("l_discount")
    stored = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(discount == 0, "R$ -").when(discount == 0.1, "10%").otherwise(money(discount)).alias("discount"),
        F.lit("R$ -").alias("nothing"),
    )
    typed = strata.type_columns(stored, force_numeric=["discount", "nothing"])
    return typed.select(
        "l_orderkey",
        "l_linenumber",
        F.col("discount").cast("double").alias("discount"),
        F.col("nothing").cast("double").alias("nothing"),
    )


FORCED_NUMERIC = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount = 0 OR l_discount = 0.1 THEN NULL
            ELSE CAST(CAST(l_discount AS DECIMAL(18, 2)) AS DOUBLE) END AS discount,
       CAST(NULL AS DOUBLE) AS nothing
FROM lineitem
"""


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(
        F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))
    return orders.select("o_orderkey", strata.parse_date(F.col("day")).cast("string").alias("day"))


DATE_PARSE = """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
"""

# The same text cells as in workload.inputs.text_orders.
TEXT_ORDERS = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status,
       'R$ ' || translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS total,
       CASE WHEN o_orderstatus = 'P' THEN ''
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS plain_total,
       strftime(o_orderdate, '%d/%m/%Y') AS day,
       CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso_day,
       CASE WHEN o_orderstatus = 'O' THEN 'R$ -' ELSE '' END AS placeholder,
       o_orderpriority AS priority
FROM orders
"""


def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = strata.infer_types(text_orders(spark, sf_dir))
    return report.withColumnRenamed("column", "column_name")


INFER_TYPES = rf"""
WITH cells AS (
    FROM ({TEXT_ORDERS}) UNPIVOT INCLUDE NULLS (cell FOR column_name IN
        (order_key, status, total, plain_total, day, iso_day, placeholder, priority))
), marked AS (
    SELECT column_name,
           coalesce(trim(cell), '') IN ('', '-', 'R$', 'R$ -') AS blank,
           regexp_matches(cell, '^(R\$\s*)?-?(\d{{1,3}}(\.\d{{3}})+|\d+)(,\d+)?$') AS br,
           regexp_matches(cell, '^-?\d+\.\d+$') AS plain,
           (regexp_matches(cell, '^\d{{4}}-\d\d-\d\d$') AND try_strptime(cell, '%Y-%m-%d') IS NOT NULL)
           OR (regexp_matches(cell, '^\d\d/\d\d/\d{{4}}$') AND try_strptime(cell, '%d/%m/%Y') IS NOT NULL) AS date,
           cell
    FROM cells
), forms AS (
    SELECT *, br OR plain AS number, regexp_matches(cell, '^-?\d+$') AS whole_number FROM marked
), counted AS (
    SELECT column_name, count(*) AS n_rows, count(*) FILTER (WHERE blank) AS n_blank,
           count(*) FILTER (WHERE number) AS n_numeric, count(*) FILTER (WHERE date) AS n_date,
           count(*) FILTER (WHERE br AND NOT plain AND NOT whole_number) AS n_br_only,
           count(*) FILTER (WHERE plain AND NOT br) AS n_plain_only,
           count(*) FILTER (WHERE plain AND br) AS n_ambiguous,
           max(CASE WHEN number THEN length(split_part(regexp_replace(cell, '[R$ .-]', '', 'g'), ',', 1)) ELSE 0 END) AS br_whole,
           max(CASE WHEN number THEN length(split_part(cell, ',', 2)) ELSE 0 END) AS br_fraction,
           max(CASE WHEN number THEN length(regexp_replace(split_part(cell, '.', 1), '[R$ ,-]', '', 'g')) ELSE 0 END) AS plain_whole,
           max(CASE WHEN number THEN length(split_part(cell, '.', 2)) ELSE 0 END) AS plain_fraction
    FROM forms GROUP BY column_name
)
SELECT column_name,
       CASE WHEN n_rows = n_blank THEN 'text'
            WHEN n_numeric = n_rows - n_blank AND (n_br_only = 0 OR n_plain_only = 0) THEN 'numeric'
            WHEN n_date = n_rows - n_blank THEN 'date' ELSE 'text' END AS inferred_type,
       n_rows, n_blank, n_numeric, n_date,
       CASE WHEN n_plain_only > 0 AND n_br_only = 0 THEN plain_whole ELSE br_whole END AS integer_digits,
       CASE WHEN n_plain_only > 0 AND n_br_only = 0 THEN plain_fraction ELSE br_fraction END AS fraction_digits,
       n_br_only, n_plain_only, n_ambiguous
FROM counted
"""


def typed_mixed_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text numbers of one, two and three decimals: ``1.234`` is no thousand among them."""
    scale = F.col("l_linenumber") % 3
    price = F.col("l_extendedprice").cast("decimal(18,3)") / 1000
    shown = F.when(scale == 0, price.cast("decimal(18,3)").cast("string"))
    shown = shown.when(scale == 1, price.cast("decimal(18,2)").cast("string")).otherwise(price.cast("decimal(18,1)").cast("string"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", shown.alias("price"))
    typed = strata.type_columns(lines)
    return typed.select("l_orderkey", "l_linenumber", F.round(F.col("price") * 1000).cast("bigint").alias("thousandths"))


TYPED_MIXED_FORMS = """
SELECT l_orderkey, l_linenumber,
       CAST(round(CASE l_linenumber % 3
         WHEN 0 THEN CAST(p AS DECIMAL(18, 3)) WHEN 1 THEN CAST(p AS DECIMAL(18, 2)) ELSE CAST(p AS DECIMAL(18, 1)) END * 1000) AS BIGINT) AS thousandths
FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18, 3)) / 1000 AS DECIMAL(28, 6)) AS p FROM lineitem)
"""


def union_mixed_types_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals, whole numbers and local text of the same column survive union and typing unchanged."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice")
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    one = lines.filter("l_returnflag = 'A'").withColumn("amount", amount.cast("decimal(18,3)"))
    two = lines.filter("l_returnflag = 'N'").withColumn("amount", amount.cast("decimal(18,2)"))
    three = lines.filter("l_returnflag = 'R'").withColumn("amount", money(amount))
    drop = ("l_returnflag", "l_quantity", "l_extendedprice")
    union = strata.union_relations(spark, [("a", one.drop(*drop)), ("n", two.drop(*drop)), ("r", three.drop(*drop))])
    typed = strata.type_columns(union, keep_text=["tabela_origem"])
    return typed.select("tabela_origem", "l_orderkey", "l_linenumber", F.round(F.col("amount") * 100).cast("bigint").alias("cents"))


UNION_MIXED_TYPES_TYPED = """
SELECT lower(l_returnflag) AS tabela_origem, l_orderkey, l_linenumber,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)) * 100) AS BIGINT) AS cents
FROM lineitem
"""


def forced_mixed_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forced column with local amounts, plain amounts, placeholders and words: each amount is read in its own form."""
    turn, amount = F.col("l_linenumber") % 4, F.col("l_extendedprice").cast("decimal(18,2)")
    shown = F.when(turn == 0, money(amount)).when(turn == 1, amount.cast("string")).when(turn == 2, "R$ -").otherwise("n/a")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", shown.alias("amount"))
    typed = strata.type_columns(lines, force_numeric=["amount"])
    return typed.select("l_orderkey", "l_linenumber", F.round(F.col("amount") * 100).cast("bigint").alias("cents"))


FORCED_MIXED_FORMS = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber % 4 < 2 THEN CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)) * 100) AS BIGINT) END AS cents
FROM lineitem
"""

# The first whole number that a double does not hold, less one.
FAR = 2**53


def union_plain_text_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals, plain text and local text in one column, whole numbers of 64 bits and doubles in another: no digit changes."""
    lines = table(spark, sf_dir, "lineitem")
    part = lambda flag: lines.filter(F.col("l_returnflag") == flag)
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    key = F.col("l_orderkey")
    one = part("A").select("l_linenumber", (key + FAR).alias("id"), amount.cast("decimal(18,3)").alias("amount"))
    two = part("N").select("l_linenumber", (key + 0.5).alias("id"), amount.cast("decimal(18,3)").cast("string").alias("amount"))
    three = part("R").select("l_linenumber", key.cast("string").alias("id"), money(amount).alias("amount"))
    typed = strata.union_typed(spark, [("a", one), ("n", two), ("r", three)])
    digits = F.regexp_replace(F.col("id").cast("string"), r"\.?0+$", "")
    return typed.select(
        "tabela_origem", "l_linenumber", F.when(F.col("id") % 10 == 0, F.col("id").cast("bigint").cast("string")).otherwise(digits).alias("id"),
        F.round(F.col("amount") * 100).cast("bigint").alias("cents"),
    )


UNION_PLAIN_TEXT_TYPED = f"""
SELECT lower(l_returnflag) AS tabela_origem, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN CAST(l_orderkey + {FAR} AS VARCHAR) WHEN 'N' THEN l_orderkey || '.5' ELSE CAST(l_orderkey AS VARCHAR) END AS id,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)) * 100) AS BIGINT) AS cents
FROM lineitem
"""


def typed_lost_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What typing let go, counted by the job that wrote the rows: words are lost, placeholders and empty cells are not."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    local = F.when(priority == "5-LOW", "n/a").when(priority == "1-URGENT", "R$ -").otherwise(money(F.col("o_totalprice")))
    plain = F.when(status == "P", "10%").when(status == "F", "").otherwise(amount_text(F.col("o_totalprice")))
    sheet = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_key"), local.alias("local_total"), plain.alias("plain_total")
    )
    lost, database = strata.LostCells(), fresh_db(spark, "typed")
    strata.write_table(strata.type_columns(sheet, force_numeric=["local_total", "plain_total"], lost=lost), database, "orders")
    names = ["order_key", "local_total", "plain_total"]
    nulls = in_db(spark, database, "orders").select(*[F.col(n).isNull().cast("bigint").alias(n) for n in names])
    nulls = nulls.groupBy().agg(*[F.sum(n).alias(n) for n in names]).unpivot([], names, "column", "n_null")
    return lost.frame(spark).drop("relation").join(nulls, "column").withColumnRenamed("column", "column_name")


TYPED_LOST_CELLS = """
SELECT 'order_key' AS column_name, 0::BIGINT AS n_lost, 0::HUGEINT::BIGINT AS n_null
UNION ALL
SELECT 'local_total', count(*) FILTER (o_orderpriority = '5-LOW'), count(*) FILTER (o_orderpriority IN ('5-LOW', '1-URGENT')) FROM orders
UNION ALL
SELECT 'plain_total', count(*) FILTER (o_orderstatus = 'P'), count(*) FILTER (o_orderstatus IN ('P', 'F')) FROM orders
"""


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = strata.type_columns(text_orders(spark, sf_dir), keep_text=["order_key"])
    return typed.select(
        "order_key",
        "status",
        F.col("total").cast("double").alias("total"),
        F.col("plain_total").cast("double").alias("plain_total"),
        F.col("day").cast("string").alias("day"),
        F.col("iso_day").cast("string").alias("iso_day"),
        "placeholder",
        "priority",
    )


TYPED_PROJECTION = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS total,
       CASE WHEN o_orderstatus <> 'P'
            THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END AS plain_total,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS iso_day,
       CASE WHEN o_orderstatus = 'O' THEN 'R$ -' ELSE '' END AS placeholder,
       o_orderpriority AS priority
FROM orders
"""


def _order_parts(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Orders as three tables whose columns and types differ."""
    orders = table(spark, sf_dir, "orders")
    part = lambda status: orders.filter(F.col("o_orderstatus") == status)
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return [
        ("mk101_00___BANCO", part("F").select(key.alias("id"), "o_orderpriority")),
        ("mk202_00___BANCO", part("O").select(key.alias("id"), customer.alias("buyer"))),
        (
            "mk303_00___BANCO",
            part("P").select(
                key.cast("string").alias("id"), customer.cast("int").alias("buyer"), "o_orderpriority"
            ),
        ),
    ]


def union_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.union_relations(spark, _order_parts(spark, sf_dir))


UNION_RELATIONS = """
SELECT 'mk101_00___BANCO' AS tabela_origem, CAST(o_orderkey AS VARCHAR) AS id,
       CAST(NULL AS BIGINT) AS buyer, o_orderpriority
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'mk202_00___BANCO', CAST(o_orderkey AS VARCHAR), o_custkey, NULL
FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT 'mk303_00___BANCO', CAST(o_orderkey AS VARCHAR), o_custkey, o_orderpriority
FROM orders WHERE o_orderstatus = 'P'
"""


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the name of a source table; some names hold no code."""
    nation = F.col("c_nationkey").cast("string")
    name = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("summary"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("MK"), nation, F.lit("_00___BANCO")))
        .otherwise(F.concat(F.lit("mk"), nation, F.lit("_00___ENTREGAS")))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("tabela_origem"))


SOURCES = """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'summary'
            WHEN c_mktsegment = 'MACHINERY' THEN 'MK' || c_nationkey || '_00___BANCO'
            ELSE 'mk' || c_nationkey || '_00___ENTREGAS' END AS tabela_origem
FROM customer
"""


def source_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sources(spark, sf_dir).withColumn("code", strata.source_code(F.col("tabela_origem")))


SOURCE_CODE = f"""
SELECT c_custkey, tabela_origem,
       nullif(lower(regexp_extract(tabela_origem, '(?i)mk[0-9]+')), '') AS code
FROM ({SOURCES})
"""


def distinct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.distinct_codes(_sources(spark, sf_dir))


DISTINCT_CODES = f"""
SELECT DISTINCT code
FROM (SELECT nullif(lower(regexp_extract(tabela_origem, '(?i)mk[0-9]+')), '') AS code FROM ({SOURCES}))
WHERE code IS NOT NULL ORDER BY code
"""


def merge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    pairs = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status != "F", priority).alias("_LEVEL_"),
        F.when(status != "O", F.lower(priority)).alias("LEVEL"),
        F.when(status == "F", F.col("o_custkey")).alias("_BUYER_"),
        F.when(status == "O", -F.col("o_custkey")).alias("BUYER"),
    )
    merged = strata.merge_pairs(
        pairs, [("_LEVEL_", "LEVEL", "merged level"), ("_BUYER_", "BUYER", "BUYER.")]
    )
    return merged.toDF("o_orderkey", "merged_level", "merged_buyer")


MERGE_PAIRS = """
SELECT o_orderkey,
       coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END,
                CASE WHEN o_orderstatus <> 'O' THEN lower(o_orderpriority) END) AS merged_level,
       coalesce(CASE WHEN o_orderstatus = 'F' THEN o_custkey END,
                CASE WHEN o_orderstatus = 'O' THEN -o_custkey END) AS merged_buyer
FROM orders
"""


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with NULLs in every type family."""
    lines, flag = table(spark, sf_dir, "lineitem"), F.col("l_returnflag")
    return lines.select(
        F.nullif("l_orderkey", F.lit(0)).alias("l_orderkey"),
        F.nullif("l_linenumber", F.lit(3)).alias("l_linenumber"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        F.when(flag != "A", F.col("l_extendedprice").cast("decimal(18,2)")).alias("unit_cost"),
        F.when(flag != "R", F.col("l_linestatus")).alias("sale_value"),
        F.when(flag != "A", flag == "N").alias("active"),
        F.when(flag != "R", F.col("l_shipdate")).alias("shipped"),
        F.when(flag != "N", F.col("l_shipdate").cast("date")).alias("ship_day"),
    )


GAPS = """
SELECT nullif(l_orderkey, 0) AS l_orderkey, nullif(l_linenumber, 3) AS l_linenumber,
       nullif(l_returnflag, 'N') AS l_returnflag,
       CASE WHEN l_returnflag <> 'A' THEN CAST(l_extendedprice AS DECIMAL(18, 2)) END AS unit_cost,
       CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS sale_value,
       CASE WHEN l_returnflag <> 'A' THEN l_returnflag = 'N' END AS active,
       CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS shipped,
       CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS ship_day
FROM lineitem
"""


def null_fill_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = strata.null_fill(_gaps(spark, sf_dir))
    return filled.select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("unit_cost").cast("double").alias("unit_cost"),
        "sale_value", "active",
        F.col("shipped").cast("string").alias("shipped"),
        F.col("ship_day").cast("string").alias("ship_day"),
    )


NULL_FILL_PLAIN = f"""
SELECT coalesce(l_orderkey, 0) AS l_orderkey, coalesce(l_linenumber, 0) AS l_linenumber,
       coalesce(l_returnflag, '') AS l_returnflag,
       CAST(coalesce(unit_cost, 0) AS DOUBLE) AS unit_cost,
       coalesce(sale_value, '') AS sale_value, active,
       CAST(shipped AS VARCHAR) AS shipped, CAST(ship_day AS VARCHAR) AS ship_day
FROM ({GAPS})
"""


def null_fill_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = strata.null_fill(_gaps(spark, sf_dir), dates="text")
    return filled.withColumn("unit_cost", F.col("unit_cost").cast("double"))


NULL_FILL_DATES = f"""
SELECT coalesce(l_orderkey, 0) AS l_orderkey, coalesce(l_linenumber, 0) AS l_linenumber,
       coalesce(l_returnflag, '') AS l_returnflag,
       CAST(coalesce(unit_cost, 0) AS DOUBLE) AS unit_cost,
       coalesce(sale_value, '') AS sale_value, active,
       coalesce(CAST(shipped AS VARCHAR), '0000-00-00 00:00:00.000') AS shipped,
       coalesce(CAST(ship_day AS VARCHAR), '0000-00-00 00:00:00.000') AS ship_day
FROM ({GAPS})
"""


def null_fill_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.null_fill(
        _gaps(spark, sf_dir), dates="text", currency_keywords=CURRENCY_KEYWORDS
    )


NULL_FILL_CURRENCY = f"""
SELECT coalesce(l_orderkey, 0) AS l_orderkey, coalesce(l_linenumber, 0) AS l_linenumber,
       coalesce(l_returnflag, '') AS l_returnflag,
       'R$ ' || coalesce(CAST(unit_cost AS VARCHAR), '0') AS unit_cost,
       'R$ ' || coalesce(sale_value, '') AS sale_value, active,
       coalesce(CAST(shipped AS VARCHAR), '0000-00-00 00:00:00.000') AS shipped,
       coalesce(CAST(ship_day AS VARCHAR), '0000-00-00 00:00:00.000') AS ship_day
FROM ({GAPS})
"""

QUERIES = {
    "html_strip": (html_strip, HTML_STRIP),
    "enum_prefix": (enum_prefix, ENUM_PREFIX),
    "json_field": (json_field, JSON_FIELD),
    "json_array_join": (json_array_join, JSON_ARRAY_JOIN),
    "br_number": (br_number, BR_NUMBER),
    "forced_numeric": (forced_numeric, FORCED_NUMERIC),
    "date_parse": (date_parse, DATE_PARSE),
    "infer_types": (infer_types, INFER_TYPES),
    "typed_mixed_forms": (typed_mixed_forms, TYPED_MIXED_FORMS),
    "union_mixed_types_typed": (union_mixed_types_typed, UNION_MIXED_TYPES_TYPED),
    "forced_mixed_forms": (forced_mixed_forms, FORCED_MIXED_FORMS),
    "union_plain_text_typed": (union_plain_text_typed, UNION_PLAIN_TEXT_TYPED),
    "typed_lost_cells": (typed_lost_cells, TYPED_LOST_CELLS),
    "typed_projection": (typed_projection, TYPED_PROJECTION),
    "union_relations": (union_relations, UNION_RELATIONS),
    "source_code": (source_code, SOURCE_CODE),
    "distinct_codes": (distinct_codes, DISTINCT_CODES),
    "merge_pairs": (merge_pairs, MERGE_PAIRS),
    "null_fill_plain": (null_fill_plain, NULL_FILL_PLAIN),
    "null_fill_dates": (null_fill_dates, NULL_FILL_DATES),
    "null_fill_currency": (null_fill_currency, NULL_FILL_CURRENCY),
}
