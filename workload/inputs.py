"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.names import qualified
from strata.operators.layers import create_database
from strata.session import in_parallel, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(value: Column) -> Column:
    """An amount in Brazilian notation, such as ``R$ 1.234,56``."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(value, 2), ",.", ".,"))


def amount_text(value: Column) -> Column:
    return value.cast("decimal(18,2)").cast("string")


def fresh_db(spark: SparkSession, name: str) -> str:
    """An empty database in the shared scratch folder."""
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    return create_database(spark, database, scratch_dir(spark, name))


def fresh_subject(spark: SparkSession, name: str, layers: tuple[str, ...]) -> str:
    """A new subject whose layer databases live in the shared scratch folder."""
    subject = f"{name}_{uuid.uuid4().hex[:12]}"
    for layer in layers:
        create_database(spark, f"{layer}_{subject}", scratch_dir(spark, f"{layer}-{name}"))
    return subject


def source_db(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """A database over given tables, which stay where they are."""
    database = fresh_db(spark, "source")

    def register(name: str) -> None:
        path = f"{sf_dir}/{name}.parquet"
        spark.catalog.createTable(qualified(database, name), path=path, source="parquet")

    in_parallel(spark, register, names)
    return database


def in_db(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(qualified(database, name))


def words(text: Column, field: str) -> Column:
    """JSON array of objects, one per blank-separated word; empty words become null."""
    objects = F.transform(
        F.split(text, " ", -1), lambda w: F.struct(F.nullif(w, F.lit("")).alias(field))
    )
    return F.to_json(objects, {"ignoreNullFields": "false"})


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a ticket; the text is the page with the same number, if any."""
    orders = table(spark, sf_dir, "orders")
    pages = table(spark, sf_dir, "pages")
    rows = orders.join(pages, F.col("o_orderkey") == F.col("page_id"), "left")
    status, priority, day = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    followers = F.transform(F.split(priority, " "), lambda w: F.struct(F.nullif(w, F.lit("1-URGENT")).alias("FullName")))
    mail = F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("@example.com"))
    accountables = F.array(
        F.struct(mail.alias("Email")),
        F.struct(F.when(status != "F", F.lower(status)).alias("Email")),
    )
    unless = lambda value, other: F.when(status != other, value)
    return rows.select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("_airbyte_raw_id"),
        day.alias("_airbyte_extracted_at"),
        F.lit("{}").alias("_airbyte_meta"),
        unless(F.lit(7).cast("bigint"), "O").alias("_airbyte_generation_id"),
        F.col("o_orderkey").alias("ID_"),
        F.col("html").alias("Body"),
        F.concat(F.lit("_7_"), status).alias("Status"),
        F.concat(F.lit("_"), F.replace(priority, F.lit("-"), F.lit("_"))).alias("Priority"),
        F.to_json(followers).alias("Followers"),
        F.to_json(F.struct(F.col("o_custkey").alias("Id"), priority.alias("Description"))).alias("Department"),
        unless(F.lit("2h"), "P").alias("Estimation"),
        F.to_json(F.struct(unless(status, "P").alias("Description"))).alias("TicketType"),
        (status == "F").alias("CanBeClosed"),
        day.alias("changedDate"),
        unless(day, "O").alias("createdDate"),
        F.to_json(accountables).alias("Accountables"),
        unless(day, "P").alias("ExpectedDate"),
        unless(F.col("o_custkey"), "F").alias("Satisfaction"),
        F.col("url").alias("BriefDescription"),
        F.to_json(F.struct(F.col("o_custkey").alias("Id"))).alias("RequesterDepartment"),
        unless(F.lit(True), "P").alias("IsConclusionNotified"),
    )


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a spreadsheet holds them: text only, local notation, empty cells."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        status.alias("status"),
        money(F.col("o_totalprice")).alias("total"),
        F.when(status == "P", "").otherwise(amount_text(F.col("o_totalprice"))).alias("plain_total"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
        F.when(status != "F", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("iso_day"),
        F.when(status == "O", "R$ -").otherwise("").alias("placeholder"),
        F.col("o_orderpriority").alias("priority"),
    )

