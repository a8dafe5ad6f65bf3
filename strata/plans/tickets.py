"""Tickets: clean the text, pull fields out of JSON, then fill the gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from strata.functions.jsonx import json_array_join, json_field
from strata.functions.names import TECHNICAL_COLUMNS, col, layer_db, qualified
from strata.functions.text import strip_enum_prefix, strip_html
from strata.operators.layers import create_database, write_table
from strata.operators.nullfill import null_fill

# The columns of a ticket, in order, and how each is treated.
COLUMNS = [
    "ID_", "Body", "Status", "Priority", "Followers", "Department", "Estimation",
    "TicketType", "CanBeClosed", "changedDate", "createdDate", "Accountables",
    "ExpectedDate", "Satisfaction", "BriefDescription", "RequesterDepartment",
    "IsConclusionNotified",
]
HTML = ["Body"]
ENUMS = ["Status", "Priority"]
JSON_LISTS = {"Followers": "FullName", "Accountables": "Email"}
JSON_OBJECTS = {
    "Department": "Description",
    "TicketType": "Description",
    "RequesterDepartment": "Description",
}
UNFILLED = [
    "_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_meta",
    "CanBeClosed", "changedDate", "createdDate", "ExpectedDate", "IsConclusionNotified",
]

TABLE = "fct_tickets"


def staging(raw: DataFrame) -> DataFrame:
    """Cleaned tickets, one projection over the raw table."""
    types = {f.name: f.dataType for f in raw.schema.fields}

    def clean(name: str) -> Column:
        value = col(name)
        if name in HTML:
            return strip_html(value)
        if name in ENUMS:
            return strip_enum_prefix(value)
        if name in JSON_LISTS:
            return json_array_join(value, JSON_LISTS[name], dtype=types[name])
        if name in JSON_OBJECTS:
            return json_field(value, JSON_OBJECTS[name], types[name])
        return value

    return raw.select(*[clean(n).alias(n) for n in TECHNICAL_COLUMNS + COLUMNS])


def mart(stg: DataFrame) -> DataFrame:
    """Tickets without gaps; dates, flags and the load columns keep their NULLs."""
    return null_fill(stg, skip=UNFILLED)


def run(
    spark: SparkSession,
    raw_table: str,
    subject: str = "tickets",
    table: str = TABLE,
) -> DataFrame:
    """Rebuild the staging and mart tables from a raw table given as ``database.table``."""
    raw = spark.table(raw_table)
    stg_db = create_database(spark, layer_db("stg", subject))
    mart_db = create_database(spark, layer_db("mart", subject))
    write_table(staging(raw), stg_db, table)
    write_table(mart(spark.table(qualified(stg_db, table))), mart_db, table)
    return spark.table(qualified(mart_db, table))
