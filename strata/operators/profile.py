"""Profile of the tables of a layer: rows, columns, bytes, first seen."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.names import qualified
from strata.operators.layers import folder_bytes, list_tables, table_location
from strata.operators.union import union_all
from strata.session import in_parallel

log = logging.getLogger(__name__)


def profile_layer(
    spark: SparkSession,
    database: str,
    tables: list[str] | None = None,
    profiled_at: datetime | None = None,
) -> DataFrame:
    """One row per table: ``table_name, row_count, column_count, size_in_bytes, profiled_at``.

    All tables are counted by one job, which reads no data column. The size is that
    of all files below the folder of the table, whatever their format; it is NULL for
    tables without a folder. Missing tables are skipped with a warning; nothing to
    profile at all is an error.
    """
    found = list_tables(spark, database) if tables is None else []
    for table in tables or []:
        if spark.catalog.tableExists(qualified(database, table)):
            found.append(table)
        else:
            log.warning("no table %s in %s, skipped", table, database)
    if not found:
        raise ValueError(f"no table to profile in {database!r}")
    at = profiled_at or datetime.now(timezone.utc).replace(tzinfo=None)

    def one(table: str) -> DataFrame:
        folder = table_location(spark, database, table)
        size = None if folder is None else folder_bytes(spark, folder)
        return profile_table(spark.table(qualified(database, table)), table, at, size)

    return union_all(in_parallel(spark, one, found))


def profile_table(df: DataFrame, table: str, profiled_at: datetime, size: int | None = None) -> DataFrame:
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.lit(size).cast("bigint").alias("size_in_bytes"),
        F.lit(profiled_at.isoformat(" ")).cast("timestamp_ntz").alias("profiled_at"),
    )


def record_profile(
    spark: SparkSession,
    database: str,
    history_db: str,
    history_table: str = "layer_profile",
    tables: list[str] | None = None,
    profiled_at: datetime | None = None,
) -> DataFrame:
    """Append a profile to a history table and return the latest profile of each table."""
    profile = profile_layer(spark, database, tables, profiled_at)
    name = qualified(history_db, history_table)
    profile.withColumn("database", F.lit(database)).coalesce(1).write.mode("append").format(
        "parquet"
    ).saveAsTable(name)
    return latest_profile(spark.table(name))


def latest_profile(history: DataFrame) -> DataFrame:
    """Newest profile of each table, with the time the table was first seen."""
    measures = F.struct("row_count", "column_count", "size_in_bytes", "profiled_at")
    return (
        history.groupBy("database", "table_name")
        .agg(
            F.max_by(measures, "profiled_at").alias("latest"),
            F.min("profiled_at").alias("first_seen"),
        )
        .select("database", "table_name", "latest.*", "first_seen")
    )
