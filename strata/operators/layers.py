"""Whole-layer operators: table discovery, copies, transforms, and the run log."""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.names import q, qualified
from strata.session import WRITERS, in_parallel

log = logging.getLogger(__name__)

# Marks a view that stands for a table, see ``write_table``.
POINTER = "strata.pointer"
# How long a replaced folder stays for those who still read it.
GRACE_HOURS = 24.0

# The columns of the run log.
RUN_AT, RUN_SOURCE, RUN_TARGET = "execucao_at", "schema_origem", "schema_destino"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> str:
    """Create the database of a layer unless it exists."""
    where = "" if location is None else f" LOCATION '{_quoted(location)}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {q(database)}{where}")
    return database


def list_tables(spark: SparkSession, database: str, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Sorted names of the tables of a database, without the excluded ones.

    Tables are base tables and what ``write_table`` has written; other views are none.
    """
    hidden = {n.lower() for n in exclude}
    shown = spark.sql(f"SHOW TABLE EXTENDED IN {q(database)} LIKE '*'").filter("NOT isTemporary").select("tableName", "information").collect()
    is_table = lambda text: "Type: VIEW" not in text or f"{POINTER}=true" in text
    return sorted(r.tableName for r in shown if is_table(r.information) and r.tableName.lower() not in hidden)


def write_table(df: DataFrame, database: str, table: str, grace_hours: float = GRACE_HOURS) -> str:
    """Replace a table by the rows of ``df``.

    The rows go to a fresh folder of the database, and the table is a pointer to one folder: a
    view of its files, which a single change of metadata moves, whether or not the
    columns change. So there is no moment without the table or with rows of both writes, ``df`` may
    read the table it replaces, and a driver that is killed leaves either the old or the new
    rows, and at most a folder that no table points to.

    Readers that are still at work on the old rows finish: folders that no table points to are
    removed by a later write of the same table, when they are older than ``grace_hours``. Set
    that above the longest read and write. Only a base table of that name which something else has made
    is dropped first, once.
    """
    spark = df.sparkSession
    root = _root(spark, database)
    path = f"{root}/{table.lower()}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _point(spark, database, table, path, table_location(spark, database, table))
    sweep_folders(spark, database, table, grace_hours)
    return table


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _root(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def _point(spark: SparkSession, database: str, table: str, path: str, old: str | None) -> None:
    """Let a table show the rows of a folder."""
    name, rows = qualified(database, table), f"SELECT * FROM parquet.{q(path)}"
    if old is not None and _is_pointer(spark, database, table):
        spark.sql(f"ALTER VIEW {name} AS {rows}")
        return
    if old is not None:
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE VIEW {name} TBLPROPERTIES ('{POINTER}' = 'true') AS {rows}")


def _is_pointer(spark: SparkSession, database: str, table: str) -> bool:
    shown = spark.sql(f"SHOW TBLPROPERTIES {qualified(database, table)}").filter(F.col("key") == POINTER)
    return shown.count() > 0


def sweep_folders(spark: SparkSession, database: str, table: str, grace_hours: float = GRACE_HOURS) -> list[str]:
    """Remove the folders that earlier writes of a table have left, if they are older than the grace period."""
    root, current = _root(spark, database), table_location(spark, database, table)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    oldest = (time.time() - grace_hours * 3600) * 1000
    removed = []
    for status in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder):
        name = status.getPath().getName()
        left = re.fullmatch(re.escape(table.lower()) + "-[0-9a-f]{32}", name) and not (current or "").endswith(f"/{name}")
        if left and status.getModificationTime() <= oldest:
            remove_folder(spark, status.getPath().toString())
            removed.append(name)
    return removed


def table_location(spark: SparkSession, database: str, table: str) -> str | None:
    """The folder of a table; None if there is no such table, or a view of something else."""
    name = qualified(database, table)
    if not spark.catalog.tableExists(name):
        return None
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    shown = re.fullmatch(r"SELECT \* FROM parquet\.`(.*)`", rows.get("View Text", ""), re.DOTALL)
    return shown.group(1).replace("``", "`") if shown else rows.get("Location")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with everything in it, wherever it is stored."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder, from its listing alone."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def transform_layer(
    spark: SparkSession,
    source_db: str,
    target_db: str,
    transform: Callable[[DataFrame], DataFrame],
    exclude: tuple[str, ...] | list[str] = (),
    threads: int = WRITERS,
) -> list[str]:
    """Rebuild every table of one database in another through ``transform``.

    Returns the names of the tables written.
    """
    if source_db.lower() == target_db.lower():
        raise ValueError(f"source and target are both {source_db!r}")
    create_database(spark, target_db)

    def rebuild(table: str) -> str:
        df = transform(spark.table(qualified(source_db, table)))
        write_table(df, target_db, table)
        log.info("%s.%s written to %s", source_db, table, target_db)
        return table

    return in_parallel(spark, rebuild, list_tables(spark, source_db, exclude), threads)


def copy_layer(
    spark: SparkSession,
    source_db: str,
    target_db: str,
    exclude: tuple[str, ...] | list[str] = (),
    threads: int = WRITERS,
) -> list[str]:
    """Copy every table of one database to another, unchanged."""
    return transform_layer(spark, source_db, target_db, lambda df: df, exclude, threads)


def run_log_table(subject: str) -> str:
    return f"{subject}_log_execucao"


def run_log(
    spark: SparkSession,
    source_db: str,
    target_db: str,
    subject: str,
    run_at: datetime | None = None,
) -> DataFrame:
    """Append one row for this run to the log table of the target, and return the log."""
    at = run_at or datetime.now(timezone.utc).replace(tzinfo=None)
    row = spark.range(1, numPartitions=1).select(
        F.lit(at.isoformat(" ")).cast("timestamp_ntz").alias(RUN_AT),
        F.lit(source_db).alias(RUN_SOURCE),
        F.lit(target_db).alias(RUN_TARGET),
    )
    name = qualified(target_db, run_log_table(subject))
    row.write.mode("append").format("parquet").saveAsTable(name)
    return spark.table(name).orderBy(RUN_AT)
