"""Spreadsheets: copy the source schema, type every table, fill the gaps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from strata.functions.names import layer_db
from strata.operators.layers import copy_layer, run_log, run_log_table, transform_layer
from strata.operators.nullfill import null_fill
from strata.operators.typing_text import type_columns
from strata.session import WRITERS

SUBJECT = "planilhas"


def run(
    spark: SparkSession,
    source_db: str,
    subject: str = SUBJECT,
    run_at: datetime | None = None,
    threads: int = WRITERS,
) -> list[str]:
    """Rebuild the raw, staging and mart layers, each with its run log."""
    raw_db, stg_db, mart_db = [layer_db(layer, subject) for layer in ("raw", "stg", "mart")]
    log = [run_log_table(subject)]
    copy_layer(spark, source_db, raw_db, log, threads)
    run_log(spark, source_db, raw_db, subject, run_at)
    transform_layer(spark, raw_db, stg_db, type_columns, log, threads=threads)
    run_log(spark, raw_db, stg_db, subject, run_at)
    tables = transform_layer(spark, stg_db, mart_db, null_fill, log, threads=threads)
    run_log(spark, stg_db, mart_db, subject, run_at)
    return tables
