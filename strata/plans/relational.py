"""Finance and customer relations: typed raw tables straight to the mart layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from strata.functions.names import layer_db
from strata.operators.layers import run_log, run_log_table, transform_layer
from strata.operators.nullfill import CURRENCY_KEYWORDS, null_fill
from strata.session import WRITERS


def finance_mart(raw: DataFrame) -> DataFrame:
    """No gaps, dates as text."""
    return null_fill(raw, dates="text")


def crm_mart(raw: DataFrame, currency_keywords: list[str] | None = None) -> DataFrame:
    """No gaps, dates as text, and a currency mark on columns named after money."""
    words = CURRENCY_KEYWORDS if currency_keywords is None else currency_keywords
    return null_fill(raw, dates="text", currency_keywords=words)


def run_finance(
    spark: SparkSession,
    raw_db: str,
    subject: str = "finance",
    run_at: datetime | None = None,
    threads: int = WRITERS,
) -> list[str]:
    """Rebuild every finance table in the mart layer, and log the run."""
    return _run(spark, raw_db, subject, finance_mart, run_at, threads)


def run_crm(
    spark: SparkSession,
    raw_db: str,
    subject: str = "crm",
    run_at: datetime | None = None,
    threads: int = WRITERS,
) -> list[str]:
    """Rebuild every customer relations table in the mart layer, and log the run."""
    return _run(spark, raw_db, subject, crm_mart, run_at, threads)


def _run(spark, raw_db, subject, transform, run_at, threads) -> list[str]:
    target, log = layer_db("mart", subject), [run_log_table(subject)]
    tables = transform_layer(spark, raw_db, target, transform, log, threads)
    run_log(spark, raw_db, target, subject, run_at)
    return tables
