"""Full-refresh landing of a source table in the raw layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.names import EXTRACTED_AT, GENERATION_ID, META, RAW_ID, check_case_collisions, col
from strata.operators.layers import create_database, write_table

# Fixed value: the change record of a row that arrived intact.
NO_CHANGES = '{"changes":[]}'


def with_technical_columns(
    df: DataFrame, generation_id: int = 0, extracted_at: datetime | None = None
) -> DataFrame:
    """Put the row id, load time, change record and load number in front."""
    at = F.current_timestamp() if extracted_at is None else F.lit(extracted_at).cast("timestamp")
    return df.select(
        F.uuid().alias(RAW_ID),
        at.alias(EXTRACTED_AT),
        F.lit(NO_CHANGES).alias(META),
        F.lit(generation_id).cast("bigint").alias(GENERATION_ID),
        *[col(n) for n in df.columns],
    )


def land(
    df: DataFrame,
    database: str,
    table: str,
    generation_id: int = 0,
    extracted_at: datetime | None = None,
) -> str:
    """Empty and reload a raw table from ``df``. Row ids are new on every load."""
    check_case_collisions(df.columns)
    create_database(df.sparkSession, database)
    return write_table(with_technical_columns(df, generation_id, extracted_at), database, table)
