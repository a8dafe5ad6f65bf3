"""Null filling directed by the type of each column. One projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.brazil import number_text
from strata.functions.names import check_case_collisions, col, family

# What stands for a missing date, the currency mark, and the parts
# of a column name that call for the mark.
NO_DATE = "0000-00-00 00:00:00.000"
CURRENCY_MARK = "R$ "
CURRENCY_KEYWORDS = ["cost", "comission", "value"]


def null_fill(
    df: DataFrame,
    dates: str = "keep",
    currency_keywords: tuple[str, ...] | list[str] = (),
    skip: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    """Fill NULLs: text with ``''``, numbers with 0; other types are left alone.

    ``dates="text"`` also turns dates and timestamps to text, with a zero date
    for NULL. Columns whose lower-cased name contains a currency keyword become
    text with the currency mark in front. ``skip`` columns stay untouched.
    """
    if dates not in ("keep", "text"):
        raise ValueError(f"dates must be 'keep' or 'text', not {dates!r}")
    check_case_collisions(df.columns)
    return df.select(
        *[
            col(f.name)
            if f.name in skip
            else _filled(f, dates, currency_keywords).alias(f.name)
            for f in df.schema.fields
        ]
    )


def _filled(field: T.StructField, dates: str, keywords) -> Column:
    value, dtype = col(field.name), field.dataType
    kind = family(dtype)
    marked = any(k in field.name.lower() for k in keywords)
    if kind == "text":
        filled = F.coalesce(value, F.lit(""))
        return F.concat(F.lit(CURRENCY_MARK), filled) if marked else filled
    if kind == "number" and marked:
        return F.concat(F.lit(CURRENCY_MARK), F.coalesce(number_text(value, dtype), F.lit("0")))
    if kind == "number":
        return F.coalesce(value, F.lit(0).cast(dtype))
    if kind == "date" and dates == "text":
        return F.coalesce(date_text(value, dtype), F.lit(NO_DATE))
    return value


def date_text(value: Column, dtype: T.DataType) -> Column:
    """Date or timestamp as text; a timestamp with zone keeps its offset (``+00``)."""
    text = value.cast("string")
    if isinstance(dtype, T.TimestampType):
        offset = F.regexp_replace(F.date_format(value, "xxx"), ":00$", "")
        return F.concat(text, offset)
    return text
