"""Column, table and layer names, and the type families the null rules use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every column the landing step adds starts with this prefix.
TECHNICAL_PREFIX = "_airbyte"
RAW_ID = "_airbyte_raw_id"
EXTRACTED_AT = "_airbyte_extracted_at"
META = "_airbyte_meta"
GENERATION_ID = "_airbyte_generation_id"
TECHNICAL_COLUMNS = [RAW_ID, EXTRACTED_AT, META, GENERATION_ID]


def q(name: str) -> str:
    """Back-quote a column or table name, so dots and blanks are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by its exact name, dots and blanks included."""
    return F.col(q(name))


def qualified(database: str, table: str) -> str:
    return f"{q(database)}.{q(table)}"


def layer_db(layer: str, subject: str) -> str:
    """Database of a subject in a layer: ``layer_db("stg", "sheets") == "stg_sheets"``."""
    return f"{layer}_{subject}"


def resolve_db(schema: str, target: str = "mart") -> str:
    """Resolve a configured schema name.

    A leading underscore means "take the rest literally"; any other name gets
    the target as a prefix.
    """
    return schema[1:] if schema.startswith("_") else f"{target}_{schema}"


def is_technical(name: str) -> bool:
    return name.startswith(TECHNICAL_PREFIX)


def split_technical(names: list[str]) -> tuple[list[str], list[str]]:
    """Split names into (technical, business), each in its original order."""
    technical = [n for n in names if is_technical(n)]
    business = [n for n in names if not is_technical(n)]
    return technical, business


def check_case_collisions(names: list[str]) -> None:
    """Raise when two names differ only in case, which Spark cannot tell apart."""
    seen: dict[str, str] = {}
    for name in names:
        other = seen.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"columns {other!r} and {name!r} differ only in case")


def family(dtype: T.DataType) -> str:
    """Type family: ``text``, ``number``, ``date`` or ``other``."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "other"
