"""Union of same-purpose tables whose columns differ, with provenance."""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.brazil import number_text
from strata.functions.names import check_case_collisions, col, family, q, qualified
from strata.operators.layers import list_tables

log = logging.getLogger(__name__)

# The provenance column, the code column, and the form of a code.
SOURCE_COLUMN = "tabela_origem"
CODE_COLUMN = "codigo_cronograma"
CODE_PATTERN = "(?i)mk[0-9]+"

_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_INTEGER_DIGITS = [3, 5, 10, 19]


def source_code(source: Column) -> Column:
    """Code of a source table name, lower-cased; NULL when it holds none."""
    return F.lower(F.regexp_substr(source, F.lit(CODE_PATTERN)))


def discover_codes(spark: SparkSession, database: str, patterns: list[str]) -> list[str]:
    """Distinct codes, sorted, of the tables whose name matches one of the patterns.

    Patterns are case-insensitive; ``%`` and ``_`` are wildcards. Names without
    a code are dropped. The work is on the table list only.
    """
    shapes = [
        re.compile(re.escape(p).replace("%", ".*").replace("_", "."), re.IGNORECASE | re.DOTALL)
        for p in patterns
    ]
    names = list_tables(spark, database)
    codes = [re.search(CODE_PATTERN, n) for n in names if any(s.fullmatch(n) for s in shapes)]
    return sorted({code.group().lower() for code in codes if code})


def distinct_codes(df: DataFrame, source_column: str = SOURCE_COLUMN) -> DataFrame:
    """Distinct codes found in a column of source names, sorted."""
    codes = df.select(source_code(col(source_column)).alias("code"))
    return codes.filter(F.col("code").isNotNull()).distinct().orderBy("code")


def find_relations(
    spark: SparkSession, database: str, codes: list[str], suffix: str
) -> list[tuple[str, DataFrame]]:
    """Tables ``<code><suffix>`` that exist, in the order of the codes.

    Only the part of a code before its first underscore counts, in lower case.
    """
    found = []
    for code in codes:
        table = code.split("_")[0].lower() + suffix
        if spark.catalog.tableExists(qualified(database, table)):
            found.append((table, spark.table(qualified(database, table))))
        else:
            log.warning("no table %s in %s, skipped", table, database)
    return found


def union_relations(
    spark: SparkSession,
    relations: list[tuple[str, DataFrame]],
    source_column: str = SOURCE_COLUMN,
) -> DataFrame:
    """Union all relations by column name, with the relation name in ``source_column``.

    A column that a relation lacks is NULL there. Columns are ordered by their
    smallest position in any relation, then by name. Types are widened; types that no
    common one holds exactly (64-bit whole numbers and floating point, numbers and text)
    become text. Numbers that become text get a decimal comma, so that
    typing reads ``1,234`` back as it was, not as a thousand; ``union_typed`` keeps such columns
    numeric. No relation at all gives an empty result that has the source column only.
    """
    if not relations:
        return spark.createDataFrame([], T.StructType([T.StructField(source_column, T.StringType())]))
    target = merged_schema([df.schema for _, df in relations])
    check_case_collisions([source_column, *target.names])
    parts = [
        df.select(F.lit(name).alias(source_column), *[_aligned(df, f) for f in target.fields])
        for name, df in relations
    ]
    return union_all(parts)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union by position, pairwise, so that the plan of many parts stays shallow."""
    while len(parts) > 1:
        parts = [
            parts[i].unionAll(parts[i + 1]) if i + 1 < len(parts) else parts[i]
            for i in range(0, len(parts), 2)
        ]
    return parts[0]


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """Columns of all schemas, ordered by smallest position then name, with common types."""
    position: dict[str, int] = {}
    types: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for i, f in enumerate(schema.fields):
            position[f.name] = min(i, position.get(f.name, i))
            types.setdefault(f.name, []).append(f.dataType)
    names = sorted(position, key=lambda n: (position[n], n))
    return T.StructType([T.StructField(n, common_type(types[n])) for n in names])


def common_type(types: list[T.DataType]) -> T.DataType:
    """Type that holds the values of all types exactly; text when there is none.

    Text holds every number with all its digits.
    """
    distinct = [t for i, t in enumerate(types) if t not in types[:i]]
    if len(distinct) == 1:
        return distinct[0]
    if all(t in _INTEGERS for t in distinct):
        return max(distinct, key=_INTEGERS.index)
    if all(isinstance(t, T.DecimalType) or t in _INTEGERS for t in distinct):
        return _common_decimal(distinct) or T.StringType()
    if all(isinstance(t, (T.FloatType, T.DoubleType)) or t in _INTEGERS[:3] for t in distinct):
        return T.DoubleType()  # holds 32-bit whole numbers exactly, not 64-bit ones
    if all(isinstance(t, (T.DateType, T.TimestampNTZType)) for t in distinct):
        return T.TimestampNTZType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in distinct):
        return T.TimestampType()
    return T.StringType()


def decimal_digits(dtype: T.DataType) -> tuple[int, int]:
    """Digits before and after the decimal point of a decimal or whole number type."""
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale, dtype.scale
    return _INTEGER_DIGITS[_INTEGERS.index(dtype)], 0


def _common_decimal(types: list[T.DataType]) -> T.DecimalType | None:
    digits = [decimal_digits(t) for t in types]
    whole, scale = max(d[0] for d in digits), max(d[1] for d in digits)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _aligned(df: DataFrame, target: T.StructField) -> Column:
    if target.name not in df.columns:
        return F.lit(None).cast(target.dataType).alias(target.name)
    value, dtype = F.col(q(target.name)), df.schema[target.name].dataType
    if dtype == target.dataType:
        return value
    if isinstance(target.dataType, T.StringType):
        if family(dtype) == "number":
            return F.translate(number_text(value, dtype), ".", ",").alias(target.name)
        if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(value).alias(target.name)
    return value.cast(target.dataType).alias(target.name)
