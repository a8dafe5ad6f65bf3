"""Tables of a relational database through JDBC, read and written in parallel."""

from __future__ import annotations

import logging
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Rows fetched, or sent, at a time.
BATCH_ROWS = 10_000
# Cells of the histogram for each range that is read.
CELLS = 64


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    partitions: int | None = None,
    properties: dict[str, str] | None = None,
    split: str = "balanced",
) -> DataFrame:
    """Scan a table; with a ``split_column``, in ``partitions`` ranges, as many as the cluster has cores by default.

    ``balanced`` ranges hold about the same number of rows: the database counts its rows in a
    histogram of a numeric column, and the ranges end where the counts add up. ``even`` ranges have the
    same width; dates are always read so. Either way every row is in one range, rows without a
    value in the first. Filters and the choice of columns are handed on to the database by Spark.
    Without a split column one task reads the whole table, which is logged.
    """
    if split not in ("balanced", "even"):
        raise ValueError(f"split is 'balanced' or 'even', not {split!r}")
    options = {"fetchsize": str(BATCH_ROWS), **(properties or {})}
    if split_column is None:
        log.warning("table %s is read by one task; name a split_column", table)
        return spark.read.format("jdbc").options(**options, url=url, dbtable=table).load()
    parts = spark.sparkContext.defaultParallelism if partitions is None else partitions
    bounds = _bounds(spark, options | {"url": url}, table, split_column) if parts > 1 else None
    if bounds is not None and split == "balanced" and all(isinstance(b, (int, float, Decimal)) for b in bounds):
        cells = _histogram(spark, options | {"url": url}, table, split_column, *bounds, cells=CELLS * parts)
        predicates = range_predicates(split_column, balanced_ends(cells, *bounds, cells=CELLS * parts, parts=parts))
        if len(predicates) > 1:
            return spark.read.jdbc(url, table, predicates=predicates, properties=options)
    elif bounds is not None:
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(parts),
        }
    return spark.read.format("jdbc").options(**options, url=url, dbtable=table).load()


def _bounds(spark, options, table, column):
    query = f"SELECT min({column}) AS lo, max({column}) AS hi FROM {table} WHERE {column} IS NOT NULL"
    row = spark.read.format("jdbc").options(**options, query=query).load().first()
    return None if row is None or row[0] is None else (row[0], row[1])


def _histogram(spark, options, table, column, low, high, cells: int) -> dict[int, int]:
    """Rows by cell of the same width, counted by the database; at most ``cells`` + 1 rows come back."""
    cell = f"floor(({column} - ({low})) * {cells}.0 / ({high} - ({low}) + 1))"
    query = f"SELECT {cell} AS cell, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {cell}"
    return {int(r[0]): int(r[1]) for r in spark.read.format("jdbc").options(**options, query=query).load().collect()}


def balanced_ends(counts: dict[int, int], low, high, cells: int, parts: int) -> list:
    """Inner ends of ``parts`` ranges with about the same number of rows, from counts by cell of the same width."""
    total, seen, ends = sum(counts.values()), 0, []
    for cell in range(cells):
        seen += counts.get(cell, 0)
        if len(ends) < parts - 1 and seen < total and seen * parts >= total * (len(ends) + 1):
            while len(ends) < parts - 1 and seen * parts >= total * (len(ends) + 1):
                ends.append(low + (high - low + 1) * (cell + 1) / cells)
    return sorted(set(ends))


def range_predicates(column: str, ends: list) -> list[str]:
    """Conditions that divide the rows at these ends; rows without a value go to the first."""
    if not ends:
        return []
    first = [f"{column} < {ends[0]} OR {column} IS NULL"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(ends, ends[1:], strict=False)]
    return [*first, *inner, f"{column} >= {ends[-1]}"]


def write_relational(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None
) -> None:
    """Replace the rows of a table, keeping its definition."""
    options = {"batchsize": str(BATCH_ROWS), "truncate": "true", **(properties or {}), "url": url}
    df.write.format("jdbc").options(**options, dbtable=table).mode("overwrite").save()
