"""Which tables and columns of two layers correspond, without any row key.

Tables correspond by name and columns by name, as a catalog would match them. Where the plan of a
target table is given, its columns are followed through the analysed plan instead, so that
renamed and merged columns are found too. Everything is metadata: a row for each column.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.names import col, qualified
from strata.operators.layers import POINTER, list_tables
from strata.operators.union import union_all
from strata.session import literal_rows


class Origin(NamedTuple):
    """A column of a catalog table."""

    database: str
    table: str
    column: str


def trace_columns(df: DataFrame) -> dict[str, list[Origin]]:
    """For each column of ``df`` the columns of catalog tables whose values it is made of, sorted.

    Read from the analysed plan: nothing is computed. Conditions of filters and joins are no
    origin. A column made in Python code has all columns that enter that code.
    """
    plan = df._jdf.queryExecution().analyzed()
    origins: dict[int, set[Origin]] = {}
    _follow(plan, origins)
    return {a.name(): sorted(origins.get(a.exprId().id(), ())) for a in _items(plan.output())}


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _references(expression) -> list[int]:
    return [a.exprId().id() for a in _items(expression.references().toSeq())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _follow(plan, origins: dict[int, set[Origin]]) -> None:
    """Note the origins of every attribute that a plan makes, from its leaves up."""
    children = _items(plan.children())
    for child in children:
        _follow(child, origins)
    of = lambda ids: set().union(*[origins.get(i, set()) for i in ids])
    output = _items(plan.output())
    if not children:
        table = plan.catalogTable() if _kind(plan) == "LogicalRelation" else None
        if table is not None and table.isDefined():
            name = table.get().identifier()
            database = name.database().get() if name.database().isDefined() else ""
            origins.update({a.exprId().id(): {Origin(database, name.table(), a.name())} for a in output})
        return
    if _kind(plan) == "View" and plan.desc().properties().contains(POINTER):  # a table that was written by write_table
        name = plan.desc().identifier()
        origins.update({a.exprId().id(): {Origin(name.database().get(), name.table(), a.name())} for a in output})
        return
    if _kind(plan) == "Union":
        sides = [[a.exprId().id() for a in _items(c.output())] for c in children]
        origins.update({a.exprId().id(): of([side[i] for side in sides]) for i, a in enumerate(output)})
        return
    if _kind(plan) == "Generate":
        made = of(_references(plan.generator()))
        origins.update({a.exprId().id(): made for a in _items(plan.generatorOutput())})
    if _kind(plan) == "Expand":
        rows = [_items(p) for p in _items(plan.projections())]
        origins.update({a.exprId().id(): of([r for row in rows for r in _references(row[i])]) for i, a in enumerate(output)})
    for expression in _items(plan.expressions()):
        if _kind(expression) == "Alias":
            origins[expression.exprId().id()] = of(_references(expression))
    unknown = [a.exprId().id() for a in output if a.exprId().id() not in origins]
    if unknown and "Map" in _kind(plan):
        everything = of([a.exprId().id() for c in children for a in _items(c.output())])
        origins.update(dict.fromkeys(unknown, everything))


def layer_inventory(
    spark: SparkSession, database: str, exclude: tuple[str, ...] | list[str] = (), counts: bool = False
) -> DataFrame:
    """``table_name, column_name, position, data_type`` of all base tables; with ``counts`` also ``n_rows`` and ``n_filled``.

    Counting reads every column once; without it nothing but the catalog is read.
    """
    schema = "table_name string, column_name string, position int, data_type string"
    tables = [(t, spark.table(qualified(database, t))) for t in list_tables(spark, database, exclude)]
    rows = [(t, f.name, i, f.dataType.simpleString()) for t, df in tables for i, f in enumerate(df.schema.fields)]
    inventory = literal_rows(spark, rows, schema)
    if not counts:
        return inventory
    if not rows:
        return inventory.withColumns({c: F.lit(None).cast("bigint") for c in ("n_rows", "n_filled")})
    filled = []
    for name, df in tables:
        sums = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
        each = [F.struct(F.lit(i).alias("position"), F.col(f"c{i}").alias("n_filled")) for i in range(len(df.columns))]
        one = sums.select(F.col("n").alias("n_rows"), F.explode(F.array(*each)).alias("x"))
        filled.append(one.select(F.lit(name).alias("table_name"), "x.position", "n_rows", "x.n_filled"))
    return inventory.join(union_all(filled), ["table_name", "position"]).select(*inventory.columns, "n_rows", "n_filled")


def layer_lineage(
    spark: SparkSession,
    source_db: str,
    target_db: str,
    plans: dict[str, DataFrame] | None = None,
    exclude: tuple[str, ...] | list[str] = (),
    counts: bool = False,
) -> DataFrame:
    """One row for each pair of columns that correspond, and for each column that has no counterpart.

    ``source_table, source_column, source_type, target_table, target_column, target_type, relation``;
    ``relation`` is ``same``, ``renamed``, ``merged`` (of several columns), ``source_only`` or
    ``target_only``. ``plans`` gives the DataFrames that target tables are written from; their columns
    are traced to the source tables they read. Other tables correspond by name, column by
    column. A table that only one layer holds shows with all its columns. With ``counts`` the
    filled values on both sides are added, which reads the tables.
    """
    source = layer_inventory(spark, source_db, exclude, counts).drop("position")
    target = layer_inventory(spark, target_db, exclude, counts).drop("position")
    side = lambda df, name: df.toDF(
        *[f"{name}_{c}" for c in ("table", "column", "type", *(("rows", "filled") if counts else ()))]
    )
    source, target = side(source, "source"), side(target, "target")
    traced = {t.lower(): trace_columns(df) for t, df in (plans or {}).items()}
    links = [
        (o.table, o.column, t, c, "merged" if len(origins) > 1 else "same" if o.column == c else "renamed")
        for t, columns in traced.items()
        for c, found in columns.items()
        for origins in [[o for o in found if o.database.lower() == source_db.lower()]]
        for o in origins
    ]
    pair = "source_table string, source_column string, target_table string, target_column string, relation string"
    by_plan = literal_rows(spark, links, pair)
    same = source.select("source_table", "source_column").join(
        target.filter(~F.lower("target_table").isin(*traced)) if traced else target,
        (F.col("source_table") == F.col("target_table")) & (F.col("source_column") == F.col("target_column")),
    )
    by_name = same.select("source_table", "source_column", "target_table", "target_column", F.lit("same").alias("relation"))
    known = by_plan.unionAll(by_name)
    rows = source.join(known, ["source_table", "source_column"], "full").join(target, ["target_table", "target_column"], "full")
    relation = F.coalesce("relation", F.when(F.col("source_table").isNull(), "target_only").otherwise("source_only"))
    extra = ["source_rows", "source_filled", "target_rows", "target_filled"] if counts else []
    return rows.select(
        "source_table", "source_column", "source_type", "target_table", "target_column", "target_type",
        relation.alias("relation"), *extra,
    )
