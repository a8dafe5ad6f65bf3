"""Comparison of two layers: which rows and values were kept, lost, added or changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.brazil import number_text
from strata.functions.names import RAW_ID, check_case_collisions, col, family, qualified
from strata.operators.layers import list_tables
from strata.operators.union import union_all

_SOURCE, _TARGET = 1, 2

# How many columns share one mask of NULLs.
_MASK_BITS = 60


def reconcile(
    source: DataFrame, target: DataFrame, key: str = RAW_ID, table: str = ""
) -> DataFrame:
    """Compare two versions of a table row by row, one result row per shared column.

    ``missing`` (``extra``) rows have a key that only the source (target) holds.
    Rows with a key that both hold are ``matched``, ``null_filled`` (NULL in the
    source only) or ``changed`` in each column. Rows whose key is NULL or occurs
    twice on one side cannot be paired; they are counted in ``unpaired_source``
    and ``unpaired_target`` and compared no further.

    Both sides are reduced to fixed-width fingerprints (128 bits a value) before
    the only shuffle, and grouped by key instead of joined: wide text is not
    moved, and a key that fills a large part of a table collapses in the map
    side aggregate. Each side is read once however wide the table is.
    """
    check_case_collisions(source.columns)
    check_case_collisions(target.columns)
    if key not in source.columns or key not in target.columns:
        raise ValueError(f"key {key!r} is missing on one side")
    shared = [n for n in source.columns if n in target.columns and n != key]
    if not shared:
        raise ValueError("no shared column to compare")
    # The expressions of a column are SQL text: built as such, a wide table
    # costs a few calls per column instead of some dozens.
    left = _prints(source, target, key, shared, _SOURCE)
    right = _prints(target, source, key, shared, _TARGET)
    ids = range(len(shared))
    sums = ["sum(in_source) AS ns", "sum(in_target) AS nt"]
    sums += [f"bit_or({s}_nulls{w}) AS {s}_nulls{w}" for s in ("source", "target") for w in _words(shared)]
    sums += [f"bit_xor({p}{i}) AS {p}{i}" for p in "ab" for i in ids]
    keys = left.unionAll(right).groupBy("key").agg(*map(F.expr, sums))
    unpaired = "key IS NULL OR ns > 1 OR nt > 1"
    flags = keys.selectExpr(
        "key IS NOT NULL AND ns = 1 AND nt = 1 AS paired",
        "key IS NOT NULL AND ns = 1 AND nt = 0 AS missing",
        "key IS NOT NULL AND ns = 0 AND nt = 1 AS extra",
        f"IF({unpaired}, ns, 0) AS unpaired_source",
        f"IF({unpaired}, nt, 0) AS unpaired_target",
        *[f"{_equal(i)} AS e{i}" for i in ids],
        *[f"{_null('source', i)} AND NOT {_null('target', i)} AS f{i}" for i in ids],
    )
    counts = [f"count(IF({c}, 1, NULL)) AS {c}" for c in ("paired", "missing", "extra")]
    counts += [f"coalesce(sum({c}), 0) AS {c}" for c in ("unpaired_source", "unpaired_target")]
    counts += [f"count(IF(paired AND {p}{i}, 1, NULL)) AS {p}{i}" for p in "ef" for i in ids]
    rows = ", ".join(
        f"struct({_literal(table)} AS table_name, {_literal(name)} AS column_name, e{i} AS matched, "
        f"paired - e{i} - f{i} AS changed, f{i} AS null_filled, "
        "missing, extra, unpaired_source, unpaired_target)"
        for i, name in enumerate(shared)
    )
    return flags.agg(*map(F.expr, counts)).selectExpr(f"inline(array({rows}))")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _words(names: list[str]) -> range:
    return range((len(names) + _MASK_BITS - 1) // _MASK_BITS)


def _null(side: str, i: int) -> str:
    return f"({side}_nulls{i // _MASK_BITS} & {1 << i % _MASK_BITS}L) <> 0"


def _equal(i: int) -> str:
    # One value on each side: the exclusive or of equal fingerprints is zero.
    return f"a{i} = 0 AND b{i} = 0 AND ({_null('source', i)}) = ({_null('target', i)})"


def _prints(df: DataFrame, other: DataFrame, key: str, names: list[str], side: int) -> DataFrame:
    """Key, side, two fingerprints per column, and bit masks of the columns that are NULL."""
    values = df.select(
        _comparable(df, other, key).alias("key"),
        *[_comparable(df, other, n).alias(f"v{i}") for i, n in enumerate(names)],
    )
    ids = range(len(names))
    nulls = [
        " | ".join(f"IF(v{i} IS NULL, {1 << i % _MASK_BITS}L, 0L)" for i in ids if i // _MASK_BITS == w)
        for w in _words(names)
    ]
    is_source = side == _SOURCE
    return values.selectExpr(
        "key",
        f"{1 if is_source else 0}L AS in_source",
        f"{0 if is_source else 1}L AS in_target",
        *[f"{mask if is_source else '0L'} AS source_nulls{w}" for w, mask in enumerate(nulls)],
        *[f"{'0L' if is_source else mask} AS target_nulls{w}" for w, mask in enumerate(nulls)],
        *[f"xxhash64(v{i}) AS a{i}" for i in ids],
        *[f"xxhash64({i + 1}, v{i}) AS b{i}" for i in ids],
    )


def _comparable(df: DataFrame, other: DataFrame, name: str) -> Column:
    """The value itself, or its text where the two layers hold different types."""
    value, dtype = col(name), df.schema[name].dataType
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if dtype == other.schema[name].dataType:
        return value
    return number_text(value, dtype) if family(dtype) == "number" else value.cast("string")


def differing_rows(source: DataFrame, target: DataFrame, key: str = RAW_ID) -> DataFrame:
    """The differences themselves: ``key, column_name, kind, old_value, new_value``.

    A row for each value that differs between two rows of one key: ``changed``, ``filled`` (NULL
    in the source only) or ``cleared`` (NULL in the target only). A key on one side only gives one row,
    ``missing`` (in the target) or ``extra``; a key that is NULL or stands twice on one side
    gives one row ``unpaired``, as its rows cannot be told apart. Values are text.

    First only keys and 128-bit digests of the rows meet, grouped, so that a hot key collapses in
    the partial aggregate. Whole rows move only for the keys whose digests differ, which are
    unique on both sides.
    """
    check_case_collisions(source.columns)
    check_case_collisions(target.columns)
    if key not in source.columns or key not in target.columns:
        raise ValueError(f"key {key!r} is missing on one side")
    shared = [n for n in source.columns if n in target.columns and n != key]
    if not shared:
        raise ValueError("no shared column to compare")
    sides = _digests(source, target, key, shared, _SOURCE).unionAll(_digests(target, source, key, shared, _TARGET))
    # The exclusive or of the digests of two equal rows is zero.
    keys = sides.groupBy("key").agg(F.sum("in_source").alias("ns"), F.sum("in_target").alias("nt"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    kind = (
        F.when(F.col("key").isNull() | (F.col("ns") > 1) | (F.col("nt") > 1), "unpaired")
        .when(F.col("nt") == 0, "missing").when(F.col("ns") == 0, "extra")
        .when((F.col("a") != 0) | (F.col("b") != 0), "both")
    )
    found = keys.select("key", kind.alias("kind")).filter("kind IS NOT NULL")
    text = F.lit(None).cast("string")
    alone = found.filter("kind <> 'both'").select(
        F.col("key").cast("string").alias("key"), text.alias("column_name"), "kind", text.alias("old_value"), text.alias("new_value")
    )
    wanted = found.filter("kind = 'both'").select("key")
    old, new = (_values(a, b, key, shared, wanted) for a, b in ((source, target), (target, source)))
    pairs = old.join(new.withColumnRenamed("row", "new"), "key").select(
        F.col("key").cast("string").alias("key"),
        F.posexplode(F.arrays_zip(F.col("row").alias("old_value"), F.col("new").alias("new_value"))).alias("at", "both"),
    )
    names = F.array(*[F.lit(n) for n in shared])
    changed = pairs.select("key", F.get(names, F.col("at")).alias("column_name"), "both.*").filter(
        ~F.col("old_value").eqNullSafe(F.col("new_value"))
    )
    kinds = F.when(F.col("old_value").isNull(), "filled").when(F.col("new_value").isNull(), "cleared").otherwise("changed")
    return changed.select("key", "column_name", kinds.alias("kind"), "old_value", "new_value").unionAll(alone)


def _digests(df: DataFrame, other: DataFrame, key: str, names: list[str], side: int) -> DataFrame:
    values = [_comparable(df, other, n) for n in names]
    parts = [x for v in values for x in (v.isNull(), v)]  # a hash leaves NULLs out
    return df.select(
        _comparable(df, other, key).alias("key"), F.lit(int(side == _SOURCE)).cast("bigint").alias("in_source"),
        F.lit(int(side == _TARGET)).cast("bigint").alias("in_target"), F.xxhash64(*parts).alias("a"),
        F.xxhash64(F.lit(1), *parts).alias("b"),
    )


def _values(df: DataFrame, other: DataFrame, key: str, names: list[str], wanted: DataFrame) -> DataFrame:
    """Key and all values as text, of the wanted keys."""

    def shown(name: str) -> Column:
        dtype = df.schema[name].dataType
        if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(col(name))
        return number_text(col(name), dtype) if family(dtype) == "number" else col(name).cast("string")

    rows = df.select(_comparable(df, other, key).alias("key"), F.array(*[shown(n) for n in names]).alias("row"))
    return rows.join(wanted, "key", "left_semi")


def reconcile_layers(
    spark: SparkSession,
    source_db: str,
    target_db: str,
    key: str = RAW_ID,
    exclude: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    """``reconcile`` for every table of two databases.

    A table that only one of them holds has a row for each column, with all its rows
    ``missing`` or ``extra``. The rows of a table without the key, such as a run log, are
    ``unpaired``. No table in common is an error.
    """
    tables = {db: list_tables(spark, db, exclude) for db in (source_db, target_db)}
    read = lambda db, t: spark.table(qualified(db, t)) if t in tables[db] else None
    parts, compared = [], 0
    for name in sorted({*tables[source_db], *tables[target_db]}):
        source, target = read(source_db, name), read(target_db, name)
        sides = [df for df in (source, target) if df is not None]
        others = [n for n in sides[0].columns if n != key and all(n in df.columns for df in sides)]
        if len(sides) == 2 and others and all(key in df.columns for df in sides):
            parts.append(reconcile(source, target, key, name))
            compared += 1
        else:
            parts.append(_uncompared(source, target, name))
    if not compared:
        raise ValueError(f"{source_db!r} and {target_db!r} have no table in common with {key!r}")
    return union_all(parts)


def _uncompared(source: DataFrame | None, target: DataFrame | None, table: str) -> DataFrame:
    """The rows of ``reconcile`` for a table of one layer only, or without a key: its rows are counted, not compared."""
    count = lambda df: F.lit(0).cast("bigint").alias("n") if df is None else F.count(F.lit(1)).alias("n")
    one_sided = source is None or target is None
    counts = [df.agg(count(df)).withColumn("side", F.lit(side)) for side, df in ((_SOURCE, source), (_TARGET, target)) if df is not None]
    of = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0)).cast("bigint")
    names = dict.fromkeys(n for df in (source, target) if df is not None for n in df.columns)
    none = F.lit(0).cast("bigint")
    sums = union_all(counts).agg(of(_SOURCE).alias("ns"), of(_TARGET).alias("nt"))
    rows = sums.select("*", F.explode(F.array(*[F.lit(n) for n in names])).alias("column_name"))
    part = lambda n, here: (F.col(n) if here else none)
    return rows.select(
        F.lit(table).alias("table_name"), "column_name", none.alias("matched"), none.alias("changed"), none.alias("null_filled"),
        part("ns", one_sided).alias("missing"), part("nt", one_sided).alias("extra"),
        part("ns", not one_sided).alias("unpaired_source"), part("nt", not one_sided).alias("unpaired_target"),
    )
