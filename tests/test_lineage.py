"""Columns followed through plans, inventories of layers, and the differences between rows."""

import uuid

import pytest
from pyspark.sql import functions as F

import strata
from strata.operators.lineage import Origin


@pytest.fixture
def layers(spark):
    name = uuid.uuid4().hex[:8]
    before, after = (strata.create_database(spark, f"{side}_{name}") for side in ("before", "after"))
    strata.write_table(spark.createDataFrame([(1, "x", None, 2.5), (2, None, "y", 0.5)], "id long, a string, b string, `n.` double"), before, "one")
    strata.write_table(spark.createDataFrame([(1,)], "k long"), before, "alone")
    return before, after


def test_columns_are_followed_through_a_plan(spark, layers):
    before, _ = layers
    one, alone = spark.table(f"{before}.one"), spark.table(f"{before}.alone")
    o = lambda c, t="one": Origin(before, t, c)
    plan = one.filter("id > 0").join(alone, one.id == alone.k).groupBy("a").agg(F.sum("`n.`").alias("total"), F.max("k").alias("last"))
    assert strata.trace_columns(plan) == {"a": [o("a")], "total": [o("n.")], "last": [o("k", "alone")]}
    merged = strata.merge_pairs(one, [("a", "b", "c")])
    both = merged.select("id", "c").unionByName(one.select("id", F.lit("z").alias("c")))
    assert strata.trace_columns(both) == {"id": [o("id")], "c": [o("a"), o("b")]}
    parts = one.select("id", F.explode(F.split("a", " ")).alias("word"), F.lit(1).alias("one"))
    assert strata.trace_columns(parts) == {"id": [o("id")], "word": [o("a")], "one": []}
    python = one.select("id", "a").mapInArrow(lambda batches: batches, "x long, y string")
    assert strata.trace_columns(python) == {"x": [o("a"), o("id")], "y": [o("a"), o("id")]}
    assert strata.trace_columns(strata.type_columns(one, force_numeric=["a"]))["a"] == [o("a")]


def test_layer_lineage(spark, layers):
    before, after = layers
    plan = strata.merge_pairs(spark.table(f"{before}.one"), [("a", "b", "c.d")]).withColumnRenamed("id", "key")
    strata.write_table(plan, after, "one")
    strata.write_table(spark.createDataFrame([(1,)], "z long"), after, "new")
    rows = strata.layer_lineage(spark, before, after, {"ONE": plan}, counts=True).collect()
    got = {(r.source_table, r.source_column, r.target_table, r.target_column): (r.relation, r.source_filled, r.target_filled) for r in rows}
    assert got == {
        ("one", "id", "one", "key"): ("renamed", 2, 2), ("one", "a", "one", "c.d"): ("merged", 1, 2),
        ("one", "b", "one", "c.d"): ("merged", 1, 2), ("one", "n.", "one", "n."): ("same", 2, 2),
        ("alone", "k", None, None): ("source_only", 1, None), (None, None, "new", "z"): ("target_only", None, 1),
    }
    by_name = {(r.source_column, r.target_column, r.relation) for r in strata.layer_lineage(spark, before, after).collect()}
    assert ("n.", "n.", "same") in by_name and ("id", None, "source_only") in by_name and (None, "key", "target_only") in by_name
    empty = strata.create_database(spark, f"empty_{uuid.uuid4().hex[:8]}")
    assert {r.relation for r in strata.layer_lineage(spark, before, empty, counts=True).collect()} == {"source_only"}


def test_reconcile_shows_tables_of_one_layer_and_tables_without_a_key(spark, layers):
    before, after = layers
    strata.write_table(spark.table(f"{before}.one"), after, "one")
    strata.write_table(spark.createDataFrame([(1,), (2,)], "z long"), after, "new")
    for db in layers:
        strata.write_table(spark.createDataFrame([("run",)], "at string"), db, "log")
    rows = strata.reconcile_layers(spark, before, after, key="id").collect()
    got = {(r.table_name, r.column_name): (r.matched, r.missing, r.extra, r.unpaired_source, r.unpaired_target) for r in rows}
    assert got["one", "a"] == (2, 0, 0, 0, 0)
    assert got["alone", "k"] == (0, 1, 0, 0, 0) and got["new", "z"] == (0, 0, 2, 0, 0) and got["log", "at"] == (0, 0, 0, 1, 1)


def test_differing_rows(spark):
    schema = "id long, a string, n double, l array<int>"
    old = [(1, "x", 1.0, [1]), (2, None, 2.0, None), (3, "c", None, [3]), (4, "gone", 0.0, []), (5, "p", 0.0, []), (5, "p", 0.0, []), (None, "n", 0.0, []), (7, None, 0.5, [7])]
    new = [(1, "x", 1.5, [1, 2]), (2, "b", 2.0, None), (3, None, None, [3]), (6, "new", 0.0, []), (5, "p", 0.0, []), (7, None, 0.5, [7])]
    got = strata.differing_rows(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).drop("x"), "id")
    assert got.columns == ["key", "column_name", "kind", "old_value", "new_value"]
    assert {tuple(r) for r in got.collect()} == {
        ("1", "n", "changed", "1", "1.5"), ("1", "l", "changed", "[1]", "[1,2]"), ("2", "a", "filled", None, "b"),
        ("3", "a", "cleared", "c", None), ("4", None, "missing", None, None), ("6", None, "extra", None, None),
        ("5", None, "unpaired", None, None), (None, None, "unpaired", None, None),
    }
    same = spark.createDataFrame(old[:4], schema)
    assert strata.differing_rows(same, same, "id").count() == 0
    swapped = strata.differing_rows(spark.createDataFrame([(1, None, "v")], "id long, a string, b string"), spark.createDataFrame([(1, "v", None)], "id long, a string, b string"), "id")
    assert {(r.column_name, r.kind) for r in swapped.collect()} == {("a", "filled"), ("b", "cleared")}
    typed = strata.differing_rows(spark.createDataFrame([(1, "2")], "id long, n string"), spark.createDataFrame([(1, 2.0)], "id long, n double"), "id")
    assert typed.count() == 0
    with pytest.raises(ValueError, match="missing on one side"):
        strata.differing_rows(same, same.drop("id"), "id")
