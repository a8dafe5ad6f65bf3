from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import strata
from strata.functions.names import check_case_collisions, family, layer_db, resolve_db
from strata.operators.nullfill import CURRENCY_KEYWORDS
from strata.operators.union import common_type


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------- null fill

ALL_TYPES = (
    "t string, i int, l bigint, s smallint, c decimal(10,2), f double, d date, "
    "z timestamp, n timestamp_ntz, b boolean, j array<int>"
)
EMPTY = [tuple([None] * 11)]


def test_plain_fill_by_family(spark):
    filled = strata.null_fill(spark.createDataFrame(EMPTY, ALL_TYPES))
    assert tuple(filled.first()) == ("", 0, 0, 0, Decimal("0.00"), 0.0, None, None, None, None, None)
    assert filled.schema["c"].dataType == T.DecimalType(10, 2)
    assert [f.dataType for f in filled.schema] == [
        f.dataType for f in spark.createDataFrame(EMPTY, ALL_TYPES).schema
    ]


def test_plain_fill_is_idempotent(spark):
    df = spark.createDataFrame([*EMPTY, ("x", 1, 2, 3, Decimal(4), 5.0, None, None, None, True, [1])], ALL_TYPES)
    once = strata.null_fill(df)
    assert rows(strata.null_fill(once)) == rows(once)


def test_dates_become_text(spark):
    at = datetime(2024, 5, 6, 7, 8, 9, 120000)
    df = spark.createDataFrame([(date(2024, 5, 6), at, at), (None, None, None)], "d date, z timestamp, n timestamp_ntz")
    none = "0000-00-00 00:00:00.000"
    filled = strata.null_fill(df.withColumn("z", F.col("n").cast("timestamp")), dates="text")
    assert rows(filled) == sorted(
        [("2024-05-06", "2024-05-06 07:08:09.12+00", "2024-05-06 07:08:09.12"), (none, none, none)],
        key=repr,
    )
    with pytest.raises(ValueError):
        strata.null_fill(df, dates="no")


def test_currency_mark(spark):
    schema = (
        "id bigint, client_name string, Unit_COST decimal(10,2), sale_value string, "
        "big_value double, n_comission int, active boolean, value_date date"
    )
    full = (1, "a", Decimal("1.50"), "9,9", 123456789.0, 3, True, date(2024, 1, 1))
    df = spark.createDataFrame([full, tuple([None] * 8)], schema)
    filled = strata.null_fill(df, dates="text", currency_keywords=CURRENCY_KEYWORDS).collect()
    assert tuple(filled[0]) == (1, "a", "R$ 1.50", "R$ 9,9", "R$ 123456789", "R$ 3", True, "2024-01-01")
    assert tuple(filled[1]) == (0, "", "R$ 0", "R$ ", "R$ 0", "R$ 0", None, "0000-00-00 00:00:00.000")
    plain = strata.null_fill(df, dates="text")
    assert plain.first().sale_value == "9,9"


def test_skip(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    assert tuple(strata.null_fill(df, skip=["b"]).first()) == ("", None)


# ----------------------------------------------------------------- merge


def test_merge_pairs(spark):
    df = spark.createDataFrame(
        [(1, "a", "b", 1), (2, None, "b", 2), (3, "a", None, 3), (4, None, None, 4)],
        "id int, x string, y string, z int",
    )
    merged = strata.merge_pairs(df, [("x", "y", "FAT. X")])
    assert merged.columns == ["id", "z", "FAT. X"]
    assert [r["FAT. X"] for r in merged.orderBy("id").collect()] == ["a", "b", "a", None]


def test_merge_missing_inputs(spark):
    df = spark.createDataFrame([(1, "a")], "id int, x string")
    with pytest.raises(ValueError, match="missing"):
        strata.merge_pairs(df, [("x", "y", "m")])
    loose = strata.merge_pairs(df, [("x", "y", "m"), ("p", "q", "n")], strict=False)
    assert [tuple(r) for r in loose.collect()] == [(1, "a", None)]


def test_merge_types(spark):
    df = spark.createDataFrame([(1, "a", Decimal("1.5"), 2)], "id int, x string, y decimal(9,1), z bigint")
    with pytest.raises(ValueError, match="cannot merge"):
        strata.merge_pairs(df, [("x", "y", "m")])
    assert strata.merge_pairs(df, [("y", "z", "m")]).schema["m"].dataType == T.DecimalType(20, 1)
    with pytest.raises(ValueError, match="collide"):
        strata.merge_pairs(df, [("y", "z", "id")])


# ----------------------------------------------------------------- union


def test_union_by_name(spark):
    one = spark.createDataFrame([(1, "a")], "id int, x string")
    two = spark.createDataFrame([("b", 2)], "y string, id bigint")
    union = strata.union_relations(spark, [("t1", one), ("t2", two)])
    assert union.columns == ["tabela_origem", "id", "y", "x"]
    assert rows(union) == [("t1", 1, None, "a"), ("t2", 2, "b", None)]


def test_union_of_conflicting_types_is_text(spark):
    one = spark.createDataFrame([(1.5,)], "v double")
    two = spark.createDataFrame([("x",)], "v string")
    three = spark.createDataFrame([(None,)], "v bigint")
    union = strata.union_relations(spark, [("a", one), ("b", two), ("c", three), ("a", one)])
    assert rows(union) == [("a", "1,5"), ("a", "1,5"), ("b", "x"), ("c", None)]


def test_union_of_nothing(spark):
    union = strata.union_relations(spark, [])
    assert union.columns == ["tabela_origem"] and union.count() == 0


def test_union_of_many_counts_all_rows(spark):
    parts = [(f"t{i}", spark.range(i).withColumn(f"c{i % 7}", F.lit(i))) for i in range(60)]
    union = strata.union_relations(spark, parts)
    assert union.count() == sum(range(60))
    assert len(union.columns) == 9


def test_union_refuses_names_differing_in_case(spark):
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "A int")
    with pytest.raises(ValueError, match="differ only in case"):
        strata.union_relations(spark, [("x", one), ("y", two)])


def test_common_type():
    i, l, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    dec = T.DecimalType
    assert common_type([i, i]) == i
    assert common_type([i, l]) == l
    assert common_type([i, d]) == d
    assert common_type([l, d]) == s  # a double does not hold 2**53 + 1
    assert common_type([T.DateType(), T.TimestampType()]) == T.TimestampType()
    assert common_type([dec(10, 2), i]) == dec(12, 2)
    assert common_type([dec(38, 0), dec(38, 9)]) == s
    assert common_type([T.DateType(), T.TimestampNTZType()]) == T.TimestampNTZType()
    assert common_type([T.BooleanType(), i]) == s


def test_source_code(spark):
    names = ["mk213_00___BANCO", "MK7x", "none", None, "a mk12 mk13"]
    df = spark.createDataFrame([(n,) for n in names], "tabela_origem string")
    got = [r[0] for r in df.select(strata.source_code(F.col("tabela_origem"))).collect()]
    assert got == ["mk213", "mk7", None, None, "mk12"]
    assert [r.code for r in strata.distinct_codes(df).collect()] == ["mk12", "mk213", "mk7"]


# ----------------------------------------------------------------- names


def test_names():
    assert layer_db("stg", "sheets") == "stg_sheets"
    assert resolve_db("_raw_sheets") == "raw_sheets"
    assert resolve_db("sheets") == "mart_sheets"
    assert strata.q("a`b.c") == "`a``b.c`"
    assert family(T.TimestampNTZType()) == "date" and family(T.BooleanType()) == "other"
    with pytest.raises(ValueError):
        check_case_collisions(["Ab", "aB"])


# ------------------------------------------------------------- reconcile

PAIR = "_airbyte_raw_id string, v string, n int"


def test_reconcile_with_itself(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", None, None)], PAIR)
    for r in strata.reconcile(df, df).collect():
        assert (r.matched, r.changed, r.null_filled, r.missing, r.extra) == (2, 0, 0, 0, 0)


def test_reconcile_counts(spark):
    before = spark.createDataFrame(
        [("same", "x", 1), ("lost", "x", 1), ("changed", "x", 1), ("filled", None, None), ("emptied", "x", 1)],
        PAIR,
    )
    after = spark.createDataFrame(
        [("same", "x", 1), ("new", "x", 1), ("changed", "y", 1), ("filled", "", 0), ("emptied", None, 1)],
        PAIR,
    )
    got = {r.column_name: r for r in strata.reconcile(before, after, table="t").collect()}
    v, n = got["v"], got["n"]
    assert (v.matched, v.changed, v.null_filled, v.missing, v.extra) == (1, 2, 1, 1, 1)
    assert (n.matched, n.changed, n.null_filled, n.missing, n.extra) == (3, 0, 1, 1, 1)


def test_reconcile_repeated_and_null_keys(spark):
    before = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), (None, "x", 1), ("b", "x", 1)], PAIR)
    after = spark.createDataFrame([("a", "x", 1), (None, "x", 1), (None, "y", 1), ("b", "x", 1)], PAIR)
    for r in strata.reconcile(before, after).collect():
        assert (r.matched, r.unpaired_source, r.unpaired_target) == (1, 3, 3)
        assert (r.missing, r.extra) == (0, 0)


def test_reconcile_compares_text_where_types_differ(spark):
    before = spark.createDataFrame([("a", "5", 1), ("b", "x", 2)], PAIR)
    after = before.select("_airbyte_raw_id", F.col("v"), F.col("n").cast("string").alias("n"))
    got = {r.column_name: r.matched for r in strata.reconcile(before, after).collect()}
    assert got == {"v": 2, "n": 2}


def test_reconcile_needs_key_and_columns(spark):
    df = spark.createDataFrame([("a", "x", 1)], PAIR)
    with pytest.raises(ValueError, match="key"):
        strata.reconcile(df, df, key="id")
    with pytest.raises(ValueError, match="no shared column"):
        strata.reconcile(df.select("_airbyte_raw_id", "v"), df.select("_airbyte_raw_id", "n"))
