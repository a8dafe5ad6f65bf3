"""The physical plans: what shuffles, what is read, and that no Python runs in them."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
import strata
from strata.plans import tickets
from workload import inputs, scalar, tables

SF_DIR = "/root/testdata/sf0.001"

ONE_PASS = [
    "html_strip", "enum_prefix", "json_field", "json_array_join", "date_parse", "source_code",
    "union_relations", "merge_pairs", "null_fill_plain", "null_fill_dates", "null_fill_currency",
]


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def whole_files(spark, monkeypatch):
    """Inputs as a large table has them: enough partitions, nothing to spread."""
    for module in (inputs, scalar, tables):
        monkeypatch.setattr(module, "table", inputs.table, raising=False)


@pytest.mark.parametrize("name", ONE_PASS)
def test_column_operators_do_not_shuffle(spark, whole_files, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "Exchange" not in text


@pytest.mark.parametrize("name", sorted({**scalar.QUERIES, **tables.QUERIES}))
def test_no_python_in_any_plan(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark, whole_files):
    text = plan(contract.queries()["enum_prefix"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text
    raw = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    report = strata.infer_types(raw.withColumn("note", F.lit("x")), ["o_orderpriority"])
    assert "ReadSchema: struct<o_orderpriority:string>" in plan(report)


def test_filters_reach_the_scan_through_the_operators(spark):
    raw = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    union = strata.union_relations(spark, [("a", raw), ("b", raw.drop("o_custkey"))])
    merged = strata.merge_pairs(union, [("o_orderpriority", "o_orderstatus", "label")])
    text = plan(merged.filter(F.col("o_orderkey") == 5))
    assert text.count("PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,5)]") == 2
    # Provenance is a constant of each part: other parts are not read at all.
    assert plan(union.filter(F.col("tabela_origem") == "a")).count("Scan parquet") == 2


def test_tickets_are_one_projection(spark):
    schema = inputs.raw_tickets(spark, SF_DIR).schema
    folder = strata.session.scratch_dir(spark, "tickets")
    spark.createDataFrame([], schema).write.parquet(folder)
    text = plan(tickets.mart(tickets.staging(spark.read.parquet(folder))))
    assert "Exchange" not in text and text.count("Scan parquet") <= 2


def test_type_inference_plan_does_not_grow_with_the_table(spark):
    def steps(width):
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(width)]
        return plan(strata.infer_types(spark.createDataFrame([], T.StructType(fields)))).count("HashAggregate")

    assert steps(3) == steps(180)


def test_inference_counts_meet_by_column_after_a_partial_aggregate(spark):
    text = plan(strata.infer_types(inputs.text_orders(spark, SF_DIR)))
    assert "partial_count" in text and "hashpartitioning(column" in text
    assert "SinglePartition" not in text


def test_reconcile_moves_fingerprints_only(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = plan(strata.reconcile(df, df, key="doc_id"))
    assert "Join" not in text and "SortAggregate" not in text
    assert "partial_bit_xor" in text


def test_reconcile_of_a_key_that_fills_the_table(spark):
    rows = spark.range(300_000).select(
        F.when(F.col("id") < 100_000, "hot").otherwise(F.col("id").cast("string")).alias("_airbyte_raw_id"),
        F.col("id").cast("string").alias("v"),
    )
    after = rows.filter(F.col("v") != "299999")
    r = strata.reconcile(rows, after).first()
    assert (r.matched, r.missing, r.changed) == (199_999, 1, 0)
    assert (r.unpaired_source, r.unpaired_target) == (100_000, 100_000)


def test_reconcile_of_a_wide_table(spark):
    wide = spark.range(200).select(
        F.col("id").cast("string").alias("_airbyte_raw_id"),
        *[(F.col("id") + i).alias(f"c{i}") for i in range(180)],
    )
    changed = wide.withColumn("c7", F.lit(None).cast("bigint"))
    compared = strata.reconcile(wide, changed)
    assert plan(compared).count("hashpartitioning") == 1
    got = {r.column_name: (r.matched, r.changed) for r in compared.collect()}
    assert got.pop("c7") == (0, 200)
    assert set(got.values()) == {(200, 0)} and len(got) == 179
