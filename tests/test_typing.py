from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import strata
from strata.functions.brazil import is_blank, number_text
from strata.operators.typing_text import number_type


def column(spark, cells, expression, schema="x string"):
    df = spark.createDataFrame([(c,) for c in cells], schema)
    return [r[0] for r in df.select(expression).collect()]


NUMBERS = {
    "R$ 1.234,56": "1234.56", "1.234": "1234", "12.5": "12.5", "-3": "-3", "R$-4,5": "-4.5",
    "R$ 1,00": "1", " 1,00 ": "1", "(1,00)": None, "10%": None, "007": "7", "R$ -": None,
    "-": None, "": None, "1.23.4": None, "1.234.567,8": "1234567.8", "1234,5": "1234.5",
    "1.2345": "1.2345", "1,2,3": None, "1e5": None, "+1": None, ".5": None, "abc": None,
}


def test_parse_number(spark):
    got = column(spark, [*NUMBERS, None], strata.parse_number(F.col("x")))
    assert got == [None if v is None else Decimal(v) for v in [*NUMBERS.values(), None]]


def test_parse_number_round_trip(spark):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.integers(-(10**15), 10**15), min_size=1, max_size=50))
    def check(cents):
        cells = []
        for c in cents:
            whole, part = divmod(abs(c), 100)
            cells.append(f"R$ {'-' if c < 0 else ''}{whole:,}".replace(",", ".") + f",{part:02d}")
        assert column(spark, cells, strata.parse_number(F.col("x"))) == [
            Decimal(c) / 100 for c in cents
        ]

    check()


def test_parse_date(spark):
    cases = {
        "31/12/2024": date(2024, 12, 31), "2024-12-31": date(2024, 12, 31), "31/02/2024": None,
        "2024-12-31 10:00:00": None, "1/2/2024": None, " 01/02/2024 ": date(2024, 2, 1), "": None,
    }
    got = column(spark, [*cases, None], strata.parse_date(F.col("x")))
    assert got == [*cases.values(), None]


def test_is_blank(spark):
    cells = ["", " ", "-", "R$", "R$ -", " R$  - ", None, "0", "R$ 0", "x"]
    assert column(spark, cells, is_blank(F.col("x"))) == [True] * 7 + [False] * 3


SHEET = "_airbyte_raw_id string, n string, d string, t string, b string, m string, typed int"
ROWS = [
    ("1", "R$ 1,50", "31/12/2024", "x", "R$ -", "1", 1),
    ("2", "-", "2024-01-02", "", "", "31/12/2024", None),
    ("3", None, "", None, None, "2", 3),
]


def test_infer_types(spark):
    report = {r["column"]: r for r in strata.infer_types(spark.createDataFrame(ROWS, SHEET)).collect()}
    assert {c: r.inferred_type for c, r in report.items()} == {
        "n": "numeric", "d": "date", "t": "text", "b": "text", "m": "text",
    }
    n = report["n"]
    assert (n.n_rows, n.n_blank, n.n_numeric, n.n_date) == (3, 2, 1, 0)
    assert (n.integer_digits, n.fraction_digits) == (1, 2)


def test_type_columns(spark):
    df = spark.createDataFrame(ROWS, SHEET).select("n", "d", "t", "b", "m", "typed", "_airbyte_raw_id")
    typed = strata.type_columns(df)
    assert typed.columns == ["_airbyte_raw_id", "n", "d", "t", "b", "m", "typed"]
    assert [f.dataType.simpleString() for f in typed.schema.fields] == [
        "string", "decimal(38,9)", "date", "string", "string", "string", "int",
    ]
    assert [tuple(r) for r in typed.orderBy("_airbyte_raw_id").collect()] == [
        ("1", Decimal("1.5"), date(2024, 12, 31), "x", "R$ -", "1", 1),
        ("2", None, date(2024, 1, 2), "", "", "31/12/2024", None),
        ("3", None, None, None, None, "2", 3),
    ]


def test_force_and_keep(spark):
    df = spark.createDataFrame(ROWS, SHEET)
    typed = strata.type_columns(df, force_numeric=["b", "m"], keep_text=["n"])
    assert [tuple(r) for r in typed.select("n", "b", "m").collect()] == [
        ("R$ 1,50", None, Decimal(1)), ("-", None, None), (None, None, Decimal(2)),
    ]
    with pytest.raises(ValueError, match="both forced"):
        strata.type_columns(df, force_numeric=["n"], keep_text=["n"])


def test_a_blank_partner_follows_its_number(spark):
    df = spark.createDataFrame([("1,5", "-", "", None, "x", "")], "a string, b string, c string, d string, e string, f string")
    types = lambda **named: [f.dataType.simpleString()[:7] for f in strata.type_columns(df, **named).schema]
    pairs = [("a", "b"), ("d", "c"), ("f", "e")]
    assert types(partners=pairs) == ["decimal", "decimal", "string", "string", "string", "string"]
    assert types(partners=pairs, force_numeric=["c"])[2:4] == ["decimal", "decimal"]
    assert types(partners=pairs, keep_text=["b"])[1] == "string"


def test_no_digit_is_lost(spark):
    wide = "1" * 30
    rows = [(f"0.{'3' * 12}", wide, wide), ("1", "0.1234567891", "0.5")]
    df = spark.createDataFrame(rows, "long string, both string, whole string")
    with pytest.raises(ValueError, match="'both'"):
        strata.type_columns(df)
    with pytest.raises(ValueError, match="'both'"):
        strata.type_columns(df.select("both"), force_numeric=["both"])
    typed = strata.type_columns(df, keep_text=["both"])
    types = {f.name: f.dataType.simpleString() for f in typed.schema.fields}
    assert types == {"long": "decimal(38,12)", "both": "string", "whole": "decimal(38,1)"}
    assert typed.first().long == Decimal("0." + "3" * 12)
    assert typed.first().whole == Decimal(wide)


def test_one_number_form_a_column(spark):
    rows = [("1.234", "1.234", "1,5"), ("12.5", "2", "0.75"), ("0.75", "1.234.567", "1")]
    df = spark.createDataFrame(rows, "plain string, local string, both string")
    report = {r["column"]: (r.n_br_only, r.n_plain_only, r.n_ambiguous) for r in strata.infer_types(df).collect()}
    assert report == {"plain": (0, 2, 1), "local": (1, 0, 1), "both": (1, 1, 0)}
    typed = strata.type_columns(df)
    assert [r.plain for r in typed.collect()] == [Decimal("1.234"), Decimal("12.5"), Decimal("0.75")]
    assert [r.local for r in typed.collect()] == [1234, 2, 1234567]
    assert typed.schema["both"].dataType == T.StringType()


def test_union_and_typing_keep_values(spark):
    one = spark.createDataFrame([(Decimal("1.234"),), (Decimal("12.500"),)], "v decimal(18,3)")
    two = spark.createDataFrame([("R$ 5,00",)], "v string")
    typed = strata.type_columns(strata.union_relations(spark, [("a", one), ("b", two)]), keep_text=["tabela_origem"])
    assert sorted(r.v for r in typed.collect()) == [Decimal("1.234"), Decimal(5), Decimal("12.5")]


def texts(spark, *cells):
    return spark.createDataFrame([(c,) for c in cells], "v string")


def test_forced_columns_read_each_cell_in_its_form(spark):
    typed = strata.type_columns(texts(spark, "1,5", "0.75", "R$ -", "12.5", "x", "1.234,5"), force_numeric=["v"])
    assert [r.v for r in typed.collect()] == [Decimal("1.5"), Decimal("0.75"), None, Decimal("12.5"), None, Decimal("1234.5")]
    with pytest.raises(ValueError, match="'v'.*either"):
        strata.type_columns(texts(spark, "1,5", "0.75", "1.234"), force_numeric=["v"])
    only = strata.type_columns(texts(spark, "1.234", "0.75", "x"), force_numeric=["v"])
    assert [r.v for r in only.collect()] == [Decimal("1.234"), Decimal("0.75"), None]


def values(df):
    return sorted((r.tabela_origem, r.v) for r in df.collect())


def test_each_relation_is_read_in_its_form(spark):
    typed = spark.createDataFrame([(Decimal("12.500"),)], "v decimal(18,3)")
    local, plain = texts(spark, "1.234", "-"), texts(spark, "1.234", "3.5")
    got = strata.union_typed(spark, [("d", typed), ("l", local), ("p", plain), ("z", texts(spark, "", None))])
    assert isinstance(got.schema["v"].dataType, T.DecimalType)
    rows = {(a, b) for a, b in ((r.tabela_origem, r.v) for r in got.collect())}
    assert rows == {("d", Decimal("12.5")), ("l", Decimal(1234)), ("l", None), ("p", Decimal("1.234")), ("p", Decimal("3.5")), ("z", None)}
    forced = strata.union_typed(spark, [("d", typed), ("p", texts(spark, "7.25", "3.5", "x"))], force_numeric=["v"])
    assert {(r.tabela_origem, r.v) for r in forced.collect()} == {("d", Decimal("12.5")), ("p", Decimal("7.25")), ("p", Decimal("3.5")), ("p", None)}


def test_typed_union_keeps_text_dates_and_digits(spark):
    mixed = strata.union_typed(spark, [("a", texts(spark, "1,5")), ("b", texts(spark, "word"))])
    assert values(mixed) == [("a", "1,5"), ("b", "word")]
    days = strata.union_typed(spark, [("a", texts(spark, "31/12/2024")), ("b", spark.createDataFrame([(date(2024, 1, 2),)], "v date"))])
    assert values(days) == [("a", date(2024, 12, 31)), ("b", date(2024, 1, 2))]
    long, double = spark.createDataFrame([(2**53 + 1,)], "v bigint"), spark.createDataFrame([(0.5,), (1e15,)], "v double")
    wide = strata.union_typed(spark, [("a", long), ("b", double)])
    assert values(wide) == [("a", Decimal(2**53 + 1)), ("b", Decimal("0.5")), ("b", Decimal(10**15))]
    assert values(strata.union_relations(spark, [("a", long), ("b", double)])) == [("a", str(2**53 + 1)), ("b", "0,5"), ("b", "1e+15")]
    floats = strata.union_typed(spark, [("a", double), ("b", texts(spark, "R$ 2,25"))])
    assert floats.schema["v"].dataType == T.DoubleType() and values(floats)[-1] == ("b", 2.25)
    with pytest.raises(ValueError, match="floating point"):
        strata.union_typed(spark, [("a", double), ("b", texts(spark, "1234567890123456,5"))])
    kept = strata.union_typed(spark, [("a", texts(spark, "007")), ("b", texts(spark, "008"))], keep_text=["v"])
    assert values(kept) == [("a", "007"), ("b", "008")]
    assert strata.union_typed(spark, []).columns == ["tabela_origem"]
    empty = strata.union_typed(spark, [("a", texts(spark, "1")), ("b", texts(spark))])
    assert values(empty) == [("a", Decimal(1))]
    with pytest.raises(ValueError, match="no such"):
        strata.union_typed(spark, [("a", long)], force_numeric=["w"])


def test_lost_cells(spark):
    lost = strata.LostCells()
    typed = strata.type_columns(texts(spark, "1,5", "10%", "R$ -", "", None, "x"), force_numeric=["v"], lost=lost)
    typed.write.format("noop").mode("overwrite").save()
    assert lost.counts() == {"v": 2}
    lost = strata.LostCells()
    union = strata.union_typed(spark, [("a", texts(spark, "1", "y")), ("b", texts(spark, "2"))], force_numeric=["v"], lost=lost)
    union.write.format("noop").mode("overwrite").save()
    assert {(r.relation, r.column, r.n_lost) for r in lost.frame(spark).collect()} == {("a", "v", 1), ("b", "v", 0)}
    assert lost.counts() == {"v": 1}


def test_named_columns_must_exist(spark):
    with pytest.raises(ValueError, match="V_TYPO"):
        strata.type_columns(spark.createDataFrame([("1",)], "v string"), force_numeric=["V_TYPO"])


def test_number_type():
    assert number_type(29, 9) == T.DecimalType(38, 9)
    assert number_type(36, 2) == T.DecimalType(38, 2)
    assert number_type(5, 20) == T.DecimalType(38, 20)
    assert number_type(39, 0) is None


def test_empty_and_odd_names(spark):
    empty = spark.createDataFrame([], "`a.b` string, `c d` string, e int")
    assert strata.type_columns(empty).dtypes == [("a.b", "string"), ("c d", "string"), ("e", "int")]
    named = spark.createDataFrame([("1", "01/01/2024", 1)], empty.schema)
    assert strata.type_columns(named).dtypes == [
        ("a.b", "decimal(38,9)"), ("c d", "date"), ("e", "int"),
    ]
    assert strata.infer_types(named.select("e")).count() == 0


def test_wide_table(spark):
    names = [f"c{i}" for i in range(180)]
    wide = spark.createDataFrame([tuple("1,5" for _ in names)] * 3, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    typed = strata.type_columns(wide)
    assert {t for _, t in typed.dtypes} == {"decimal(38,9)"}
    assert typed.agg(F.sum("c179")).first()[0] == Decimal("4.5")


def test_case_collision(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string").toDF("a", "A")
    with pytest.raises(ValueError, match="differ only in case"):
        strata.infer_types(df)


def test_number_text(spark):
    def text(values, kind):
        df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
        return [r[0] for r in df.select(number_text(F.col("x"), df.schema["x"].dataType)).collect()]

    doubles = [5.0, -0.5, 123456789.0, 1e14, 1e15, 1e20, 1.5e-7, 1.5e-5, 0.0001, 0.0, 1.5e300, None]
    assert text(doubles, "double") == [
        "5", "-0.5", "123456789", "100000000000000", "1e+15", "1e+20", "1.5e-07", "1.5e-05", "0.0001",
        "0", "1.5e+300", None,
    ]
    assert text([Decimal("1.50"), Decimal("0")], "decimal(10,2)") == ["1.50", "0.00"]
    assert text([7], "bigint") == ["7"]
    assert text([float("nan")], "double") == ["NaN"]
