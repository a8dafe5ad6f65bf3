from pyspark.sql import functions as F

import strata
from strata.functions.jsonx import json_array_join, json_field
from workload.scalar import BLANKED


def values(spark, cells, expression, schema="x string"):
    df = spark.createDataFrame([(c,) for c in cells], schema)
    return [r[0] for r in df.select(expression).collect()]


def test_strip_html(spark):
    cases = {
        "<p>a&nbsp;b&#39;</p>": "a b",
        "&#x27; stays": "&#x27; stays",
        "": "",
        "<br><br/>": "",
        " a \n\t <b> b</b>c": "a b c",
        "1 < 2 & 3": "1 < 2 & 3",
        "&am<b>p;": "&am p;",
        "<!-- a > b -->": "b -->",
        "x<y": "x<y",
        "&;&1;&#;": "&;&1;&#;",
    }
    assert values(spark, [*cases, None], strata.strip_html(F.col("x"))) == [*cases.values(), None]


def test_strip_html_long_runs(spark):
    text = "<p>" * 100_000 + "a" + " " * 100_000 + "&nbsp;" * 100_000 + "b"
    assert values(spark, [text], strata.strip_html(F.col("x"))) == ["a b"]


def test_strip_html_equals_three_steps(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    steps = F.col("html")
    for pattern in BLANKED:
        steps = F.regexp_replace(steps, pattern, " ")
    assert pages.filter(strata.strip_html(F.col("html")) != F.trim(steps)).count() == 0


def test_strip_enum_prefix(spark):
    cases = {"_7_COMPLETED": "COMPLETED", "COMPLETED": "COMPLETED", "_x_A": "_x_A", "_1_2_A": "2_A"}
    got = values(spark, [*cases, None], strata.strip_enum_prefix(F.col("x")))
    assert got == [*cases.values(), None]


def test_json_field(spark):
    cases = {
        '{"Description":"a"}': "a",
        '{"Description":null}': None,
        '{"Other":1}': None,
        '{"Description":5}': "5",
        '{"Description":{"k":[1]}}': '{"k":[1]}',
        '{"Description":"q\\"\\u00e9"}': 'q"é',
        '[{"Description":"a"}]': None,
        "5": None,
        "null": None,
        "bad": None,
    }
    got = values(spark, [*cases, None], strata.json_field(F.col("x"), "Description"))
    assert got == [*cases.values(), None]


def test_json_field_names(spark):
    got = values(spark, ['{"a.b":"x"}'], strata.json_field(F.col("x"), "a.b"))
    assert got == ["x"]
    assert values(spark, ['{"it\'s":"x"}'], strata.json_field(F.col("x"), "it's")) == ["x"]


def test_json_array_join(spark):
    cases = {
        "[]": None,
        '[{"FullName":null},{}]': None,
        '[{"FullName":"a"},{"FullName":null},{"FullName":"b"}]': "a, b",
        '{"FullName":"solo"}': "solo",
        '[{"FullName":""}]': "",
        '[{"FullName":""},{"FullName":""}]': ", ",
        '[{"FullName":"a"},"junk",null,5,{"FullName":"b"}]': "a, b",
        '["{\\"FullName\\":\\"quoted\\"}"]': None,
        "[null]": None,
        "bad": None,
        "7": None,
    }
    got = values(spark, [*cases, None], strata.json_array_join(F.col("x"), "FullName"))
    assert got == [*cases.values(), None]


def test_json_parsed_inputs(spark):
    schema = "o struct<Description:string,n:struct<a:int>>, l array<struct<Email:string>>, t array<string>"
    rows = [
        (("d", (1,)), [("a",), (None,), None, ("b",)], ['{"Email":"c"}', None]),
        (None, [], None),
    ]
    df = spark.createDataFrame(rows, schema)
    types = {f.name: f.dataType for f in df.schema.fields}
    got = df.select(
        json_field(F.col("o"), "Description", types["o"]),
        json_field(F.col("o"), "n", types["o"]),
        json_field(F.col("o"), "absent", types["o"]),
        json_array_join(F.col("l"), "Email", dtype=types["l"]),
        json_array_join(F.col("t"), "Email", dtype=types["t"]),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("d", '{"a":1}', None, "a, b", "c"),
        (None, None, None, None, None),
    ]
