import uuid
from datetime import datetime
from decimal import Decimal
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

import strata
from strata.__main__ import run_command
from strata.functions.names import TECHNICAL_COLUMNS, layer_db
from strata.operators.layers import run_log_table, table_location
from strata.plans import relational, schedules, sheets, tickets
from strata.session import scratch_dir
from strata.sources.odata import rejected_pages


@pytest.fixture
def subject():
    return "s" + uuid.uuid4().hex[:8]


def table(spark, database, name):
    return spark.table(f"`{database}`.`{name}`")


@pytest.fixture
def source(spark, subject):
    """Two text sheets and a view, which is no base table."""
    db = strata.create_database(spark, f"public_{subject}")
    costs = [("a", "R$ 1,50", "31/12/2024"), ("b", None, ""), ("c", "-", None)]
    strata.land(spark.createDataFrame(costs, "name string, `unit cost` string, `day.` string"), db, "COSTS")
    strata.land(spark.createDataFrame([("x", None)], "k string, v string"), db, "other")
    spark.sql(f"CREATE VIEW {db}.a_view AS SELECT 1 AS one")
    return db


def test_list_tables(spark, source):
    assert strata.list_tables(spark, source) == ["costs", "other"]
    assert strata.list_tables(spark, source, exclude=["COSTS"]) == ["other"]
    strata.write_table(spark.range(1), source, "fct__new_clients")
    assert strata.list_tables(spark, source) == ["costs", "fct__new_clients", "other"]


def test_land_adds_technical_columns_and_replaces(spark, source):
    first = table(spark, source, "costs")
    assert first.columns == [*TECHNICAL_COLUMNS, "name", "unit cost", "day."]
    assert first.select(TECHNICAL_COLUMNS[0]).distinct().count() == 3
    strata.land(spark.createDataFrame([("z",)], "name string"), source, "costs", generation_id=2)
    again = table(spark, source, "costs")
    assert again.columns == [*TECHNICAL_COLUMNS, "name"]
    assert [(r.name, r[TECHNICAL_COLUMNS[3]]) for r in again.collect()] == [("z", 2)]


def test_write_table_may_read_what_it_replaces(spark, source):
    before = table(spark, source, "other").count()
    strata.write_table(table(spark, source, "other").unionAll(table(spark, source, "other")), source, "other")
    assert table(spark, source, "other").count() == 2 * before


def test_failed_write_keeps_the_old_table(spark, source):
    row = table(spark, source, "other")
    rows = row.unionAll(spark.range(5, numPartitions=4).crossJoin(row).drop("id"))
    broken = rows.withColumn("v", F.when(F.rand() >= 0, F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="stop"):
        strata.write_table(broken, source, "other")
    assert table(spark, source, "other").count() == 1
    # The next run is not hindered by what the failed one left behind.
    strata.write_table(table(spark, source, "other").limit(0), source, "other")
    assert table(spark, source, "other").count() == 0


def test_left_over_files_do_not_block_a_write(spark, source):
    place = spark.sql(f"DESCRIBE DATABASE {source}").filter("info_name = 'Location'").first()[1]
    spark.range(3).write.parquet(f"{place}/other-0")
    strata.write_table(spark.range(2), source, "other")
    assert table(spark, source, "other").count() == 2
    assert strata.list_tables(spark, source) == ["costs", "other"]


def test_copy_layer_is_identical(spark, source, subject):
    target = f"raw_{subject}"
    assert strata.copy_layer(spark, source, target) == ["costs", "other"]
    for name in ("costs", "other"):
        one, two = table(spark, source, name), table(spark, target, name)
        assert one.schema == two.schema
        assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
    with pytest.raises(ValueError):
        strata.copy_layer(spark, source, source.upper())


def test_run_log_appends(spark, subject):
    db = strata.create_database(spark, f"mart_{subject}")
    strata.run_log(spark, "from", db, subject, datetime(2024, 1, 1, 5))
    log = strata.run_log(spark, "from", db, subject, datetime(2024, 1, 2))
    assert [tuple(r) for r in log.collect()] == [
        (datetime(2024, 1, 1, 5), "from", db),
        (datetime(2024, 1, 2), "from", db),
    ]


def test_profile(spark, source, subject):
    at = datetime(2024, 1, 1)
    profile = {r.table_name: r for r in strata.profile_layer(spark, source, profiled_at=at).collect()}
    assert (profile["costs"].row_count, profile["costs"].column_count) == (3, 7)
    folder = Path(urlparse(table_location(spark, source, "costs")).path)
    assert profile["costs"].size_in_bytes == sum(f.stat().st_size for f in folder.glob("*.parquet"))
    assert profile["costs"].profiled_at == at
    assert strata.profile_layer(spark, source, ["costs", "absent"]).count() == 1
    with pytest.raises(ValueError, match="no table to profile"):
        strata.profile_layer(spark, source, ["absent"])


def test_profile_history(spark, source, subject):
    history = strata.create_database(spark, f"audit_{subject}")
    strata.record_profile(spark, source, history, profiled_at=datetime(2024, 1, 1))
    strata.land(spark.createDataFrame([("z",)], "name string"), source, "costs")
    latest = strata.record_profile(spark, source, history, profiled_at=datetime(2024, 2, 1))
    costs = latest.filter(F.col("table_name") == "costs").first()
    assert (costs.row_count, costs.first_seen, costs.profiled_at) == (
        1, datetime(2024, 1, 1), datetime(2024, 2, 1),
    )


def test_reconcile_layers(spark, source, subject):
    target = f"mart_{subject}"
    strata.transform_layer(spark, source, target, strata.null_fill)
    report = strata.reconcile_layers(spark, source, target).collect()
    got = {(r.table_name, r.column_name): r for r in report}
    cost = got["costs", "unit cost"]
    assert (cost.matched, cost.null_filled, cost.changed) == (2, 1, 0)
    with pytest.raises(ValueError, match="no table in common"):
        strata.reconcile_layers(spark, source, strata.create_database(spark, f"none_{subject}"))


# ----------------------------------------------------------------- plans


def test_sheets_plan(spark, source, subject):
    assert sheets.run(spark, source, subject, datetime(2024, 1, 1)) == ["costs", "other"]
    staged = table(spark, layer_db("stg", subject), "costs")
    assert dict(staged.dtypes)["unit cost"] == "decimal(38,9)"
    assert dict(staged.dtypes)["day."] == "date"
    mart = table(spark, layer_db("mart", subject), "costs").orderBy("name")
    assert [r["unit cost"] for r in mart.collect()] == [Decimal("1.5"), 0, 0]
    assert table(spark, layer_db("mart", subject), "other").first().v == ""
    for layer in ("raw", "stg", "mart"):
        assert table(spark, layer_db(layer, subject), run_log_table(subject)).count() == 1
    assert sheets.run(spark, source, subject) == ["costs", "other"]
    assert table(spark, layer_db("mart", subject), run_log_table(subject)).count() == 2


def test_relational_plans(spark, subject):
    raw = strata.create_database(spark, f"raw_{subject}")
    abono = spark.sql(
        "SELECT 1L AS Id, DATE'2024-01-02' AS DataAbono, 'x' AS Descricao, 1.5BD AS value_hours "
        "UNION ALL SELECT NULL, NULL, NULL, NULL"
    )
    strata.write_table(abono, raw, "fct_abono")
    none = "0000-00-00 00:00:00.000"
    assert relational.run_finance(spark, raw, f"f{subject}") == ["fct_abono"]
    finance = table(spark, f"mart_f{subject}", "fct_abono")
    assert {tuple(r) for r in finance.collect()} == {
        (1, "2024-01-02", "x", Decimal("1.5")), (0, none, "", Decimal("0.0")),
    }
    relational.run_crm(spark, raw, f"c{subject}")
    assert {r.value_hours for r in table(spark, f"mart_c{subject}", "fct_abono").collect()} == {"R$ 1.5", "R$ 0"}


def _schedule_tables(spark, subject):
    raw = strata.create_database(spark, f"raw_{subject}")
    bank = "_airbyte_raw_id string, MK string, Valor_entregue__Cliente_ string"
    strata.write_table(spark.createDataFrame([("1", "a", "R$ 1.234,56")], bank), raw, "mk1_00___BANCO")
    strata.write_table(spark.createDataFrame([("2", "b")], "_airbyte_raw_id string, MK string"), raw, "mk22_00___BANCO")
    names = [n for first, second, _ in schedules.DELIVERIES.merges for n in (first, second)]
    schema = "_airbyte_raw_id string, " + ", ".join(f"{n} string" for n in names)
    filled = ["R$ 1,00" if i % 2 else None for i in range(len(names))]
    filled[names.index("FAT__PRODUTO")] = "R$ -"
    strata.write_table(spark.createDataFrame([("3", *filled)], schema), raw, "mk1_00___ENTREGAS")
    strata.write_table(spark.createDataFrame([("4",)], "x string"), raw, "summary")
    return raw


def test_schedules_plan(spark, subject):
    raw = _schedule_tables(spark, subject)
    assert strata.discover_codes(spark, raw, [k.pattern for k in schedules.KINDS]) == ["mk1", "mk22"]
    marts = schedules.run(spark, raw, subject=subject)
    # _FAT__PRODUTO_ holds no number at all; its partner makes it one.
    assert list(marts["fct_entregas"].first())[-5:] == [1, 0, 1, 1, 1]


def test_schedules_plan_marts(spark, subject):
    raw = _schedule_tables(spark, subject)
    deliveries = schedules.Kind(
        schedules.DELIVERIES.suffix,
        schedules.DELIVERIES.table,
        [n for first, second, _ in schedules.DELIVERIES.merges for n in (first, second)],
        schedules.DELIVERIES.merges,
    )
    marts = schedules.run(spark, raw, kinds=[schedules.BANK, schedules.ACTIVITIES, deliveries], subject=subject)
    bank = marts["fct_banco"].orderBy("codigo_cronograma")
    assert [tuple(r) for r in bank.collect()] == [
        ("mk1", "mk1_00___BANCO", "1", "a", Decimal("1234.56")),
        ("mk22", "mk22_00___BANCO", "2", "b", Decimal(0)),
    ]
    assert marts["fct_atividades"].columns == ["codigo_cronograma", "tabela_origem"]
    assert marts["fct_atividades"].count() == 0
    entregas = marts["fct_entregas"]
    assert entregas.columns[-5:] == [name for _, _, name in schedules.DELIVERIES.merges]
    assert list(entregas.first())[-5:] == [1, 0, 1, 1, 1]


def test_codes_are_cut_and_missing_tables_skipped(spark, subject):
    raw = _schedule_tables(spark, subject)
    found = strata.find_relations(spark, raw, ["MK1_old", "mk404"], "_00___BANCO")
    assert [name for name, _ in found] == ["mk1_00___BANCO"]


def test_tickets_plan(spark, subject):
    raw_db = strata.create_database(spark, f"raw_{subject}")
    given = {
        "ID_": "1", "Body": "'<p>a</p>'", "Status": "'_7_COMPLETED'", "Priority": "NULL",
        "Followers": """'[{"FullName":"a"},{"FullName":"b"}]'""", "Department": """'{"Description":"d"}'""",
        "Estimation": "NULL", "TicketType": "'{}'", "CanBeClosed": "CAST(NULL AS BOOLEAN)",
        "changedDate": "CAST(NULL AS TIMESTAMP)", "createdDate": "CAST(NULL AS TIMESTAMP)",
        "Accountables": "'[]'", "ExpectedDate": "CAST(NULL AS TIMESTAMP)", "Satisfaction": "CAST(NULL AS INT)",
        "BriefDescription": "NULL", "RequesterDepartment": "NULL", "IsConclusionNotified": "true",
    }
    text = lambda v: f"CAST({v} AS STRING)" if v == "NULL" else v
    select = ", ".join(f"{text(v)} AS {n}" for n, v in given.items())
    strata.land(spark.sql(f"SELECT {select}"), raw_db, "tickets")
    mart = tickets.run(spark, f"{raw_db}.tickets", subject)
    assert mart.columns == TECHNICAL_COLUMNS + tickets.COLUMNS
    assert tuple(mart.first())[4:] == (
        1, "a", "COMPLETED", "", "a, b", "d", "", "", None, None, None, "", None, 0, "", "", True,
    )


# --------------------------------------------------------------- sources


def test_sheet_round_trip(spark):
    path = scratch_dir(spark, "sheet")
    rows = [('q"uote', "x,y", "line\nbreak", " pad "), ("a", None, "é", "1")]
    df = spark.createDataFrame(rows, "a string, `b.c` string, `d e` string, f string")
    strata.write_sheet(df, path)
    assert {tuple(r) for r in strata.read_sheet(spark, path, multiline=True).collect()} == set(rows)
    named = strata.read_sheet(spark, path, multiline=True, columns=df.columns)
    assert {tuple(r) for r in named.collect()} == set(rows)


def test_export_layer(spark, subject):
    db = strata.create_database(spark, f"mart_{subject}")
    df = spark.sql("SELECT 1e20D AS x, array(1,2) AS l, named_struct('a', 1) AS s, DATE'2024-01-01' AS d")
    strata.write_table(df, db, "wide")
    folder = scratch_dir(spark, "export")
    assert strata.export_layer(spark, db, folder) == ["wide"]
    assert tuple(strata.read_sheet(spark, f"{folder}/wide").first()) == ("1e+20", "[1,2]", '{"a":1}', "2024-01-01")


def test_pages(spark):
    pages = [
        '{"@context":"x","value":[{"Id":1,"Name":"a","Dep":{"Description":"d"}},{"Id":2,"Tags":[1]}]}',
        '{"value":[]}',
    ]
    path = scratch_dir(spark, "pages")
    spark.createDataFrame([(p,) for p in pages], "value string").write.text(path)
    typed = strata.read_pages(spark, path, "Id bigint, Dep string")
    assert {tuple(r) for r in typed.collect()} == {(1, '{"Description":"d"}'), (2, None)}
    found = strata.read_pages(spark, path)
    assert sorted(found.columns) == ["Dep", "Id", "Name", "Tags"]
    assert {tuple(r) for r in found.select("Id", "Name", "Dep", "Tags").collect()} == {
        ("1", "a", '{"Description":"d"}', None), ("2", None, None, "[1]"),
    }


def test_bad_pages_are_errors_unless_lenient(spark):
    pages = ['{"value":[{"Id":1}]}', '{"value":[{"Id":2', '{"error":"busy"}', '{"value":[{"Id":"x"}]}']
    path = scratch_dir(spark, "bad-pages")
    spark.createDataFrame([(p,) for p in pages], "value string").write.text(path)
    with pytest.raises(Exception, match="not a page of entities"):
        strata.read_pages(spark, path, "Id bigint").collect()
    assert [tuple(r) for r in strata.read_pages(spark, path, "Id bigint", lenient=True).collect()] == [(1,)]
    assert tuple(rejected_pages(spark, path, "Id bigint").first()) == (4, 3)


def test_sheets_do_not_mix_up_headers(spark):
    path = scratch_dir(spark, "headers")
    spark.createDataFrame([("x,y",), ("1,2",)], "value string").coalesce(1).write.text(f"{path}/a")
    spark.createDataFrame([("y,x",), ("20,10",)], "value string").coalesce(1).write.text(f"{path}/b")
    spark.createDataFrame([("x,y",), ("1,2,3",)], "value string").coalesce(1).write.text(f"{path}/c")
    with pytest.raises(Exception):
        strata.read_sheet(spark, [f"{path}/a", f"{path}/b"]).collect()
    with pytest.raises(Exception):
        strata.read_sheet(spark, f"{path}/c").collect()


def test_swap_keeps_rows_when_it_stops(spark, source, monkeypatch):
    """A driver that stops before the table is pointed to its new folder leaves the old rows."""
    from strata.operators import layers

    def stop(*_):
        raise RuntimeError("stop")

    monkeypatch.setattr(layers, "table_location", stop)
    with pytest.raises(RuntimeError):
        strata.write_table(table(spark, source, "other").limit(0), source, "other")
    monkeypatch.undo()
    assert table(spark, source, "other").count() == 1
    monkeypatch.setattr(layers, "remove_folder", stop)
    with pytest.raises(RuntimeError):
        strata.write_table(table(spark, source, "other").limit(0), source, "other", grace_hours=0)
    monkeypatch.undo()
    assert table(spark, source, "other").count() == 0


@pytest.mark.parametrize("step", ["parquet", "table_location", "_point", "sweep_folders"])
def test_killed_at_any_step(spark, source, monkeypatch, step):
    """With other columns too there is either the old table or the new one, and a later write tidies up."""
    from strata.operators import layers

    old = [tuple(r) for r in table(spark, source, "costs").collect()]
    new = spark.createDataFrame([(1.5, "x")], "n double, `other.` string")

    def stop(*_):
        raise RuntimeError("stop")

    if step == "parquet":  # some files are written, but not all
        broken = new.select(F.raise_error(F.lit("stop")).cast("int").alias("n"))
        with pytest.raises(Exception, match="stop"):
            strata.write_table(broken, source, "costs")
    else:
        monkeypatch.setattr(layers, step, stop)
        with pytest.raises(RuntimeError):
            strata.write_table(new, source, "costs")
        monkeypatch.undo()
    now = table(spark, source, "costs")
    if step == "sweep_folders":
        assert (now.columns, [tuple(r) for r in now.collect()]) == (["n", "other."], [(1.5, "x")])
    else:
        assert [tuple(r) for r in now.collect()] == old
    strata.write_table(new, source, "costs", grace_hours=0)
    root = Path(urlparse(table_location(spark, source, "costs")).path).parent
    assert len([p for p in root.iterdir() if p.name.startswith("costs-")]) == 1
    assert strata.list_tables(spark, source) == ["costs", "other"]


def test_open_readers_finish(spark, source):
    """Replacing a table by other columns leaves those who read it their rows; the grace period keeps the files."""
    strata.write_table(spark.range(0, 5000, 1, 8).toDF("k"), source, "long")
    reader = table(spark, source, "long")
    rows = reader.toLocalIterator()
    seen = [next(rows).k]
    strata.write_table(spark.createDataFrame([("z",)], "other string"), source, "long")
    seen += [r.k for r in rows]
    assert sorted(seen) == list(range(5000)) and reader.count() == 5000
    assert [tuple(r) for r in table(spark, source, "long").collect()] == [("z",)]
    strata.write_table(spark.createDataFrame([("y",)], "other string"), source, "long", grace_hours=0)
    with pytest.raises(Exception):
        reader.count()


def test_a_table_made_by_others_is_replaced(spark, source):
    spark.createDataFrame([(1,)], "a int").write.saveAsTable(f"{source}.made")
    strata.write_table(spark.createDataFrame([("x",)], "b string"), source, "made")
    strata.write_table(spark.createDataFrame([(2,)], "c int"), source, "made")
    assert [tuple(r) for r in table(spark, source, "made").collect()] == [(2,)]
    assert "made" in strata.list_tables(spark, source)


def test_relational_options(spark, monkeypatch):
    from strata.sources import relational as source

    calls = []

    class Reader:
        def format(self, name):
            assert name == "jdbc"
            return self

        def options(self, **options):
            calls.append(options)
            return self

        def load(self):
            return self

        def first(self):
            return (1, 100)

    class Session:
        read = Reader()

    source.read_relational(Session(), "jdbc:x", "t", "id", 10, {"user": "u"}, split="even")
    assert "min(id)" in calls[0]["query"]
    assert calls[1]["dbtable"] == "t" and calls[1]["user"] == "u"
    assert (calls[1]["lowerBound"], calls[1]["upperBound"], calls[1]["numPartitions"]) == ("1", "100", "10")
    calls.clear()
    source.read_relational(Session(), "jdbc:x", "t")
    assert len(calls) == 1 and "partitionColumn" not in calls[0]


def test_balanced_ranges(spark):
    """Ranges end where the rows add up; every value is in one range, and rows without a value in the first."""
    from strata.sources.relational import balanced_ends, range_predicates

    rows = [1] * 10 + [2] * 10 + list(range(1000, 1080)) + [100_000, None]
    known = [r for r in rows if r is not None]
    low, high, cells = min(known), max(known), 64 * 4
    counts = {}
    for r in known:
        cell = int((r - low) * cells / (high - low + 1))
        counts[cell] = counts.get(cell, 0) + 1
    predicates = range_predicates("id", balanced_ends(counts, low, high, cells, 4))
    df = spark.createDataFrame([(r,) for r in rows], "id long")
    parts = [df.filter(p).count() for p in predicates]
    assert sum(parts) == len(rows) and len(predicates) >= 2
    even = spark.createDataFrame([(i,) for i in range(10_000)], "id long")
    ends = balanced_ends({c: 10_000 // 256 for c in range(256)}, 0, 9999, 256, 4)
    assert [round(e) for e in ends] == [2500, 5000, 7500]
    assert [even.filter(p).count() for p in range_predicates("id", ends)] == [2500] * 4
    assert balanced_ends({0: 5}, 7, 7, 256, 4) == [] and range_predicates("id", []) == []


def test_balanced_reading_asks_for_a_histogram(spark, monkeypatch):
    from strata.sources import relational as source

    calls, read = [], {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            calls.append(options)
            return self

        def load(self):
            return self

        def first(self):
            return (0, 99)

        def collect(self):
            return [(i, 10 if i < 64 else 1) for i in range(128)]

        def jdbc(self, url, table, predicates, properties):
            read.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    source.read_relational(Session(), "jdbc:x", "t", "id", 2, {"user": "u"})
    assert "GROUP BY floor((id - (0)) * 128.0" in calls[1]["query"]
    assert len(read["predicates"]) == 2 and "IS NULL" in read["predicates"][0] and read["properties"]["user"] == "u"
    with pytest.raises(ValueError, match="balanced"):
        source.read_relational(Session(), "jdbc:x", "t", "id", split="odd")


def test_names_that_are_data_are_refused(spark):
    path = scratch_dir(spark, "wide-pages")
    keys = F.to_json(F.map_from_arrays(F.array(F.concat(F.lit("k"), F.col("id"))), F.array(F.col("id"))))
    page = F.concat(F.lit('{"value":['), keys, F.lit("]}"))
    spark.range(1_000_000).select(page.alias("value")).write.text(path)
    with pytest.raises(ValueError, match="more than 2000 different fields, such as k"):
        strata.read_pages(spark, path)
    one = scratch_dir(spark, "wide-page")
    wide = '{"value":[{' + ",".join(f'"f{i}":{i}' for i in range(50)) + "}]}"
    spark.createDataFrame([(wide,)], "value string").write.text(one)
    assert len(strata.read_pages(spark, one).columns) == 50
    with pytest.raises(Exception, match="more than 40 fields, among them f0"):
        strata.read_pages(spark, one, most_fields=40)


def test_header_groups(spark):
    from strata.sources.sheets import header_groups

    path = scratch_dir(spark, "groups")
    lines = lambda *rows: spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1)
    lines("x,y", "1,2").write.text(f"{path}/a")
    lines("y,x", "20,10", "21,11").write.text(f"{path}/b")
    lines('z,"x"', '"a,b",3').write.option("compression", "gzip").text(f"{path}/c")
    lines("x,y").write.text(f"{path}/d")  # a header alone
    spark.createDataFrame([], "value string").write.text(f"{path}/e")  # no header
    lines("x,y", "7,8").write.text(f"{path}/_hidden")
    assert sorted(len(f) for f in header_groups(spark, path).values()) == [1, 1, 2]
    got = strata.read_sheet(spark, path, by_name=True)
    assert got.columns == ["x", "y", "z"]
    assert {(r.x, r.y, r.z) for r in got.collect()} == {("1", "2", None), ("10", "20", None), ("11", "21", None), ("3", None, "a,b")}
    assert strata.read_sheet(spark, [f"{path}/a", f"{path}/d"], by_name=True).count() == 1
    with pytest.raises(ValueError, match="no file with a header"):
        strata.read_sheet(spark, f"{path}/e", by_name=True)
    with pytest.raises(ValueError, match="no such path"):
        strata.read_sheet(spark, f"{path}/none", by_name=True)


def test_scratch_dir_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_scratch_dir_without_a_shared_folder():
    class Session:
        def __init__(self, master):
            self.conf = {"spark.master": master}

    assert scratch_dir(Session("local[2]"), "x").startswith("/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session("spark://host:7077"), "x")


def test_command_line(spark, source, subject, capsys):
    run_command(spark, ["sheets", source, "--subject", subject, "--threads", "2"])
    run_command(spark, ["profile", layer_db("mart", subject)])
    assert "costs" in capsys.readouterr().out
    run_command(spark, ["reconcile", layer_db("raw", subject), layer_db("mart", subject)])
    assert "null_filled" in capsys.readouterr().out
    run_command(spark, ["export", layer_db("mart", subject), scratch_dir(spark, "cli")])
    raw = strata.create_database(spark, f"raw_{subject}2")
    strata.write_table(spark.range(3), raw, "t")
    run_command(spark, ["finance", raw, "--subject", f"{subject}2"])
    assert table(spark, layer_db("mart", f"{subject}2"), "t").count() == 3
    run_command(spark, ["crm", raw, "--subject", f"{subject}2"])
    run_command(spark, ["schedules", raw, "--subject", f"{subject}2"])
    assert table(spark, layer_db("mart", f"{subject}2"), "fct_banco").count() == 0
    with pytest.raises(SystemExit):
        run_command(spark, ["nothing"])
