"""Typing of all-text columns from the values they hold.

``infer_types`` is one aggregate over the whole table: every row counts, no
sample. Its result has one row per column, so reading it on the driver is
bounded by the width of the table. ``apply_types`` is a plain projection.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import brazil
from strata.functions.names import check_case_collisions, col, split_technical
from strata.session import literal_rows

# Number forms of a column.
BRAZILIAN, PLAIN, MIXED = "br", "plain", "mixed"

REPORT_SCHEMA = (
    "column string, inferred_type string, n_rows bigint, n_blank bigint, "
    "n_numeric bigint, n_date bigint, integer_digits bigint, fraction_digits bigint, "
    "n_br_only bigint, n_plain_only bigint, n_ambiguous bigint"
)


def text_columns(df: DataFrame) -> list[str]:
    """Business columns that hold text; the others need no typing."""
    _, business = split_technical(df.columns)
    return [n for n in business if isinstance(df.schema[n].dataType, T.StringType)]


def infer_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Report the type of each text column as ``numeric``, ``date`` or ``text``.

    A column is numeric (a date) when it has a value and all its values are
    numbers (dates); cells without a value are ignored. A table without rows
    gives an empty report.

    A column has one number form. ``n_br_only`` cells have the Brazilian form alone
    (``1,5``), ``n_plain_only`` cells the plain form alone (``0.75``), ``n_ambiguous``
    cells both (``1.234``). The form is plain when a cell demands it, else Brazilian;
    cells that demand both make the column text. The digit counts follow the form, or, where
    both are demanded, the form of each cell.

    The cells are unpivoted, so the plan and its generated code stay the same
    size however wide the table is, and the counts of all tasks meet by column
    instead of in one task.
    """
    check_case_collisions(df.columns)
    names = text_columns(df) if columns is None else list(columns)
    if not names:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    counts = count_forms(df.unpivot([], [col(n) for n in names], "column", "value"), ["column"])
    digits = lambda part: (
        F.when((F.col("n_br_only") > 0) & (F.col("n_plain_only") > 0), F.col(f"own_{part}"))
        .when(F.col("n_plain_only") > 0, F.col(f"plain_{part}"))
        .otherwise(F.col(f"br_{part}"))
    )
    return counts.select(
        "column", "inferred_type", "n_rows", "n_blank", "n_numeric", "n_date",
        digits("whole").alias("integer_digits"), digits("fraction").alias("fraction_digits"),
        "n_br_only", "n_plain_only", "n_ambiguous",
    )


def count_forms(cells: DataFrame, keys: list[str]) -> DataFrame:
    """For each key, what the cells in ``value`` look like; the digits are counted in each number form."""
    # Each step uses the one before several times; as steps they run once.
    cells = cells.select(*keys, brazil.trimmed(F.col("value")).alias("cell"))
    cells = cells.select(*keys, "cell", brazil.number_form(F.col("cell")).alias("form"))
    cell, form = F.col("cell"), F.col("form")
    digits = F.when(form.isNotNull(), F.length(F.translate(cell, "-R$,. \t\r\n\x0b\f\xa0", "")))
    after = lambda mark: F.when(F.instr(cell, mark) > 0, F.length(cell) - F.instr(cell, mark)).otherwise(0)
    kinds = cells.select(
        *keys, "form", digits.alias("digits"), after(",").alias("br"), after(".").alias("plain"),
        F.when(form.isNull(), brazil.is_blank(cell)).otherwise(False).alias("blank"),
        F.when(form.isNull(), brazil.cell_date(cell).isNotNull()).otherwise(False).alias("date"),
    )
    number = form.isNotNull()
    most = lambda n: F.coalesce(F.max(F.when(number, n)), F.lit(0)).cast("bigint")
    own = F.when(form == "br", F.col("br")).when(form == "plain", F.col("plain")).otherwise(0)
    counts = kinds.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("blank")).alias("n_blank"),
        F.count_if(number).alias("n_numeric"),
        F.count_if(F.col("date")).alias("n_date"),
        most(F.col("digits") - F.col("br")).alias("br_whole"),
        most(F.col("br")).alias("br_fraction"),
        most(F.col("digits") - F.col("plain")).alias("plain_whole"),
        most(F.col("plain")).alias("plain_fraction"),
        most(F.col("digits") - own).alias("own_whole"),
        most(own).alias("own_fraction"),
        F.count_if(form == "br").alias("n_br_only"),
        F.count_if(form == "plain").alias("n_plain_only"),
        F.count_if(form == "both").alias("n_ambiguous"),
    )
    values = F.col("n_rows") - F.col("n_blank")
    one_form = (F.col("n_br_only") == 0) | (F.col("n_plain_only") == 0)
    inferred = (
        F.when(values == 0, "text")
        .when((F.col("n_numeric") == values) & one_form, "numeric")
        .when(F.col("n_date") == values, "date")
        .otherwise("text")
    )
    return counts.withColumn("inferred_type", inferred)


def number_type(integer_digits: int, fraction_digits: int) -> T.DecimalType | None:
    """Decimal that holds every value exactly: the usual scale, or as much as is needed.

    None when no decimal is wide enough.
    """
    for scale in (max(brazil.NUMBER.scale, fraction_digits), fraction_digits):
        if scale <= 38 and integer_digits + scale <= 38:
            return T.DecimalType(38, scale)
    return None


class LostCells:
    """Counts, per column, cells that were not blank and became NULL in typing.

    The counts are metrics of the job that writes (or otherwise computes) the typed rows, so
    they cost no pass of their own. Use one object for one call; read it after the job.
    """

    def __init__(self) -> None:
        self._watched: list[tuple[str | None, list[str], Observation]] = []

    def watch(self, df: DataFrame, flags: dict[str, Column], relation: str | None = None) -> DataFrame:
        """``df``, which counts the rows with each flag when it is computed."""
        if not flags:
            return df
        seen = Observation()
        self._watched.append((relation, list(flags), seen))
        return df.observe(seen, *[F.count_if(flag).alias(f"n{i}") for i, flag in enumerate(flags.values())])

    def counts(self) -> dict[str, int]:
        """Lost cells of each converted column, over all relations."""
        found: dict[str, int] = {}
        for _, column, n in self._rows():
            found[column] = found.get(column, 0) + n
        return found

    def frame(self, spark: SparkSession) -> DataFrame:
        """``relation, column, n_lost``, one row for each relation and converted column."""
        return literal_rows(spark, self._rows(), "relation string, column string, n_lost bigint")

    def _rows(self) -> list[tuple[str | None, str, int]]:
        out = []
        for relation, columns, seen in self._watched:
            got = seen.get
            out += [(relation, c, int(got.get(f"n{i}") or 0)) for i, c in enumerate(columns)]
        return out


def apply_types(
    df: DataFrame,
    report: DataFrame,
    force_numeric: list[str] | None = None,
    keep_text: list[str] | None = None,
    partners: list[tuple[str, str]] | None = None,
    lost: LostCells | None = None,
) -> DataFrame:
    """Project every text column to its reported type, technical columns first and intact.

    ``force_numeric`` columns become numeric whatever they hold; their values
    that are not numbers become NULL. Where such a column demands both number forms, each cell is
    read in its own; cells that fit both (``1.234``) are an error then. ``keep_text`` columns
    stay as they are, codes with leading zeros for example. Both have to name text columns of the
    table. A number too long for any decimal is an error that names its column.

    Of two ``partners``, columns that are to be merged, one without any value becomes
    numeric if the other is. ``lost`` counts cells that were not blank and become NULL.
    """
    forced, kept = check_named(df.columns, force_numeric, keep_text)
    found = {r["column"]: r for r in report.collect()}
    numeric = lambda n: n in forced or (n in found and found[n]["inferred_type"] == "numeric")
    blank = lambda n: n in found and n not in kept and found[n]["n_rows"] == found[n]["n_blank"]
    pairs = [p for a, b in partners or [] for p in ((a, b), (b, a))]
    forced |= {a for a, b in pairs if blank(a) and numeric(b)}
    targets = {n: _target(n, found.get(n), n in forced) for n in text_columns(df) if n not in kept}
    casts = {n: Cast(t, number_form_of(n, found.get(n), n in forced), n in forced) for n, t in targets.items() if t is not None}
    return convert(df, casts, lost)


def check_named(columns: list[str], force_numeric: list[str] | None, keep_text: list[str] | None) -> tuple[set[str], set[str]]:
    """The forced and the kept columns as sets; each has to exist, and none may be both."""
    forced, kept = set(force_numeric or []), set(keep_text or [])
    if forced & kept:
        raise ValueError(f"both forced numeric and kept as text: {sorted(forced & kept)}")
    if absent := (forced | kept) - set(columns):
        raise ValueError(f"no such columns: {sorted(absent)}")
    return forced, kept


class Cast(NamedTuple):
    """How to read a text column: its type, its number form, and whether other cells are let go."""

    dtype: T.DataType
    form: str = BRAZILIAN
    forced: bool = False


def convert(df: DataFrame, casts: dict[str, Cast], lost: LostCells | None = None, relation: str | None = None) -> DataFrame:
    """Read text columns as told, technical columns first."""
    technical, business = split_technical(df.columns)
    # Parsing looks at a cell several times; as a step of its own the trim runs once.
    cells = df.select(*[brazil.trimmed(col(n)).alias(n) if n in casts else col(n) for n in technical + business])
    parsed = lambda n: _parsed(col(n), casts[n])
    if lost is not None:
        cells = lost.watch(cells, {n: parsed(n).isNull() & ~brazil.is_blank(col(n)) for n in business if n in casts}, relation)
    return cells.select(*[parsed(n).alias(n) if n in casts else col(n) for n in technical + business])


def _target(name: str, entry, forced: bool) -> T.DataType | None:
    """Type to convert a column to; None leaves it as it is."""
    kind = "numeric" if forced else entry["inferred_type"] if entry else "text"
    if kind == "date":
        return T.DateType()
    if kind == "text":
        return None
    if entry is None:
        return brazil.NUMBER
    return exact_number(name, entry["integer_digits"], entry["fraction_digits"])


def exact_number(name: str, integer_digits: int, fraction_digits: int) -> T.DecimalType:
    dtype = number_type(integer_digits, fraction_digits)
    if dtype is None:
        raise ValueError(
            f"column {name!r} has numbers of {integer_digits} digits before and "
            f"{fraction_digits} after the decimal mark, more than a decimal holds; name it in keep_text"
        )
    return dtype


def number_form_of(name: str, entry, forced: bool = False) -> str:
    """The number form of a column; its cells demand both only if it is forced."""
    if not entry or not entry["n_plain_only"]:
        return BRAZILIAN
    if not entry["n_br_only"]:
        return PLAIN
    if forced and entry["n_ambiguous"]:
        raise ValueError(
            f"column {name!r} has numbers with a decimal comma, numbers with a decimal point, and "
            f"{entry['n_ambiguous']} cells such as 1.234 that can be either; keep it as text or type its parts one by one"
        )
    return MIXED


def _parsed(cell: Column, cast: Cast) -> Column:
    if not isinstance(cast.dtype, T.DecimalType):
        return brazil.cell_date(cell) if isinstance(cast.dtype, T.DateType) else _floating(cell, cast)
    if cast.form == MIXED:
        return brazil.cell_number(cell, cast.dtype)
    number = brazil.number_in_form(cell, cast.form, cast.dtype)
    return F.when(_in_form(cell, cast), number) if cast.forced else number  # else every cell has been seen to be a number or blank


def _in_form(cell: Column, cast: Cast) -> Column:
    return cell.rlike(brazil.PLAIN_NUMBER + r"|^-?\d+$" if cast.form == PLAIN else brazil.BR_NUMBER)


def _floating(cell: Column, cast: Cast) -> Column:
    number = brazil.plain_number(cell) if cast.form == MIXED else brazil.number_text_in_form(cell, cast.form)
    number = number.try_cast(cast.dtype)
    return F.when(_in_form(cell, cast), number) if cast.forced and cast.form != MIXED else number


def type_columns(
    df: DataFrame,
    force_numeric: list[str] | None = None,
    keep_text: list[str] | None = None,
    partners: list[tuple[str, str]] | None = None,
    lost: LostCells | None = None,
) -> DataFrame:
    """``infer_types`` and ``apply_types`` in one step."""
    names = [n for n in text_columns(df) if n not in set(keep_text or [])]
    return apply_types(df, infer_types(df, names), force_numeric, keep_text, partners, lost)
