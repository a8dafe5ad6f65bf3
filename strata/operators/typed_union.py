"""Union of relations whose text columns are read in the notation of each relation.

One relation writes ``1.234`` for a thousand and more, another for one and a quarter; a third
holds real numbers. Put together first, they cannot be told apart any more. So the cells are
counted by relation and column, in one aggregate over all relations; every relation is read in its
own number form, and only then do the columns meet in a common type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.brazil import number_text
from strata.functions.names import check_case_collisions, col, family, split_technical
from strata.operators.typing_text import (
    MIXED,
    PLAIN,
    Cast,
    LostCells,
    check_named,
    convert,
    count_forms,
    exact_number,
    number_form_of,
)
from strata.operators.union import SOURCE_COLUMN, common_type, decimal_digits, merged_schema, union_all, union_relations

# A double gives back every decimal number of so many digits.
DOUBLE_DIGITS = 15

_NUMERIC, _DATE, _TEXT, _BLANK = "numeric", "date", "text", "blank"


def relation_forms(spark: SparkSession, relations: list[tuple[str, DataFrame]], keep_text: list[str] | None = None) -> DataFrame:
    """``relation, column`` and the counts of ``count_forms`` for all text columns of all relations, in one job."""
    kept = set(keep_text or [])
    cells = []
    for i, (_, df) in enumerate(relations):
        names = [n for n in split_technical(df.columns)[1] if isinstance(df.schema[n].dataType, T.StringType) and n not in kept]
        if names:
            cells.append(df.unpivot([], [col(n) for n in names], "column", "value").select(F.lit(i).alias("relation"), "column", "value"))
    if not cells:
        empty = spark.createDataFrame([], "relation int, column string, value string")
        return count_forms(empty, ["relation", "column"])
    return count_forms(union_all(cells), ["relation", "column"])


def union_typed(
    spark: SparkSession,
    relations: list[tuple[str, DataFrame]],
    source_column: str = SOURCE_COLUMN,
    force_numeric: list[str] | None = None,
    keep_text: list[str] | None = None,
    partners: list[tuple[str, str]] | None = None,
    lost: LostCells | None = None,
) -> DataFrame:
    """``union_relations`` with typed columns, each relation read in its own number form.

    A column becomes numeric (a date) when it holds numbers (dates) in every relation that has
    any value in it, as text or typed. Decimals are wide enough for all digits of all relations;
    with floating point in some relation the column is a double, which is an error if other
    relations have numbers that a double does not give back. 64-bit whole numbers and
    floating point meet in a decimal. Everything else is as in ``union_relations``, and
    ``force_numeric``, ``keep_text``, ``partners`` and ``lost`` are those of ``apply_types``.
    The counts that the driver reads are a row for each text column of each relation.
    """
    if not relations:
        return union_relations(spark, relations, source_column)
    schema = merged_schema([df.schema for _, df in relations])
    check_case_collisions([source_column, *schema.names])
    forced, kept = check_named(schema.names, force_numeric, keep_text)
    as_text = {n for n in split_technical(schema.names)[1] if n not in kept and _digits_at_stake([df for _, df in relations], n)}
    typed = [{n for n in as_text if n in df.columns} for _, df in relations]
    frames = [_with_text(df, names) for (_, df), names in zip(relations, typed, strict=True)]
    named = [(name, df) for (name, _), df in zip(relations, frames, strict=True)]
    counts = relation_forms(spark, named, sorted(kept)).collect()
    entries = {(r["relation"], r["column"]): r for r in counts}
    kinds = {n: _kinds(frames, entries, n) for n in split_technical(schema.names)[1] if n not in kept}
    pairs = [p for a, b in partners or [] for p in ((a, b), (b, a)) if a in kinds and b in kinds]
    numeric = lambda n: n in forced or set(kinds[n].values()) - {_BLANK} == {_NUMERIC}
    forced |= {a for a, b in pairs if set(kinds[a].values()) == {_BLANK} and numeric(b)}
    casts: list[dict[str, Cast]] = [{} for _ in frames]
    for n, found in kinds.items():
        seen = set(found.values()) - {_BLANK}
        if n in forced or seen == {_NUMERIC}:
            dtype = _number(n, frames, entries, typed, n in forced)
            for i, df in enumerate(frames):
                if n in df.columns and isinstance(df.schema[n].dataType, T.StringType):
                    form = PLAIN if n in typed[i] else number_form_of(n, entries.get((i, n)), n in forced)
                    casts[i][n] = Cast(dtype, form, n in forced)
        elif seen == {_DATE}:
            for i, df in enumerate(frames):
                if n in df.columns and isinstance(df.schema[n].dataType, T.StringType):
                    casts[i][n] = Cast(T.DateType())
    # A column that stays text gets the text form of unions, from its own type.
    parts = [(name, convert(_with_text(df, typed[i] & set(casts[i])), casts[i], lost, name)) for i, (name, df) in enumerate(relations)]
    return union_relations(spark, parts, source_column)


def _with_text(df: DataFrame, names: set[str]) -> DataFrame:
    """``df`` with some number columns as text with a decimal point."""
    return df.select(*[_all_digits(col(n), df.schema[n].dataType).alias(n) if n in names else col(n) for n in df.columns])


def _all_digits(value: Column, dtype: T.DataType) -> Column:
    """Number as text with a decimal point and without an exponent, where its shortest form fits a decimal."""
    if not isinstance(dtype, (T.FloatType, T.DoubleType)):
        return value.cast("string")
    exact = value.cast("string").try_cast(T.DecimalType(38, 18))
    digits = F.regexp_replace(F.regexp_replace(exact.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(exact.cast(dtype) == value, digits).otherwise(number_text(value, dtype))


def _number_types(frames: list[DataFrame], name: str) -> list[T.DataType]:
    return [df.schema[name].dataType for df in frames if name in df.columns and family(df.schema[name].dataType) == "number"]


def _digits_at_stake(frames: list[DataFrame], name: str) -> bool:
    """True for number columns whose types no common one holds."""
    types = _number_types(frames, name)
    return bool(types) and isinstance(common_type(types), T.StringType)


def _kinds(frames: list[DataFrame], entries: dict, name: str) -> dict[int, str]:
    """What each relation holds in a column."""
    out = {}
    for i, df in enumerate(frames):
        if name not in df.columns:
            continue
        dtype, entry = df.schema[name].dataType, entries.get((i, name))
        if not isinstance(dtype, T.StringType):
            out[i] = {"number": _NUMERIC, "date": _DATE}.get(family(dtype), _TEXT)
        elif entry is None or entry["n_rows"] == entry["n_blank"]:
            out[i] = _BLANK
        else:
            out[i] = entry["inferred_type"]
    return out


def _number(name: str, frames: list[DataFrame], entries: dict, typed: list[set[str]], forced: bool) -> T.DataType:
    """The type that holds the numbers of all relations."""
    whole = fraction = 0
    for i in range(len(frames)):
        entry = entries.get((i, name))
        if entry is not None and entry["n_numeric"]:
            form = PLAIN if name in typed[i] else number_form_of(name, entry, forced)
            part = "own" if form == MIXED else form
            whole, fraction = max(whole, entry[f"{part}_whole"]), max(fraction, entry[f"{part}_fraction"])
    types = _number_types(frames, name)
    if not types:
        return exact_number(name, whole, fraction)
    common = common_type(types)
    if isinstance(common, (T.FloatType, T.DoubleType)):
        if whole + fraction > DOUBLE_DIGITS:
            raise ValueError(f"column {name!r} is floating point in one relation and has numbers of {whole + fraction} digits in another")
        return T.DoubleType()
    own_whole, own_fraction = decimal_digits(common)
    return exact_number(name, max(whole, own_whole), max(fraction, own_fraction))
