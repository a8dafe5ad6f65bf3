"""Pages of a JSON entity service: one document per page, entities in a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import check_case_collisions

# Fixed value: the member of a page that holds its entities.
ENTITIES = "value"
CORRUPT = "_unreadable_page"

# More fields than this are taken for data in the place of names.
MOST_FIELDS = 2000


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    multiline: bool = False,
    lenient: bool = False,
    most_fields: int = MOST_FIELDS,
) -> DataFrame:
    """Read the entities of all pages, one row each.

    ``schema`` gives the wanted fields; a field typed as string keeps nested
    objects and lists as JSON text. Without a schema, a first pass collects the
    field names and every field is text; more than ``most_fields`` names are an error, as names
    that depend on the data make a table without bounds. ``multiline`` is for pages spread over
    several lines, one page per file.

    A page that is no JSON, that has no list of entities, or that holds a value which does not
    fit its type is an error when it is read. ``lenient`` leaves such pages out instead;
    :func:`rejected_pages` counts them.
    """
    fields = _as_struct(schema) if schema is not None else discover_fields(spark, path, multiline, most_fields)
    check_case_collisions(fields.names)
    pages = _read(spark, path, T.ArrayType(fields), multiline)
    if lenient:
        return pages.filter(~_bad()).select(F.inline(ENTITIES))
    fault = F.raise_error(F.concat(F.lit("not a page of entities: "), F.coalesce(F.left(F.col(CORRUPT), F.lit(200)), F.lit("no list"))))
    checked = F.when(_bad(), fault.cast(T.ArrayType(fields))).otherwise(F.col(ENTITIES))
    return pages.select(F.inline(checked))


def rejected_pages(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """One row: ``n_pages`` and, among them, ``n_rejected`` that lenient reading leaves out."""
    fields = _as_struct(schema) if schema is not None else discover_fields(spark, path, multiline)
    pages = _read(spark, path, T.ArrayType(fields), multiline)
    return pages.agg(F.count("*").alias("n_pages"), F.count_if(_bad()).alias("n_rejected"))


def _bad() -> Column:
    return F.col(CORRUPT).isNotNull() | F.col(ENTITIES).isNull()


def _read(spark, path, entities: T.DataType, multiline: bool) -> DataFrame:
    page = T.StructType([T.StructField(ENTITIES, entities), T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(page).option("multiLine", multiline)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def _as_struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def discover_fields(spark: SparkSession, path: str | list[str], multiline: bool = False, most_fields: int = MOST_FIELDS) -> T.StructType:
    """The field names of all entities, by smallest position, each as text.

    Every task counts names with their positions, and the counts of all tasks are merged by
    name; the driver reads no more than one name above ``most_fields``, and raises then.
    An entity that is too wide by itself already ends the task that reads it.
    """
    raw = _read(spark, path, T.ArrayType(T.StringType()), multiline)
    entity = raw.select(F.explode(ENTITIES).alias("entity")).select(F.json_object_keys("entity").alias("names"))
    fault = F.concat(F.lit(f"an entity has more than {most_fields} fields, among them "), F.array_join(F.slice("names", 1, 3), ", "))
    checked = F.when(F.size("names") > most_fields, F.raise_error(fault).cast("array<string>")).otherwise(F.col("names"))
    merged = entity.select(F.posexplode(checked).alias("position", "name")).groupBy("name").agg(F.min("position").alias("position"))
    ordered = merged.limit(most_fields + 1).collect()
    if len(ordered) > most_fields:
        some = ", ".join(sorted(r.name for r in ordered)[:5])
        raise ValueError(f"the pages in {path!r} have more than {most_fields} different fields, such as {some}; give a schema")
    ordered.sort(key=lambda r: (r.position, r.name))
    return T.StructType([T.StructField(r.name, T.StringType()) for r in ordered])
