"""Spreadsheet tabs as CSV: read as text only, and written back one folder per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.brazil import number_text
from strata.functions.jsonx import complex_to_text
from strata.functions.names import col, family, qualified
from strata.operators.layers import list_tables
from strata.operators.union import union_relations
from strata.session import WRITERS, in_parallel

# How many file heads are read at once.
HEAD_READERS = 16
_GROUP = "__header"


def read_sheet(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = False,
    columns: list[str] | None = None,
    lenient: bool = False,
    by_name: bool = False,
) -> DataFrame:
    """Read exported tabs; every column is text and empty cells are NULL.

    Set ``multiline`` when cells hold line breaks; each file is then read by one task.
    Naming the ``columns`` avoids reading a header beforehand. All files of one call need
    the same header in the same order, and every row as many cells as the header; anything
    else is an error. ``lenient`` fills short rows and cuts long ones, but never mixes up
    headers.

    ``by_name`` reads files with different headers: the first lines of all files are read, files
    with the same one form a group, and the groups are put together by column name. A
    column that a group lacks is NULL there; columns stand in the order of their smallest position.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
    reader = reader.option("escape", '"').option("multiLine", multiline)
    reader = reader.option("mode", "PERMISSIVE" if lenient else "FAILFAST")
    if by_name:
        if columns is not None:
            raise ValueError("columns are found by name; do not name them as well")
        groups = header_groups(spark, path)
        if not groups:
            raise ValueError(f"no file with a header in {path!r}")
        parts = [(str(i), reader.csv(files)) for i, files in enumerate(groups.values())]
        return union_relations(spark, parts, _GROUP).drop(_GROUP)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in columns]))
    return reader.csv(path)


def header_groups(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The files below the paths by their first line; empty and hidden files are left out.

    Only the heads are read, by a few threads of the driver: a buffer of each file, whatever its size.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def files_below(one: str) -> list[str]:
        pattern = jvm.org.apache.hadoop.fs.Path(one)
        system = pattern.getFileSystem(conf)
        found = system.globStatus(pattern)
        if not found:
            raise ValueError(f"no such path: {one!r}")
        out = []
        for status in found:
            files = system.listFiles(status.getPath(), True)
            while files.hasNext():
                file = files.next()
                below = file.getPath().toString().removeprefix(status.getPath().toString()).split("/")
                if file.getLen() and not any(part.startswith(("_", ".")) for part in (*below, file.getPath().getName())):
                    out.append(file.getPath().toString())
        return out

    def head(file: str) -> str | None:
        at = jvm.org.apache.hadoop.fs.Path(file)
        stream, codec = at.getFileSystem(conf).open(at), codecs.getCodec(at)
        try:
            plain = stream if codec is None else codec.createInputStream(stream)
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()

    names = sorted({f for one in ([path] if isinstance(path, str) else path) for f in files_below(one)})
    groups: dict[str, list[str]] = {}
    for file, line in zip(names, in_parallel(spark, head, names, HEAD_READERS), strict=True):
        if line is not None:
            groups.setdefault(line, []).append(file)
    return groups


def write_sheet(df: DataFrame, path: str) -> None:
    """Write a table as text with a header, replacing what was there."""
    text = df.select(*[_cell(f).alias(f.name) for f in df.schema.fields])
    writer = text.write.mode("overwrite").option("header", True).option("escape", '"')
    # Blanks at the ends of a cell belong to the cell.
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    writer.csv(path)


def _cell(field: T.StructField) -> Column:
    if family(field.dataType) == "number":
        return number_text(col(field.name), field.dataType)
    return complex_to_text(field.name, field.dataType)


def export_layer(
    spark: SparkSession,
    database: str,
    folder: str,
    exclude: tuple[str, ...] | list[str] = (),
    threads: int = WRITERS,
) -> list[str]:
    """Export every table of a database to ``folder/<table>``; returns the table names."""

    def export(table: str) -> str:
        write_sheet(spark.table(qualified(database, table)), f"{folder.rstrip('/')}/{table}")
        return table

    return in_parallel(spark, export, list_tables(spark, database, exclude), threads)
