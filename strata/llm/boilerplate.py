"""Drop lines that stand on too large a share of their host's pages.

For each host, the pages that contain a line are divided by all pages of the host. A
line above ``ratio``, and on ``least_pages`` pages at least (2: a line of one page is no repeat),
is boilerplate of that host and leaves all its pages. Lines are compared without the white space around them; lines
of white space alone are never dropped.

Plan: lines become 64-bit hashes within their page, each once, and are counted by host
and hash with a partial aggregate, so a line that is everywhere arrives as one row a
task. Pages that hold boilerplate are found by a join on host and hash, then the pages'
texts are filtered in one projection. Everything is SQL functions.

Rows: null text stays null, with no lines. A null host is a host. Equal rows (same host,
id and text) count as one page each and stay. Extra columns stay; columns with the names
of the outputs (``n_lines``, ``n_dropped``) are replaced. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.support import row_key

RATIO = 0.1
LEAST_PAGES = 2
_BLANK = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hash(line: Column) -> Column:
    """The hash of a line without white space around it; null for a blank line."""
    core = F.btrim(line, F.lit(_BLANK))
    return F.when(core != "", F.xxhash64(core))


def _holds(ordered: Column, value: Column) -> Column:
    """Whether an ascending array holds a value, by halving: a long page may lose very many lines."""
    steps = F.array(*[F.lit(1 << i) for i in range(30, -1, -1)])
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(ordered, at + step) <= value, at + step).otherwise(at))
    return F.coalesce(F.get(ordered, place) == value, F.lit(False))


def boilerplate(
    df: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """The dropped lines: ``host, line`` (hash), ``pages, of_pages``."""
    page = df.select(_name(F.col(f"`{host}`")).alias("host"), F.col(f"`{text}`").alias("__text"))
    hashes = F.array_distinct(F.filter(F.transform(_lines(F.col("__text")), _hash), lambda h: h.isNotNull()))
    counted = page.select("host", F.explode(hashes).alias("line")).groupBy("host", "line")
    counted = counted.agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= least_pages)
    totals = page.groupBy("host").agg(F.count(F.lit(1)).alias("of_pages"))
    return counted.join(totals, "host").filter(F.col("pages") > F.lit(float(ratio)) * F.col("of_pages"))


def _name(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("-"))


def drop_boilerplate(
    df: DataFrame, host: str = "source", text: str = "text", doc_id: str = "doc_id",
    ratio: float = RATIO, least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``df`` with ``text`` cleared of its host's boilerplate, and ``n_lines``, ``n_dropped`` (long)."""
    out = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    key = row_key(F.col(f"`{doc_id}`"), F.col(f"`{host}`"), F.col(f"`{text}`"))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in out if c != text] or [F.lit(0)]).alias("__row"),
        F.col(f"`{text}`").alias("__text"), key.alias("__key"),
    )
    held = df.select(key.alias("__key"), _name(F.col(f"`{host}`")).alias("host"), F.col(f"`{text}`").alias("__text"))
    hashes = F.array_distinct(F.filter(F.transform(_lines(F.col("__text")), _hash), lambda h: h.isNotNull()))
    held = held.select("__key", "host", F.explode(hashes).alias("line"))
    bad = boilerplate(df, host, text, ratio, least_pages).select("host", "line")
    # At most as many hashes as the page has lines.
    drops = held.join(bad, ["host", "line"]).groupBy("__key").agg(F.sort_array(F.collect_set("line")).alias("__drop"))
    joined = rows.join(drops, "__key", "left")
    lines = _lines(F.col("__text"))
    kept = F.filter(lines, lambda line: ~_holds(F.col("__drop"), _hash(line)))
    joined = joined.withColumn("__kept", F.when(F.col("__drop").isNotNull(), kept).otherwise(lines))
    n_lines = F.when(F.col("__text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_kept = F.when(F.col("__text").isNull(), 0).otherwise(F.size("__kept")).cast("long")
    return joined.select(
        *[F.array_join("__kept", "\n").alias(c) if c == text else F.col("__row")[c].alias(c) for c in out],
        n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"),
    )
