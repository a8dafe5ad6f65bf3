"""Mix sources to target weights by systematic sampling.

The size of a document is its number of words. A source's target is its share, by
weight, of the wanted total, at most ``cap`` times the source's size; what exceeds is
shared again by weight until no target is above its cap. Within a source every document
expects target / size copies. Documents stand in order of size, then of a hash of their
id; the expected copies are summed along that order, one random offset a source is
added, and a copy is emitted for every whole number that the sum crosses. Ordering by
size makes the words taken come within a document or so of the target.

The sum up to a document is its rank times the expected copies, so only ranks have to be
found: rows are dealt to ranges of the order, counted by range and source, and numbered
within their range. No source meets in one task.

Rows: null text has size 0; null source is a source, the last one. Sources and documents
of size 0 are never taken. Equal rows are numbered one after the other, so each gets its
own share of copies. Offsets and order are hashes of ids and a seed: reruns agree. An
empty table gives an empty table. Extra columns stay in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.support import row_key, settle

WEIGHTS = (5, 2, 1)
CAP = 3


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(value: Column, seed: str) -> Column:
    """A number in [0, 1) that a text and the seed fix."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), value).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add ``target`` to one row a source (``source``, ``source_size``).

    Capped targets belong to the sources with the lowest cap a weight. With sources in that
    order, the level of the rest is what the capped ones leave, divided by the weight that
    remains; the first source whose level is within its cap fixes it. The windows without a
    key hold one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, len(weights)) + 1).cast("int")
    )
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
    rows = rows.withColumn("turn", F.col("limit") / F.col("weight"))
    rise = Window.orderBy("turn", F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy())
    earlier = F.coalesce(F.sum("limit").over(rise.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(rise.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (total - earlier) / rest).withColumn("place", F.row_number().over(rise))
    level = F.min_by("level", F.when(F.col("level") <= F.col("turn"), F.col("place"))).over(Window.partitionBy())
    return rows.select("source", "source_size", F.least("limit", level * F.col("weight")).alias("target"))


def copies_plan(
    df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = "mix",
) -> DataFrame:
    """One row a document: ``row_key, doc_id, size, source, source_size, target, rank, expected, offset, copies``."""
    base = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        row_key(F.col(f"`{doc_id}`"), F.col(f"`{source}`"), F.col(f"`{text}`")).alias("row_key"),
    )
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    chance = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).cast("binary"))
    base = base.withColumn("name", name).withColumn("chance", chance)
    place = ["name", "size", "chance", "row_key"]
    ranged = settle(base.repartitionByRange(*place).withColumn("range", F.spark_partition_id()))

    counts = ranged.groupBy("range", "name").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", "name", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    sizes = ranged.groupBy("name").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    by_source = targets(sizes, weights, cap).withColumn("name", name)
    by_source = by_source.withColumn("expected", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    by_source = by_source.withColumn("offset", _uniform(F.col("name"), seed)).drop("source")

    own = Window.partitionBy("range", "name").orderBy("size", "chance", "row_key")
    # Both small tables hold a row for each source, or for each source and range.
    numbered = (
        ranged.withColumn("place", F.row_number().over(own))
        .join(starts.join(by_source, "name"), ["range", "name"])
        .withColumn("rank", F.col("start") + F.col("place"))
    )
    return numbered.withColumn("copies", crossed(F.col("rank"))).select(
        "row_key", "doc_id", "size", "source", "source_size", "target", "rank", "expected", "offset", "copies"
    )


def crossed(rank: Column) -> Column:
    """Whole numbers that offset + rank * expected crosses at this rank."""
    upto = lambda r: F.floor(F.col("offset") + r * F.col("expected"))
    return (upto(rank) - upto(rank - 1)).cast("long")


def mix(
    df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = "mix",
) -> DataFrame:
    """The mixed documents with the columns of ``df``: each row as often as it is taken."""
    plan = copies_plan(df, doc_id, source, text, weights, cap, seed)
    # Equal rows share a key; their ranks follow each other.
    by_key = plan.groupBy(F.col("row_key").alias("__key")).agg(
        F.min("rank").alias("__rank"), F.sum("copies").alias("__all"), F.first("expected").alias("expected"),
        F.first("offset").alias("offset"),
    ).filter("__all > 0")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"),
        row_key(F.col(f"`{doc_id}`"), F.col(f"`{source}`"), F.col(f"`{text}`")).alias("__key"),
    )
    same = Window.partitionBy("__key").orderBy("__key")
    taken = rows.join(by_key, "__key").withColumn("__rank", F.col("__rank") + F.row_number().over(same) - 1)
    taken = taken.withColumn("__copies", crossed(F.col("__rank"))).filter("__copies > 0")
    many = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return many.select(*[F.col("__row")[c].alias(c) for c in df.columns])
