"""A Merkle manifest of a dataset: digests of rows, of groups of rows, and of the whole.

Every row is a leaf. Within a group the leaves stand in order; while more than one node
remains, each ``FANOUT`` consecutive ones (the last run may be shorter, even one) become the
SHA-256 of their concatenated hexadecimal digests. What remains is the group's subroot, and
the subroots, in order of their groups, give the root in the same way.

Checkpoint and recompute: only every ``STEP``-th level is written, beside the leaves. A
subtree between two written levels has at most ``FANOUT ** STEP`` leaves, aligned to
multiples of that number. A proof is made from the top: the stored descendants of each subtree meet
in one row, its levels between are computed again, the siblings of each descendant are read
off, put before those of the subtree's own root, and the levels are forgotten. So no task ever
holds more than one subtree a row, however large a group is.

Positions come from a range sort over (group, order, digest): rows are numbered in their
range and the counts of ranges are summed, so no group meets in one task.

Rows: null values are ``-`` in a leaf, so null and empty differ; null groups and keys come
first. Rows equal in all hashed columns have the same leaf and stand side by side. An empty
table gives empty proofs. Columns that are not named are not hashed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import scratch_dir

FANOUT = 8
STEP = 3
SIBLINGS = "array<struct<left: string, right: string>>"
_TOP = "*"


@dataclass(frozen=True)
class Manifest:
    """A written manifest: its folder and how many levels are stored for the groups and above them."""

    spark: SparkSession
    folder: str
    rounds: int
    top_rounds: int

    def stored(self, tree: str, level: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{tree}-{level * STEP}")


def group_name(group: Column) -> Column:
    """A name without nulls that sorts like the group, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of a row: for each value its UTF-8 byte count, a colon and the value, or ``-``."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(proof, digest, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def siblings_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def build(
    rows: DataFrame, group: Column, order: Column, digest: Column, carry: dict[str, Column] | None = None, folder: str | None = None
) -> Manifest:
    """Write the manifest of ``rows`` to ``folder`` (a fresh one in the shared folder by default).

    ``digest`` is a leaf, see :func:`leaf`; ``order`` sorts the leaves of a group, nulls first,
    ties by digest. ``carry`` names small columns that proofs shall return with a leaf.
    """
    spark = rows.sparkSession
    folder = (folder or scratch_dir(spark, "manifest")).rstrip("/")
    carried = [c.alias(n) for n, c in (carry or {}).items()]
    leaves = rows.select(group_name(group).alias("group"), order.alias("order"), F.unhex(digest).alias("digest"), *carried)
    rounds = _grow(spark, _written(leaves, f"{folder}/leaves"), folder, "rows")
    subroots = spark.read.parquet(f"{folder}/rows-{rounds * STEP}")
    above = subroots.select(F.lit(_TOP).alias("group"), F.col("group").alias("order"), "digest", F.col("group").alias("name"))
    return Manifest(spark, folder, rounds, _grow(spark, above, folder, "groups"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _grow(spark: SparkSession, leaves: DataFrame, folder: str, tree: str) -> int:
    """Write the levels of a tree for each group; returns how many are stored above the leaves."""
    nodes = _written(_numbered(leaves, f"{folder}/{tree}-sorted"), f"{folder}/{tree}-0")
    largest = nodes.agg(F.max("size")).first()[0] or 1
    done = 0
    while FANOUT ** (done * STEP) < largest:
        blocks = _levels(nodes.select("group", "size", "position", "digest"), done, [])
        up = blocks.select("group", "size", F.col("block").alias("position"), F.unhex(F.element_at(f"level{STEP}", 1)).alias("digest"))
        done += 1
        nodes = _written(up, f"{folder}/{tree}-{done * STEP}")
    return done


def _numbered(leaves: DataFrame, path: str) -> DataFrame:
    """Add ``position`` (from 0) within the group and ``size``, the leaves of the group."""
    # Equal rows are interchangeable; the last key lets the ranges divide them.
    keys = ["group", "order", "digest", "tie"]
    ranged = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    fixed = _written(ranged.drop("tie").withColumns({"range": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), path)
    counts = fixed.groupBy("group", "range").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    ranges = Window.partitionBy("group").orderBy("range")  # a row for each range that holds some of the group
    before = F.coalesce(F.sum("n").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(
        "group", "range", (before - F.col("first")).alias("shift"),
        F.sum("n").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("size"),
    )
    placed = fixed.join(starts, ["group", "range"]).withColumn("position", F.col("row") + F.col("shift"))
    return placed.drop("range", "row", "shift", "order")


def _height(size: Column) -> Column:
    """How many levels stand above a group's leaves: the digits of size - 1 in base ``FANOUT``."""
    return F.when(size > 1, F.length(F.conv((size - 1).cast("string"), 10, FANOUT))).otherwise(0)


def _up(nodes: Column) -> Column:
    """The level above an array of digests."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / FANOUT).cast("int") - 1)
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FANOUT + 1, F.lit(FANOUT)), ""), 256))


def _levels(nodes: DataFrame, done: int, extra: list[str]) -> DataFrame:
    """One row a subtree: its stored ``entries`` in order and the levels above them, ``level0`` to ``level{STEP}``."""
    entry = F.struct("position", "digest", *extra)
    blocks = nodes.groupBy("group", "size", F.expr(f"position div {FANOUT ** STEP}").alias("block")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    blocks = blocks.select(
        "*", F.least(F.lit(STEP), F.greatest(F.lit(0), _height(F.col("size")) - done * STEP)).alias("climb"),
        F.transform("entries", lambda e: F.lower(F.hex(e["digest"]))).alias("level0"),
    )
    for t in range(STEP):
        blocks = blocks.withColumn(f"level{t + 1}", F.when(F.col("climb") > t, _up(F.col(f"level{t}"))).otherwise(F.col(f"level{t}")))
    return blocks


def _opened(nodes: DataFrame, above: DataFrame, done: int, extra: list[str], passed: list[str]) -> DataFrame:
    """The proofs of stored nodes from those of the subtrees' roots (``group, position, proof`` and ``passed``)."""
    blocks = _levels(nodes, done, extra)
    roots = above.select("group", F.col("position").alias("block"), F.col("proof").alias("rest"), *passed)
    rows = blocks.join(roots, ["group", "block"]).select("*", F.posexplode("entries").alias("at", "entry"))
    steps = []
    for t in range(STEP):
        place = F.floor(F.col("at") / FANOUT**t).cast("int")
        start = place - place % FANOUT
        left = F.slice(f"level{t}", start + 1, place - start)
        right = F.slice(f"level{t}", place + 2, start + (FANOUT - 1) - place)
        steps.append(F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right")))
    proof = F.concat(F.slice(F.array(*steps), F.lit(1), F.col("climb")), F.col("rest")).alias("proof")
    own = [F.col("entry")[c].alias(c) for c in extra]
    return rows.select("group", F.col("entry.position").alias("position"), F.col("entry.digest").alias("digest"), *own, proof, *passed)


def read(spark: SparkSession, folder: str) -> Manifest:
    """A manifest that :func:`build` has written."""
    folder = folder.rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
    levels = lambda tree: max(int(n.split("-")[1]) for n in names if n.split("-")[0] == tree and n.split("-")[1].isdigit())
    return Manifest(spark, folder, levels("rows") // STEP, levels("groups") // STEP)


def root(manifest: Manifest) -> str | None:
    """The root in lowercase hexadecimal; None for a dataset without rows."""
    row = manifest.stored("groups", manifest.top_rounds).select(_hex("digest")).first()
    return row and row[0]


def proofs(manifest: Manifest, wanted: Column | None = None) -> DataFrame:
    """One row a leaf: carried columns, ``leaf``, ``subroot``, ``root`` and ``proof``, the siblings at each level.

    ``wanted``, a condition on the carried columns, asks for some leaves only; then only the
    lowest subtrees that hold one are computed again.
    """
    top = manifest.stored("groups", manifest.top_rounds)
    above = top.select("group", "position", F.expr(f"cast(array() AS {SIBLINGS})").alias("proof"), _hex("digest").alias("root"))
    groups = _descend(manifest, "groups", manifest.top_rounds, above, ["name"], ["root"])
    above = groups.select(
        F.col("name").alias("group"), F.lit(0).cast("long").alias("position"), "proof", _hex("digest").alias("subroot"), "root"
    )
    carried = [c for c in manifest.stored("rows", 0).columns if c not in ("group", "size", "position", "digest")]
    rows = _descend(manifest, "rows", manifest.rounds, above, carried, ["subroot", "root"], wanted)
    return rows.select(*carried, _hex("digest").alias("leaf"), "subroot", "root", "proof")


def _hex(name: str) -> Column:
    return F.lower(F.hex(name))


def _descend(
    manifest: Manifest, tree: str, rounds: int, above: DataFrame, extra: list[str], passed: list[str], wanted: Column | None = None
) -> DataFrame:
    """From the proofs of the highest stored nodes to those of the leaves."""
    if not rounds:  # every group is one leaf
        leaves = manifest.stored(tree, 0).select("group", "position", "digest", *extra)
        above = leaves.join(above, ["group", "position"])
    for level in reversed(range(rounds)):
        nodes = manifest.stored(tree, level)
        if wanted is not None and not level:
            block = F.expr(f"position div {FANOUT**STEP}")
            asked = nodes.filter(wanted).select("group", block.alias("block")).distinct()
            nodes = nodes.withColumn("block", block).join(asked, ["group", "block"], "left_semi").drop("block")
        above = _opened(nodes, above, level, extra if not level else [], passed)
    return above if wanted is None else above.filter(wanted)
