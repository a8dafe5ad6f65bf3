"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its
size follows the text and two sketches merge by uniting them. A text with fewer than
``FLOOR`` hashes below the line keeps its ``FLOOR`` smallest instead; its line is then
the largest one kept (no line when every shingle is kept). Two sketches are compared
below the lower of their lines, where both are whole: the estimate is the share of
the smaller set that the other contains. Where the smaller side keeps nothing below that
line the estimate is 0: a text of n shingles inside a much longer one is missed so with a
probability of (1 - ``FRACTION``) ** n, 0.46 for 12 shingles, 0.20 for 25, 0.04 for 50.
:func:`united` (:func:`merged` in SQL) gives the sketch of two shingle sets together, the very one
that a text with both sets of shingles would have.

Format: the line as 16 hexadecimal digits, then the kept hashes in ascending order, 16
digits each. Equal texts have equal fingerprints.

Rows: null and empty texts have no hashes; two such texts are alike by 1, one such and
another by 0. Repeated rows stay; texts of one ``doc_id`` follow each other in order of
their text. An empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shingles import shingles
from strata.llm.support import row_slices, text_bytes

FRACTION = 1 / 16
FLOOR = 16
_ALL = (1 << 64) - 1
_SLICE = 1 << 20
RANGE_BYTES = 64 << 20


def sketches(data: np.ndarray, offsets: np.ndarray, fraction: float = FRACTION) -> list[np.ndarray]:
    """One array a text: the line, then the kept hashes in ascending order."""
    hashes, bounds = shingles(data, offsets)
    line = np.uint64(int(fraction * 2**64) - 1)
    low = hashes <= line
    kept_before = np.concatenate([[0], np.cumsum(low)])[bounds]
    kept = hashes[low]
    out = []
    for i in range(len(offsets) - 1):
        own = np.unique(kept[kept_before[i] : kept_before[i + 1]])
        top = line
        if len(own) < FLOOR:
            own = np.unique(hashes[bounds[i] : bounds[i + 1]])
            top = np.uint64(_ALL) if len(own) <= FLOOR else own[FLOOR - 1]
            own = own[:FLOOR]
        out.append(np.concatenate([[top], own]))
    return out


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller shingle set that the other set contains."""
    line = min(a[0], b[0])
    one, two = a[1:][a[1:] <= line], b[1:][b[1:] <= line]
    fewer = min(len(one), len(two))
    if not fewer:
        return float(len(a) == len(b) == 1)
    return float(len(np.intersect1d(one, two, assume_unique=True)) / fewer)


def united(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of two shingle sets together, from their sketches."""
    both, line = np.union1d(a[1:], b[1:]), np.uint64(int(fraction * 2**64) - 1)
    low = both[both <= line]
    if len(low) >= FLOOR:
        return np.concatenate([[line], low])
    whole = len(both) <= FLOOR and a[0] == b[0] == np.uint64(_ALL)
    top = np.uint64(_ALL) if whole else both[FLOOR - 1]
    return np.concatenate([[top], both[:FLOOR]])


def of_texts(texts: list[str], fraction: float = FRACTION) -> list[np.ndarray]:
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    return [s for a, b in row_slices(offsets, _SLICE) for s in sketches(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], fraction)]


def fingerprints(
    df: DataFrame, text: str = "text", fraction: float = FRACTION, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` and ``fingerprint``, one row a text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("__text"))
            for a, b in row_slices(offsets, _SLICE):
                base = int(offsets[a])
                found = sketches(data[base : int(offsets[b])], offsets[a : b + 1] - base, fraction)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array([written(s) for s in found], pa.string())],
                    names=[*keep, "fingerprint"],
                )

    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = source.select(*[f"`{c}`" for c in keep], F.lit("").alias("fingerprint")).schema
    return source.mapInArrow(run, schema)


def with_successor(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows in ascending order, dealt to ranges, each range closed by the first row of the next.

    Columns ``part`` (number of the range), ``closing``, ``doc_id``, ``text``. The text that
    follows the very last one is the very first. Range bounds are quantiles of the key; only
    one text a range travels twice.
    """
    spark = df.sparkSession
    ranges = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    numbers = rows.select(F.col("doc_id").cast("double").alias("x")).dropna()
    cuts = sorted(set(numbers.approxQuantile("x", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    dealt = rows.withColumn("__x", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) > 2:
        dealt = Bucketizer(splits=splits, inputCol="__x", outputCol="part").transform(dealt)
    else:
        dealt = dealt.withColumn("part", F.lit(0.0))
    dealt = dealt.select(F.col("part").cast("int").alias("part"), "doc_id", "text")
    used = sorted(r.part for r in dealt.select("part").distinct().collect())
    if not used:
        return dealt.select("part", F.lit(False).alias("closing"), "doc_id", "text")
    before = {p: used[i - 1] for i, p in enumerate(used)}
    first = dealt.groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("row"))
    chain = spark.createDataFrame(list(before.items()), "part int, closes int")  # two numbers a range
    closing = first.join(chain, "part").select(
        F.col("closes").alias("part"), F.lit(True).alias("closing"), "row.doc_id", "row.text"
    )
    whole = dealt.select("part", F.lit(False).alias("closing"), "doc_id", "text").union(closing)
    return whole.repartitionByRange("part").sortWithinPartitions("part", "closing", "doc_id", "text")


def compare_edited(df: DataFrame, key: str = "doc_id", text: str = "text", fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    The edited form has its last floor(n/4) code points replaced by as many from the start
    of the next text. Columns ``doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next``.
    """
    schema = (
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row so far: id, text, sketch, is a closing row
        for batch in batches:
            ids, closing = batch.column("doc_id").to_pylist(), batch.column("closing").to_pylist()
            _, offsets = text_bytes(batch.column("text"))
            for a, b in row_slices(offsets, _SLICE):
                texts = batch.column("text").slice(a, b - a).to_pylist()
                rows = list(zip(ids[a:b], texts, of_texts(texts, fraction), closing[a:b], strict=True))
                rows = rows if held is None else [held, *rows]
                held = rows[-1]
                pairs = [(one, two) for one, two in zip(rows, rows[1:], strict=False) if not one[3]]
                edited = [x[1][: len(x[1]) - len(x[1]) // 4] + y[1][: len(x[1]) // 4] for x, y in pairs]
                changed = of_texts(edited, fraction)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x, _ in pairs], pa.int64()),
                        pa.array([len(x[1]) for x, _ in pairs], pa.int64()),
                        pa.array(edited, pa.string()),
                        pa.array([written(x[2]) for x, _ in pairs], pa.string()),
                        pa.array([written(s) for s in changed], pa.string()),
                        pa.array([likeness(x[2], s) for (x, _), s in zip(pairs, changed, strict=True)], pa.float64()),
                        pa.array([likeness(x[2], y[2]) for x, y in pairs], pa.float64()),
                    ],
                    names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return with_successor(df, key, text).mapInArrow(run, schema)


def _kept(fingerprint: Column) -> Column:
    return F.regexp_extract_all(F.substr(fingerprint, F.lit(17)), F.lit("(.{16})"), 1)


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The fingerprint of two texts' shingles together, in SQL functions; as :func:`united`."""
    both = F.sort_array(F.array_union(_kept(a), _kept(b)))
    line, none = F.lit(f"{int(fraction * 2**64) - 1:016x}"), F.lit("f" * 16)
    low = F.filter(both, lambda x: x <= line)
    whole = (F.size(both) <= FLOOR) & (F.substring(a, 1, 16) == none) & (F.substring(b, 1, 16) == none)
    top = F.when(whole, none).otherwise(F.get(both, F.lit(FLOOR - 1)))
    few = F.concat(top, F.array_join(F.slice(both, 1, FLOOR), ""))
    return F.when(F.size(low) >= FLOOR, F.concat(line, F.array_join(low, ""))).otherwise(few)


def contained(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns, in SQL functions; as :func:`likeness`."""
    line = F.least(F.substring(a, 1, 16), F.substring(b, 1, 16))

    one, two = (F.filter(_kept(c), lambda x: x <= line) for c in (a, b))
    fewer = F.least(F.size(one), F.size(two))
    both_empty = (F.length(a) == 16) & (F.length(b) == 16)
    return F.when(fewer == 0, both_empty.cast("double")).otherwise(F.size(F.array_intersect(one, two)) / fewer)
