"""Exact top-k by inner product with block-at-a-time pruning.

Vectors of whole numbers are put into blocks of consecutive ids. A block carries a
forward index (its vectors as one matrix) and the largest and smallest value of each
term (component). The bound of a query on a block is the sum of its terms' best values:
the largest where the query's weight is positive, the smallest where it is negative. A
query takes blocks in descending order of bound and stops when the next bound falls below
its k-th score so far (a bound equal to it is still scored, for ties on ids).

Blocks are dealt to groups of ``GROUP`` blocks and queries to chunks, in two passes:

1. Bounds need only the block maxima, not the vectors. Each query goes to the group of its best
   bound alone and is searched there; its k-th score is a threshold for all other groups.
2. A query goes on to the groups with a bound that reaches its threshold, and starts there with
   it. The k best of all groups are merged by query.

Every chunk meets a group, or ``SUMMARY`` groups' maxima, in one task of bounded size; vectors
travel only to chunks with a query for their group. Scores that 64 bits cannot hold are an error.

Rows: vectors that are null, empty, or hold null or non-finite components take no part.
Shorter vectors count as filled up with zeros. Of repeated ids a query is asked once, with the
smallest vector, and no row with the query's own id is a candidate; other repeated rows are candidates each.
Ties go to the smaller id. Null ids take no part. Extra columns are not read. An empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.support import settle

BLOCK = 512
GROUP = 32
CHUNK = 1024
SUMMARY = 128
_FOUND = "query_id long, vec_id long, score long"
_NONE = 1 - 2**63  # its negative is a 64-bit number too


def whole_numbers(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, x as double; null unless all are finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(vector) > 0) & ~bad, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _exact(*matrices: np.ndarray) -> list[np.ndarray]:
    """Vectors to be asked, then others: as doubles, which multiply fast, where sums stay below 2**53."""
    asked, *others = matrices
    most = max(int(np.abs(m).max(initial=0)) for m in others) * int(np.abs(asked).max(initial=0)) * asked.shape[1]
    if most >= -_NONE:
        raise OverflowError("scores of these vectors may not fit into 64 bits; use a smaller scale")
    return [m.astype(np.float64) for m in matrices] if most < 2**53 else list(matrices)


def _bounds(asked: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T


def _blocks(base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the blocks, and the largest and smallest values of their terms."""
    starts = np.arange(0, len(base), BLOCK)
    return starts, np.maximum.reduceat(base, starts, axis=0), np.minimum.reduceat(base, starts, axis=0)


def _summary(rows: pd.DataFrame) -> pd.DataFrame:
    """The block maxima of one group."""
    rows = rows.sort_values("vec_id", kind="stable")
    _, high, low = _blocks(_matrix(rows["vector"], rows["vector"].map(len).max()))
    return pd.DataFrame({"g": rows["g"].iloc[0], "high": list(high), "low": list(low)})


def _group_bounds(queries: pd.DataFrame, summaries: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of groups, and each query's best bound in them."""
    summaries = summaries.sort_values("g", kind="stable")
    width = max(queries["vector"].map(len).max(), summaries["high"].map(len).max())
    asked, high, low = _exact(*(_matrix(v, width) for v in (queries["vector"], summaries["high"], summaries["low"])))
    groups, first = np.unique(summaries["g"].to_numpy(), return_index=True)
    return groups, np.maximum.reduceat(_bounds(asked, high, low), first, axis=1)


def _search(queries: pd.DataFrame, rows: pd.DataFrame, k: int, least: np.ndarray | None = None) -> tuple[pd.DataFrame, int]:
    """The k best rows of one group for each query of one chunk, and how many blocks were scored for a query.

    ``least`` has the score of each query below which nothing is of use.
    """
    width = max(queries["vector"].map(len).max(), rows["vector"].map(len).max())
    rows = rows.sort_values("vec_id", kind="stable")
    ids, qids = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    asked, base = _exact(_matrix(queries["vector"], width), _matrix(rows["vector"], width))
    starts, high, low = _blocks(base)
    bounds = _bounds(asked, high, low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    none = -np.inf if base.dtype.kind == "f" else _NONE
    needed = np.full(len(qids), none, base.dtype)
    if least is not None:
        needed = np.maximum(least.astype(base.dtype), needed)
    best = np.full((len(qids), k), none, base.dtype)
    found = np.full((len(qids), k), np.iinfo(np.int64).max, np.int64)
    scored = 0
    for turn in range(len(starts)):
        block = order[:, turn]
        live = np.flatnonzero(bounds[np.arange(len(qids)), block] >= np.maximum(best[:, -1], needed))
        if not len(live):
            break
        scored += len(live)
        for b in np.unique(block[live]):
            who = live[block[live] == b]
            part = slice(starts[b], min(starts[b] + BLOCK, len(ids)))
            scores = asked[who] @ base[part].T
            scores[ids[part][None, :] == qids[who][:, None]] = none
            both = np.concatenate([best[who], scores], axis=1)
            names = np.concatenate([found[who], np.broadcast_to(ids[part], scores.shape)], axis=1)
            top = np.lexsort((names, -both), axis=1)[:, :k]
            best[who] = np.take_along_axis(both, top, axis=1)
            found[who] = np.take_along_axis(names, top, axis=1)
    q, place = np.nonzero((best > none) & (best >= needed[:, None]))
    return pd.DataFrame({"query_id": qids[q], "vec_id": found[q, place], "score": best[q, place].astype(np.int64)}), scored


def _dealt(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with the number ``g`` of their group, and how many groups: ranges of ids, whose sizes follow quantiles."""
    groups = max(1, -(-rows.count() // (BLOCK * GROUP)))
    at = [i / groups for i in range(1, groups)]
    cuts = sorted(set(rows.select(F.col("vec_id").cast("double").alias("x")).approxQuantile("x", at, 0.1 / groups))) if at else []
    if not cuts:
        return rows.withColumn("g", F.lit(0)), 1
    bounds = F.array(*[F.lit(c) for c in cuts])
    return rows.withColumn("g", F.size(F.filter(bounds, lambda c: c <= F.col("vec_id").cast("double"))).cast("int")), len(cuts) + 1


def _searched(asked: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The k best rows of group ``g`` for each query sent to it (``vec_id, vector, c, g, least``)."""

    def cell(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return _search(queries, held, k, queries["least"].to_numpy())[0]

    cells = asked.select(F.col("g").alias("g"), F.col("c").alias("cell")).distinct()
    held = rows.join(cells, "g").select("g", F.col("cell").alias("c"), "vec_id", "vector")
    return asked.groupBy("g", "c").cogroup(held.groupBy("g", "c")).applyInPandas(cell, _FOUND)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of each query.

    Both inputs have ``vec_id`` (long) and ``vector`` (array of long). Every row takes part,
    whatever the distribution of ids.
    """
    rows, queries = rows.dropna(subset=["vec_id", "vector"]), queries.dropna(subset=["vec_id", "vector"])
    rows, groups = _dealt(rows.select("vec_id", "vector"))
    # Under names of their own: both inputs may come from one table.
    queries = queries.groupBy(F.col("vec_id").alias("asked")).agg(F.min("vector").alias("vector"))
    queries = queries.select(F.col("asked").alias("vec_id"), "vector")
    chunks = max(1, -(-queries.count() // CHUNK))
    queries = queries.withColumn("c", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # Block maxima go to all chunks, and a query to all sets of maxima: vectors do not.
    maxima = settle(rows.groupBy("g").applyInPandas(_summary, "g int, high array<long>, low array<long>"))
    maxima = maxima.withColumn("s", F.floor(F.col("g") / SUMMARY).cast("int")).withColumn("c", everywhere(chunks)).groupBy("s", "c")
    sets = everywhere((groups - 1) // SUMMARY + 1)

    def best(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"vec_id": [], "g": [], "bound": []}).astype("int64")
        numbers, bounds = _group_bounds(asked, held)
        first = np.argmax(bounds, axis=1)
        top = bounds[np.arange(len(asked)), first].astype(np.int64)
        return pd.DataFrame({"vec_id": asked["vec_id"].to_numpy(), "g": numbers[first], "bound": top})

    def further(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"vec_id": [], "g": []}).astype("int64")
        numbers, bounds = _group_bounds(asked, held)
        reach = bounds >= asked["least"].to_numpy().astype(bounds.dtype)[:, None]
        q, place = np.nonzero(reach & (numbers[None, :] != asked["home"].to_numpy()[:, None]))
        return pd.DataFrame({"vec_id": asked["vec_id"].to_numpy()[q], "g": numbers[place]})

    homes = queries.withColumn("s", sets).groupBy("s", "c").cogroup(maxima).applyInPandas(best, "vec_id long, g int, bound long")
    homes = homes.groupBy("vec_id").agg(F.max_by("g", F.struct("bound", -F.col("g"))).alias("home"))
    queries = settle(queries.join(homes, "vec_id"))
    first = settle(_searched(queries.withColumn("g", F.col("home")).withColumn("least", F.lit(_NONE)), rows, k))

    kth = first.groupBy("query_id").agg(F.when(F.count("score") >= k, F.min("score")).alias("least"))
    queries = queries.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(_NONE)))
    onward = queries.withColumn("s", sets).groupBy("s", "c").cogroup(maxima).applyInPandas(further, "vec_id long, g int")
    found = first.union(_searched(queries.join(onward, "vec_id"), rows, k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
