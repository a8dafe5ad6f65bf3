"""Join texts whose word five-gram sets have a Jaccard similarity of ``THRESHOLD`` or more.

1. Texts with the same words in the same order are one class; only one of them goes on.
2. ``HASHES`` MinHash values a class; classes that share all values of one of the bands
   meet. With 32 bands of 4 values a pair at the threshold misses all of them with a
   probability of 5e-8, and less above it. Bands met by one class go no further; a band
   met by more than ``TILE`` classes is cut into tiles, and every pair of tiles is a group
   of its own, so no group is larger than two tiles.
3. Bayesian pruning: a pair is looked at in its first common band only. Its MinHash values
   are compared ``STEP`` at a time. After n values, m of them equal, the posterior of the
   similarity (uniform prior) is Beta(m + 1, n - m + 1); the pair is dropped as soon as the
   probability of reaching the threshold is below ``TOLERANCE``.
4. The pairs left are verified on the whole shingle sets, group by group. Pairs stay inside
   their task: it returns, for each class, the number of its links and the smallest class it
   is connected to in the group.
5. Connected components of those few edges by rounds of joins, until nothing changes.

Rows: null texts and texts without words have no shingles and no links, and each is a class
of its own. Texts of one to four words have one shingle. Repeated rows of one id count as
one text each. Null ids take part, the class id is then another member's id if there is one.
Extra columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shingles import mix, shingles, words
from strata.llm.support import binary_array, row_slices, settle, small_batches, text_bytes, whole_groups

THRESHOLD = 0.8
HASHES, BANDS = 128, 32
STEP = 16
TOLERANCE = 1e-6
TILE = 1024
_SLICE = 1 << 20
# Rows a batch between Spark and Python: whole texts, shingle sets or lists of partners stand in them.
_ROWS = 1000
_PAIRS = 1 << 17
_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_XOR = (_SEEDS[:HASHES] >> np.uint64(32)).astype(np.uint32)
_TIMES = (_SEEDS[HASHES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values, a row of ``HASHES`` for each text that has shingles."""
    full = np.flatnonzero(np.diff(bounds))
    starts = bounds[full]
    out = np.empty((len(full), HASHES), np.uint32)
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for k in range(HASHES):
        value = low ^ _XOR[k]
        value *= _TIMES[k]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        out[:, k] = np.minimum.reduceat(value, starts) if len(starts) else 0
    return out


def band_hashes(signs: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of each signature."""
    rows = signs.reshape(len(signs), BANDS, HASHES // BANDS).astype(np.uint64)
    out = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), rows.shape[:2]).copy()
    for k in range(rows.shape[2]):
        out = mix(out * np.uint64(0xD1342543DE82EF95) + rows[:, :, k])
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """After n compared values, the fewest equal ones that keep a pair.

    P(similarity >= t | m of n) under Beta(m + 1, n - m + 1) is the probability that a
    binomial of n + 1 trials at t is at most m.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def _classes(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row a document: ``doc_id``, ``words`` (digest of its words), ``signature`` (empty without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in row_slices(offsets, _SLICE):
                base = int(offsets[a])
                part, own = data[base : int(offsets[b])], offsets[a : b + 1] - base
                hashes, bounds = shingles(part, own)
                signs = signatures(hashes, bounds)
                full = np.diff(bounds) > 0
                ends = np.concatenate([[0], np.cumsum(full * HASHES * 4)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        binary_array(_digests(*words(part, own)).view(np.uint8).ravel(), np.arange(b - a + 1) * 16),
                        binary_array(signs.astype("<u4").view(np.uint8).ravel(), ends),
                    ],
                    names=["doc_id", "words", "signature"],
                )

    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(run, "doc_id long, words binary, signature binary")


def _digests(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two independent 64-bit digests of each text's words in order."""
    place = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = np.zeros((len(bounds) - 1, 2), "<u8")
    full = np.flatnonzero(np.diff(bounds))
    for k, salt in enumerate((0x51ED270B7F3C2A19, 0xA24BAED4963EE407)):
        each = mix(hashes + mix((place + 1).astype(np.uint64) * np.uint64(salt)))
        if len(full):
            out[full, k] = np.add.reduceat(each, bounds[full])
    return out


def _set_rows(df: DataFrame) -> DataFrame:
    """``class, shingles``: the sorted distinct shingle hashes of each text that has the class's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in row_slices(offsets, _SLICE):
                base = int(offsets[a])
                part, own = data[base : int(offsets[b])], offsets[a : b + 1] - base
                hashes, bounds = shingles(part, own)
                names = batch.column("class").slice(a, b - a)
                # Another text may stand under the same, repeated id.
                right = [d.tobytes() == n for d, n in zip(_digests(*words(part, own)), names.to_pylist(), strict=True)]
                sets = [np.unique(hashes[x:y]) for x, y, r in zip(bounds, bounds[1:], right, strict=False) if r]
                ends = np.concatenate([[0], np.cumsum([len(s) * 8 for s in sets])])
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).astype("<u8").view(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [names.filter(pa.array(right, pa.bool_())), binary_array(flat, ends)], names=["class", "shingles"]
                )

    sets = df.mapInArrow(run, "class binary, shingles binary")
    return sets.groupBy("class").agg(F.first("shingles").alias("shingles"))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(keys)))


def _pair_chunks(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of row numbers (first < second) within runs, some at a time."""
    rows = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, sizes, strict=True)]) if len(starts) else np.zeros(0, np.int64)
    last = np.repeat(starts + sizes, sizes)
    later = last - rows - 1
    total = np.cumsum(later)
    at = 0
    while at < len(rows):
        stop = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS, "right")), at + 1)
        n = later[at:stop]
        first = np.repeat(rows[at:stop], n)
        second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
        yield first, second
        at = stop


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From groups of signatures to the pairs that may reach the threshold.

    One row for each member of a pair: ``job`` (the group), ``class`` and ``partners``, the
    classes above its own that it is paired with.
    """
    needed = least_matches()
    for table in whole_groups(batches, "job"):
        if table.num_rows < 2:
            continue
        table = table.combine_chunks()
        jobs = np.array(table.column("job").to_pylist(), object)
        signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(-1, HASHES)
        bands = band_hashes(signs)
        band = table.column("band").to_numpy()
        # In a group of two tiles, pairs within one tile belong to that tile's own group.
        tile = table.column("tile").to_numpy()
        mixed = table.column("mixed").to_numpy(zero_copy_only=False)
        starts, sizes = _runs(jobs)
        ones, twos = [], []
        for first, second in _pair_chunks(starts[sizes > 1], sizes[sizes > 1]):
            keep = ~mixed[first] | (tile[first] != tile[second])
            first, second = first[keep], second[keep]
            # The first band that both share must be this one.
            same = bands[first] == bands[second]
            keep = same.argmax(axis=1) == band[first]
            keep &= same[np.arange(len(first)), band[first]]
            first, second = first[keep], second[keep]
            equal = np.zeros(len(first), np.int64)
            for n, least in needed:
                equal += (signs[first, n - STEP : n] == signs[second, n - STEP : n]).sum(axis=1)
                keep = equal >= least
                first, second, equal = first[keep], second[keep], equal[keep]
            ones.append(first)
            twos.append(second)
        if not ones or not sum(map(len, ones)):
            continue
        one, two = np.concatenate(ones), np.concatenate(twos)
        members = np.unique(np.concatenate([one, two]))
        order = np.argsort(one, kind="stable")
        one, two = one[order], two[order]
        classes = table.column("class").combine_chunks()
        at = np.searchsorted(one, members), np.searchsorted(one, members, "right")
        offsets = np.concatenate([[0], np.cumsum(at[1] - at[0])])
        flat = np.concatenate([two[a:b] for a, b in zip(*at, strict=True)])
        partners = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), classes.take(pa.array(flat)))
        take = pa.array(members)
        yield pa.RecordBatch.from_arrays(
            [table.column("job").combine_chunks().take(take), classes.take(take),
             table.column("copies").combine_chunks().take(take), partners],
            names=["job", "class", "copies", "partners"],
        )


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "job"):
            jobs = np.array(table.column("job").to_pylist(), object)
            classes = table.column("class").to_pylist()
            copies = table.column("copies").to_numpy()
            sets = [np.frombuffer(s, "<u8") for s in table.column("shingles").to_pylist()]
            partners = table.column("partners").to_pylist()
            out: tuple[list, list, list] = ([], [], [])
            for start, size in zip(*_runs(jobs), strict=True):
                place = {classes[i]: i for i in range(start, start + size)}
                links = np.zeros(size, np.int64)
                root = list(range(size))

                def top(x: int, root=root) -> int:
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x

                _, numbers = np.unique(np.concatenate(sets[start : start + size]), return_inverse=True)
                ends = np.cumsum([len(s) for s in sets[start : start + size]])
                own = np.split(numbers, ends[:-1])
                seen = np.zeros(int(numbers.max()) + 1, bool)
                for x in range(size):
                    others = [place[p] - start for p in partners[start + x] if p in place]
                    if not others:
                        continue
                    seen[own[x]] = True
                    lengths = np.array([len(own[y]) for y in others])
                    hits = seen[np.concatenate([own[y] for y in others])]
                    common = np.add.reduceat(hits, np.cumsum(lengths) - lengths, dtype=np.int64)
                    seen[own[x]] = False
                    linked = common >= threshold * (lengths + len(own[x]) - common) - 1e-9
                    for y in np.array(others)[linked]:
                        links[x] += copies[start + y]
                        links[y] += copies[start + x]
                        a, b = top(x), top(int(y))
                        if a != b:
                            root[max(a, b)] = min(a, b)
                for x in range(size):
                    if links[x]:
                        out[0].append(classes[start + x])
                        out[1].append(int(links[x]))
                        out[2].append(classes[start + top(x)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                names=["class", "links", "other"],
            )

    return run


def _mark(edges: DataFrame) -> tuple:
    """The number of distinct edges and a 128-bit digest of their set: equal marks, equal edges."""
    one, two = F.xxhash64("a", "b"), F.xxhash64(F.lit(1), "b", "a")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(one), F.bit_xor(two)).first())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, root``: the smallest node of each node's connected component (``edges``: ``a, b``).

    Alternating rounds: every node sends its larger, then its smaller neighbours to the smallest
    one it knows, until the edges are stars. The number of rounds grows with the logarithm of the
    component size.
    """
    current = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(current)
    for _ in range(rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
        new = settle(small.filter("a <> b").distinct())
        before, mark, current = mark, _mark(new), new
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def join_similar(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: ``doc_id, class_id, text_id, n_links``.

    ``class_id`` is the smallest id of the connected component, ``text_id`` the smallest id of
    the documents with the same words, ``n_links`` the number of other documents at the
    threshold or above, copies included.
    """
    session = df.sparkSession
    with small_batches(session, _ROWS):
        documents = settle(_classes(df, doc_id, text))
    full = F.length("signature") > 0
    classes = documents.filter(full).groupBy(F.col("words").alias("class")).agg(
        F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature")
    )
    classes = settle(classes)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                signs = np.frombuffer(b"".join(part.column("signature").to_pylist()), "<u4").reshape(-1, HASHES)
                flat = band_hashes(signs).view(np.int64).ravel()
                numbers = np.tile(np.arange(BANDS, dtype=np.int32), part.num_rows)
                names = part.column("class").take(pa.array(np.repeat(np.arange(part.num_rows), BANDS)))
                yield pa.RecordBatch.from_arrays([names, pa.array(numbers), pa.array(flat)], names=["class", "band", "hash"])

    bands = classes.select("class", "signature").mapInArrow(split, "class binary, band int, hash long")
    shared = bands.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = bands.join(shared, ["band", "hash"])
    tiles = F.ceil(F.col("n") / F.lit(TILE)).cast("int")
    met = met.select(
        "class", "band", "hash", tiles.alias("tiles"), F.pmod(F.xxhash64("class", "hash"), tiles).cast("int").alias("tile")
    )
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    job = F.concat_ws(":", "band", "hash", F.least("tile", "with"), F.greatest("tile", "with")).cast("binary")
    met = met.select(job.alias("job"), "class", "band", "tile", (F.col("tile") != F.col("with")).alias("mixed"))
    groups = met.join(classes.select("class", "copies", "signature"), "class")
    groups = groups.repartition("job").sortWithinPartitions("job")
    with small_batches(session, _ROWS):
        candidates = settle(groups.mapInArrow(_prune, "job binary, class binary, copies long, partners array<binary>"))

    wanted = candidates.select("class").distinct().join(classes.select("class", "text_id"), "class")
    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("text_id"), F.col(f"`{text}`").alias("text"))
    sets = _set_rows(source.join(wanted, source["text_id"].eqNullSafe(wanted["text_id"])).select("class", "text"))
    checked = candidates.join(sets, "class").repartition("job").sortWithinPartitions("job")
    with small_batches(session, _ROWS):
        found = settle(checked.mapInArrow(_verify(threshold), "class binary, links long, other binary"))

    counted = found.groupBy("class").agg(F.sum("links").alias("links"))
    smallest = components(found.select(F.col("class").alias("a"), F.col("other").alias("b")))
    linked = counted.join(smallest, counted["class"] == smallest["node"], "left").select(
        "class", "links", F.coalesce("root", "class").alias("root")
    )
    of_class = classes.select("class", "text_id", "copies").join(linked, "class", "left")
    of_class = of_class.withColumn("root", F.coalesce("root", "class"))
    lowest = of_class.groupBy("root").agg(F.min("text_id").alias("class_id"))
    of_class = of_class.join(lowest, "root").select(
        "class", "class_id", "text_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    alone = documents.filter(~full).select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("text_id"), F.lit(0).cast("long").alias("n_links"))
    members = documents.filter(full).select("doc_id", F.col("words").alias("class"))
    return members.join(of_class, "class").select("doc_id", "class_id", "text_id", "n_links").union(alone)
