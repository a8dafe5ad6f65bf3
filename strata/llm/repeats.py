"""Remove long strings that occur more than once, found with enhanced suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts anywhere else too, in
the same text or another. Overlaps count; everything is judged on the input.

1. Anchors. Of the ``GRAM``-byte grams inside a window of ``LENGTH`` bytes the one with the
   smallest hash (the last, among equals) is the window's anchor. Equal windows have equal
   anchors at the same place, and neighbouring windows mostly share theirs, so a text has
   about one anchor in 85 bytes. Only anchors whose gram occurs twice or more go on.
2. Units. An anchor's unit is the run of windows it stands for, at most ``2 * LENGTH`` bytes.
   Occurrences meet by gram as a few numbers each: a hash of the unit, and hashes of the
   ``SIDE`` bytes before and after the gram. A unit that occurs twice is covered whole. Of the
   others only those go on that share one side with another unit, as equal windows must.
3. Suffix arrays. The different units of a gram that are left meet with their bytes. Their
   suffixes are sorted by prefix doubling, with the lengths of common prefixes. A stack
   scan over the array visits the tree of common-prefix intervals; an interval whose suffixes
   are preceded by different bytes, or start their unit, is a maximal repeat group with all
   its occurrences. Groups of at least ``LENGTH`` bytes cover exactly the windows that
   occur again.
   The units of a gram with more than ``CROWD`` of them are divided: their windows are split
   into runs of ``STEP`` starts, which meet by the bytes that all windows of a run share.
   Occurrences of a gram meet in one task, up to ``MOST`` of them (a few MB of numbers). A gram
   beyond that is divided from the start, and equal pieces become one, with a number of
   occurrences, before they meet. Different pieces of a run differ only in the few bytes at
   either end; where more than ``CROWD`` of them are left, as at the edges of a block that
   stands in very many texts, they do not meet: their single windows are counted in a partial
   aggregate by digest (in one task, by hash, where the gram has no more than ``MOST`` occurrences).
   So no group grows with the data.
4. The covered ranges are united by text.

Maximal repeats longer than a unit appear as a chain of overlapping groups, one an anchor.

Rows: null text is empty. Repeated rows are occurrences of their own, so each loses what
the other holds. Null and repeated ids are allowed. Extra columns are not read. An empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shingles import _BYTES, mix, powers, range_hashes
from strata.llm.support import row_slices, settle, text_bytes, whole_groups

LENGTH = 200
GRAM = 32
MOST = 100_000
CROWD = 4000
STEP = 16
SIDE = (LENGTH - GRAM) // 2
_SLICE = 1 << 19
_ROWS = 3000  # units in one suffix array, but for whole groups
_LOW = np.uint64(0xFFFFF)


def _designated(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the anchor of every window in at most 2**20 bytes, and the hashes of all grams."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:-1], out=sums[1:])
    n = len(data) - GRAM + 1
    hashes = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n])
    low = (hashes & ~_LOW) | (_LOW - np.arange(n, dtype=np.uint64))
    width, span = LENGTH - GRAM + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    return (_LOW - (low & _LOW)).astype(np.int64), hashes


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, place, hash, first and last window start of every anchor of some texts, places within the text."""
    found = []
    for a, b in row_slices(offsets, _SLICE):
        base, end = int(offsets[a]), int(offsets[b])
        for start in range(base, max(end - LENGTH + 1, base), _SLICE):
            part = data[start : min(start + _SLICE + LENGTH - 1, end)]
            if len(part) < LENGTH:
                continue
            place, hashes = _designated(part)
            windows = np.arange(len(place)) + start
            row = np.searchsorted(offsets, windows, "right") - 1
            inside = windows + LENGTH <= offsets[row + 1]
            windows, row, place = windows[inside], row[inside], place[inside]
            if not len(windows):
                continue
            new = np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(windows)) - 1
            r = row[first]
            found.append((r, place[first] + start - offsets[r], hashes[place[first]], windows[first] - offsets[r], windows[last] - offsets[r]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, place, hashes, _, _ = anchors(*text_bytes(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), batch.column("doc_id").take(pa.array(row)), pa.array(place)],
            names=["gram", "doc_id", "place"],
        )


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The occurrences of repeated grams as numbers: hashes of the unit and of both sides of the gram, 0 for no such window."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        row, place, hashes, first, last = _picked(data, offsets, batch.column("cold"))
        base, at = offsets[row], offsets[row] + place
        unit = range_hashes(data, base + first, base + last + LENGTH)
        left = np.where(first <= place - SIDE, range_hashes(data, np.maximum(at - SIDE, 0), at), np.uint64(0))
        end = np.minimum(at + GRAM + SIDE, len(data))
        right = np.where(last >= place - SIDE, range_hashes(data, np.minimum(at + GRAM, end), end), np.uint64(0))
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)) for x in (hashes, unit, left, right)]
            + [batch.column("doc_id").take(take), batch.column("mark").take(take), *map(pa.array, (place, first, last))],
            names=["job", "unit", "left", "right", "doc_id", "mark", "place", "first", "last"],
        )


def _picked(data: np.ndarray, offsets: np.ndarray, wanted: pa.Array) -> tuple[np.ndarray, ...]:
    """The anchors whose places are wanted; a list of places for each text."""
    found = anchors(data, offsets)
    lists = wanted.fill_null([]) if wanted.null_count else wanted
    sizes = np.diff(lists.offsets.to_numpy())
    asked = np.repeat(np.arange(len(lists)), sizes) << 40 | lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    keep = np.isin(found[0].astype(np.int64) << 40 | found[1], asked)
    return tuple(x[keep] for x in found)


def _met(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """What is known without the bytes: ``covered`` rows of units that occur twice, and rows whose bytes are wanted.

    ``single`` tells a unit that occurs once from one that only stands for its copies.
    """
    for table in whole_groups(batches, "job"):
        table = table.combine_chunks()
        job, unit, left, right = (table.column(c).to_numpy() for c in ("job", "unit", "left", "right"))
        order = np.lexsort((unit, job))
        new = np.concatenate([[True], (job[order][1:] != job[order][:-1]) | (unit[order][1:] != unit[order][:-1])])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        times = np.bincount(number)[number]
        one = order[new]  # a row for each different unit
        wanted = np.zeros(len(order), bool)
        for side in (left, right):
            there = one[side[one] != 0]
            rank = there[np.lexsort((side[there], job[there]))]
            same = (job[rank][1:] == job[rank][:-1]) & (side[rank][1:] == side[rank][:-1])
            wanted[rank[1:][same]] = True
            wanted[rank[:-1][same]] = True
        keep = np.flatnonzero((times > 1) | wanted)
        # A group of units that all occur twice has nothing left to find.
        open_jobs = np.unique(job[wanted & (times == 1)])
        wanted &= np.isin(job, open_jobs)
        _, which = np.unique(job, return_inverse=True)
        crowded = np.bincount(which, wanted)[which] > crowd
        out = table.take(pa.array(keep)).select(["job", "doc_id", "mark", "place", "first", "last"])
        for name, flag in (("covered", times > 1), ("wanted", wanted), ("crowded", crowded)):
            out = out.append_column(name, pa.array(flag[keep]))
        yield from out.combine_chunks().to_batches()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted units, of crowded grams in pieces."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        out: tuple[list, ...] = ([], [], [], [], [])
        for row, asked in enumerate(batch.column("asked").to_pylist()):
            text = data[offsets[row] : offsets[row + 1]]
            for unit in asked:
                gram, first, last = unit["job"], unit["first"], unit["last"]
                if unit["crowded"]:
                    parts = [(key, a, piece) for key, a, piece in _runs(text, gram, unit["place"], first, last)]
                else:
                    parts = [(gram.to_bytes(8, "big", signed=True), first, text[first : last + LENGTH].tobytes())]
                for key, at, piece in parts:
                    for column, value in zip(out, (key, row, at, unit["covered"], piece), strict=True):
                        column.append(value)
        take = pa.array(out[1], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), batch.column("doc_id").take(take), batch.column("mark").take(take),
             pa.array(out[2], pa.int64()), pa.array(out[3], pa.bool_()), pa.array(out[4], pa.binary())],
            names=["job", "doc_id", "mark", "first", "covered", "bytes"],
        )


def _runs(text: np.ndarray, gram: int, place: int, first: int, last: int) -> Iterator[tuple[bytes, int, bytes]]:
    """A unit as runs of ``STEP`` windows: a key of the bytes that all windows of the run share, start, bytes.

    Runs start at fixed places before the anchor, so equal windows fall into equal runs.
    """
    for low in range(place - ((place - first) // STEP + 1) * STEP, last + 1, STEP):
        a, b = max(low, first), min(low + STEP, last + 1)
        if a < b:
            shared = text[low + STEP - 1 : low + LENGTH].tobytes()
            where = gram.to_bytes(8, "big", signed=True) + (low - place).to_bytes(4, "big", signed=True)
            yield hashlib.md5(where + shared).digest(), a, text[a : b - 1 + LENGTH].tobytes()


class SuffixArray:
    """Suffixes of several units, at least ``least`` bytes long, in order, with their common prefixes.

    Units lie in rows of one width, filled up with zeros; ranks of prefixes of 8, 16, 32 …
    bytes are found by doubling. Lengths of common prefixes come from the ranks and end at
    the ends of the units.
    """

    def __init__(self, units: list[bytes], least: int = LENGTH):
        sizes = np.array([len(u) for u in units])
        width = -(-int(sizes.max()) // 8) * 8
        rows = np.frombuffer(b"".join(u.ljust(width, b"\0") for u in units), np.uint8).reshape(len(units), width)
        padded = np.concatenate([rows, np.zeros((len(units), 8), np.uint8)], axis=1)
        wide = np.zeros(rows.shape, np.uint64)
        for k in range(8):
            wide = wide << np.uint64(8) | padded[:, k : k + width]
        self.ranks = {8: np.unique(wide, return_inverse=True)[1].reshape(rows.shape).astype(np.int64)}
        span = 8
        while span < width:
            rank = self.ranks[span]
            later = np.full_like(rank, -1)
            if span < width:
                later[:, : width - span] = rank[:, span:]
            self.ranks[2 * span] = np.unique(rank << 32 | (later + 1), return_inverse=True)[1].reshape(rows.shape).astype(np.int64)
            span *= 2
        unit, start = np.nonzero(np.arange(width) <= (sizes - least)[:, None])
        order = np.lexsort((unit, self.ranks[span][unit, start]))
        self.unit, self.start = unit[order], start[order]
        self.rows, self.sizes, self.width = padded, sizes, width
        self.lcp = self._common()
        # The byte before each suffix; -1 - row where the unit starts, which differs from all others.
        before = padded[self.unit, np.maximum(self.start - 1, 0)].astype(np.int64)
        self.before = np.where(self.start > 0, before, -1 - np.arange(len(before)))

    def _common(self) -> np.ndarray:
        """Common prefix length of each suffix with the one before it; 0 for the first."""
        u1, s1, u2, s2 = self.unit[:-1], self.start[:-1], self.unit[1:], self.start[1:]
        length = np.zeros(len(u1), np.int64)
        for span in sorted(self.ranks, reverse=True):
            rank = self.ranks[span]
            a, b = s1 + length, s2 + length
            fits = np.maximum(a, b) < self.width
            a, b = np.minimum(a, self.width - 1), np.minimum(b, self.width - 1)
            length += np.where(fits & (rank[u1, a] == rank[u2, b]), span, 0)
        for _ in range(8):
            a, b = np.minimum(s1 + length, self.width), np.minimum(s2 + length, self.width)
            length += self.rows[u1, a] == self.rows[u2, b]
        length = np.minimum(length, np.minimum(self.sizes[u1] - s1, self.sizes[u2] - s2))
        return np.concatenate([[0], length]) if len(self.unit) else np.zeros(0, np.int64)

    def maximal(self, least: int = LENGTH) -> Iterator[tuple[int, int, int, list[int]]]:
        """Maximal repeat groups: length, first and last place in the array, and the places in no deeper interval."""
        if not len(self.lcp):
            return
        long = self.lcp >= least
        # A run: a suffix and all that follow with a long common prefix.
        edge = np.diff(np.concatenate([[0], long.astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(edge == 1) - 1, np.flatnonzero(edge == -1) - 1
        turns = np.concatenate([[0], np.cumsum(self.before[1:] != self.before[:-1])])
        for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
            if turns[i] != turns[j]:  # else every interval in the run extends to the left
                yield from self._scan(i, j)

    def _scan(self, i: int, j: int) -> Iterator[tuple[int, int, int, list[int]]]:
        lcp, before = self.lcp[i + 1 : j + 1].tolist(), self.before[i : j + 1].tolist()
        none = object()
        # Open intervals: length, first place, the byte before all of it (or none), own places.
        stack: list[list] = []
        for n, length in enumerate([*lcp, 0]):
            place, byte, own = n, before[n], [n]
            while stack and stack[-1][0] > length:
                top = stack.pop()
                if top[3] is not None:
                    top[3] += own
                    top[2] = top[2] if top[2] == byte else none
                if top[2] is none:
                    yield top[0], i + top[1], i + n, [i + x for x in top[3]]
                place, byte, own = top[1], top[2], []
            if not length:
                return
            if stack and stack[-1][0] == length:
                stack[-1][3] += own
                stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else none
            else:
                stack.append([length, place, byte, own])


def _united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _again(units: list[bytes], times: np.ndarray) -> Iterator[tuple[int, int]]:
    """Unit and start of every window that occurs again, by counts of window hashes."""
    sizes = np.array([len(u) for u in units])
    windows = np.maximum(sizes - LENGTH + 1, 0)
    unit = np.repeat(np.arange(len(units)), windows)
    start = np.arange(len(unit)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = (np.cumsum(sizes) - sizes)[unit] + start
    _, which = np.unique(range_hashes(np.frombuffer(b"".join(units), np.uint8), at, at + LENGTH), return_inverse=True)
    more = np.bincount(which, times[unit])[which] > 1
    return zip(unit[more].tolist(), start[more].tolist(), strict=True)


def covered(units: list[bytes], times: list[int], most: int = CROWD + _ROWS) -> list[list[tuple[int, int]]]:
    """For each unit, the united ranges that maximal repeat groups cover; a unit that occurs twice is covered whole.

    More than ``most`` different units are too many for one suffix array; their windows are counted.
    """
    number: dict[bytes, int] = {}
    which = [number.setdefault(u, len(number)) for u in units]
    total = np.bincount(which, times, len(number))
    found: list[list[tuple[int, int]]] = [[(0, len(u))] if total[i] > 1 else [] for u, i in number.items()]
    if len(number) > most:
        for i, start in _again(list(number), total):
            found[i].append((start, start + LENGTH))
    elif len(number) > 1:
        array = SuffixArray(list(number))
        for length, _, _, own in array.maximal():
            for place in own:
                start = int(array.start[place])
                found[array.unit[place]].append((start, start + length))
    found = [_united(f) for f in found]
    return [found[i] for i in which]


def _array_groups(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Row ranges of whole jobs, large enough for one suffix array each."""
    jobs = table.column("job").to_pylist()
    start = 0
    for i in range(1, len(jobs) + 1):
        if i == len(jobs) or (jobs[i] != jobs[i - 1] and i - start >= _ROWS):
            yield start, i
            start = i


def _cover_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered ranges of units that occur once, places within the text."""
    for table in whole_groups(batches, "job"):
        for a, b in _array_groups(table):
            part = table.slice(a, b - a)
            known, first = part.column("covered").to_pylist(), part.column("first").to_pylist()
            found = covered(part.column("bytes").to_pylist(), [1] * len(part))
            rows = [i for i, r in enumerate(found) if r and not known[i]]
            ranges = [[first[i] + x for pair in found[i] for x in pair] for i in rows]
            some = part.select(["doc_id", "mark"]).take(pa.array(rows, pa.int64())).combine_chunks()
            out = some.append_column("ranges", pa.array(ranges, pa.list_(pa.int64())))
            yield from out.combine_chunks().to_batches()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of crowded grams as runs of ``STEP`` windows, keyed by the bytes all those windows share."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        out: tuple[list, ...] = ([], [], [], [], [])
        picked = _picked(data, offsets, batch.column("hot"))
        for row, place, gram, first, last in zip(*(x.tolist() for x in picked), strict=True):
            text = data[offsets[row] : offsets[row + 1]]
            for key, a, piece in _runs(text, int(np.uint64(gram).view(np.int64)), place, first, last):
                for column, value in zip(out, (key, hashlib.md5(piece).digest(), piece, row, a), strict=True):
                    column.append(value)
        take = pa.array(out[3], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.binary()) for c in out[:3]), batch.column("doc_id").take(take), batch.column("mark").take(take),
             pa.array(out[4], pa.int64())],
            names=["job", "unit", "bytes", "doc_id", "mark", "at"],
        )


def _cover_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, "job"):
        for a, b in _array_groups(table):
            part = table.slice(a, b - a)
            found = covered(part.column("bytes").to_pylist(), part.column("times").to_pylist())
            rows = [i for i, r in enumerate(found) if r]
            ranges = [[x for pair in found[i] for x in pair] for i in rows]
            some = part.select(["job", "unit"]).take(pa.array(rows, pa.int64())).combine_chunks()
            yield from some.append_column("ranges", pa.array(ranges, pa.list_(pa.int64()))).combine_chunks().to_batches()


def _single_windows(merged: DataFrame) -> DataFrame:
    """``job, unit, ranges`` of pieces too many to meet: the windows that occur again, counted by digest."""
    starts = F.sequence(F.lit(0), F.octet_length("bytes") - LENGTH)
    each = merged.select("job", "unit", "times", "bytes", F.explode(starts).alias("start"))
    each = each.select("job", "unit", "times", "start", F.unhex(F.md5(F.substring("bytes", F.col("start") + 1, LENGTH))).alias("window"))
    again = each.groupBy(F.col("window").alias("w")).agg(F.sum("times").alias("n")).filter("n > 1").select("w")
    found = each.join(again, each["window"] == again["w"], "left_semi").groupBy("job", "unit").agg(F.collect_set("start").alias("starts"))
    ranges = F.flatten(F.transform("starts", lambda a: F.array(a.cast("long"), a.cast("long") + LENGTH)))
    return found.select("job", "unit", ranges.alias("ranges"))


def _of_texts(texts: DataFrame, small: DataFrame) -> DataFrame:
    """Texts with what is known of them (``id``, ``m``).

    All joins with texts have the id as their only key and compare marks beside it, so Spark
    deals the texts out once and reads that exchange again.
    """
    same = texts["mark"].bitwiseXOR(small["m"]) == 0
    return texts.join(small, texts["doc_id"].eqNullSafe(small["id"]) & same)


def repeated_ranges(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All texts long enough (``doc_id, mark, text``), and ``doc_id, mark, ranges`` of those with a repeat.

    ``mark`` is a hash of the text; ``ranges`` holds start and end of covered byte ranges, which
    may overlap.
    """
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter(F.octet_length("text") >= LENGTH)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_anchor_rows, f"gram long, doc_id {kind}, place long")
    often = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Places of one text: no more than the text has bytes.
    few = F.col("n") <= MOST
    places = found.join(often, "gram").groupBy(F.col("doc_id").alias("id")).agg(
        F.collect_set(F.when(few, F.col("place"))).alias("cold"), F.collect_set(F.when(~few, F.col("place"))).alias("hot")
    )
    texts = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    places = settle(places)
    held = texts.join(places, texts["doc_id"].eqNullSafe(places["id"])).drop("id")

    numbers = held.filter(F.size("cold") > 0).select("doc_id", "mark", "text", "cold").mapInArrow(
        _meetings, f"job long, unit long, left long, right long, doc_id {kind}, mark long, place long, first long, last long"
    )
    crowd = CROWD
    met = numbers.repartition("job").sortWithinPartitions("job").mapInArrow(
        lambda batches: _met(batches, crowd),
        f"job long, doc_id {kind}, mark long, place long, first long, last long, "
        "covered boolean, wanted boolean, crowded boolean"
    )
    copies = met.filter("covered").select("doc_id", "mark", F.array(F.col("first"), F.col("last") + LENGTH).alias("ranges"))
    asked = met.filter("wanted").groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("m")).agg(
        F.collect_set(F.struct("job", "place", "first", "last", "covered", "crowded")).alias("asked")
    )
    units = _of_texts(texts, asked)
    units = units.select("doc_id", "mark", "text", "asked").mapInArrow(
        _slices, f"job binary, doc_id {kind}, mark long, first long, covered boolean, bytes binary"
    )
    compared = units.repartition("job").sortWithinPartitions("job").mapInArrow(
        _cover_units, f"doc_id {kind}, mark long, ranges array<long>"
    )
    pieces = held.filter(F.size("hot") > 0).select("doc_id", "mark", "text", "hot").mapInArrow(
        _pieces, f"job binary, unit binary, bytes binary, doc_id {kind}, mark long, at long"
    )
    merged = settle(pieces.groupBy("job", "unit").agg(F.count(F.lit(1)).alias("times"), F.first("bytes").alias("bytes")))
    large = merged.groupBy(F.col("job").alias("large")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD).select("large")
    few = merged.join(large, merged["job"] == large["large"], "left_anti")
    divided = few.repartition("job").sortWithinPartitions("job").mapInArrow(
        _cover_pieces, "job binary, unit binary, ranges array<long>"
    )
    divided = divided.union(_single_windows(merged.join(large, merged["job"] == large["large"], "left_semi")))
    divided = pieces.select("job", "unit", "doc_id", "mark", "at").join(divided, ["job", "unit"]).select(
        "doc_id", "mark", F.transform("ranges", lambda x: x + F.col("at")).alias("ranges")
    )
    # As many ranges as the text has anchors and pieces, at most.
    ranges = copies.union(compared).union(divided).groupBy("doc_id", "mark").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))
    return texts, ranges


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        kept, spans = [], []
        for i, flat in enumerate(batch.column("ranges").to_pylist()):
            own = data[offsets[i] : offsets[i + 1]].tobytes()
            cuts = _united(list(zip(flat[::2], flat[1::2], strict=True)))
            ends = [0, *[b for _, b in cuts]]
            kept.append(b"".join(own[a:b] for a, b in zip(ends, [*[a for a, _ in cuts], len(own)], strict=True)))
            spans.append([x for pair in cuts for x in pair])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
            names=["doc_id", "mark", "spans", "kept"],
        )


def cut_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each text that loses something: ``doc_id, mark, spans, kept``.

    ``spans`` holds start and end of the maximal removed byte runs, ``kept`` the remaining
    bytes. ``mark`` is ``xxhash64`` of the text and tells texts of one id apart.
    """
    held, ranges = repeated_ranges(df, doc_id, text)
    id_type = held.schema["doc_id"].dataType.simpleString()
    both = _of_texts(held, ranges.withColumnsRenamed({"doc_id": "id", "mark": "m"}))
    return both.select("doc_id", "mark", "text", "ranges").mapInArrow(
        _cut_rows, f"doc_id {id_type}, mark long, spans array<long>, kept binary"
    )
