"""Repair the structure of conversations by cheapest edits.

A conversation is well formed when the first letters of its roles read ``(s?(ua)+)?``. Its
rows, ordered by turn (nulls first; equal turns by a digest of role and text, so that
repeats stand side by side), are kept, given another role, or deleted, and turns without
text may be inserted. Among the cheapest edits the one whose letters come first in
ASCII order is taken.

Both aims are one number. Its high digits are the cost; below it stand the letters of the
edits, one digit of three bits each, the first edit highest, zeros behind the last. The
smaller of two such numbers is cheaper, or as cheap and earlier in the alphabet, and a text
is smaller than its continuations, as zeros end it. So a shortest path through the graph of
(row, state of the pattern, inserts in this gap), found from the last row to the first
by taking minima of integers, decides everything; there are no other rules for ties.

Two passes over the rows. The first sees digests and flags, not texts, and finds the edits of
a conversation in one task: about 100 bytes a row, and integers of three bits a row (time
grows with the square of the rows of one conversation: 0.1 s for 2,000, 9 s for 40,000).
The second streams the texts behind the edits, sorted, and holds one Arrow batch.

Rows: a null role or text is one space. A null ``conv_id`` is a conversation of its own.
Repeated rows are duplicates. A conversation of no rows (``copies`` 0 throughout) costs
nothing and stays empty. Other columns are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.support import row_key, row_slices, text_bytes, whole_groups

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"

CLEAN, BLANK, CUT = 0, 1, 2  # faults that a row shows by itself
# States of the pattern: nothing yet, after s, after u, after a. The role that must follow
# leads to TURN; what a kept row leads to is in STEP.
TURN = (2, 2, 3, 2)
NAMES = ("", "", "user", "assistant")
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = {"su", "ua", "au"}
LETTERS = str.maketrans("1234", "DIKR")

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SLICE = 8 << 20


def cheapest(initials: str, faults: list[int], doomed: list[bool]) -> tuple[int, str]:
    """Cost and letters of the best edits of rows with these role initials and faults; doomed rows must go."""
    digits = len(initials) + 2 * len(initials) // 5 + 6  # deleting all costs 2 a row, and an insert costs 5
    width = 3 * digits
    unit, top = 1 << width, width - 3
    low = unit - 1
    delete, insert = DELETE * unit + (1 << top), INSERT * unit + (2 << top)
    keep, rerole = 3 << top, REROLE * unit + (4 << top)

    def behind(v: int | None) -> int | None:
        """The number with its letters one digit further back."""
        return None if v is None else v - (v & low) + ((v & low) >> 3)

    def gap(values: list[int | None]) -> list[int | None]:
        """The best numbers if up to two turns may be inserted first; a third would come back to a state."""
        best = values
        for _ in range(2):
            moved = [behind(v) for v in best]
            best = [_least(values[s], None if moved[TURN[s]] is None else insert + moved[TURN[s]]) for s in range(4)]
        return best

    values = gap([0, None, None, 0])
    for initial, fault, gone in zip(reversed(initials), reversed(faults), reversed(doomed), strict=True):
        moved = [behind(v) for v in values]
        edited = []
        for s in range(4):
            best = None if moved[s] is None else delete + moved[s]
            if not gone:
                extra = TRUNCATED * unit if fault == CUT else 0
                after = STEP.get((s, initial))
                if after is not None and moved[after] is not None:
                    best = _least(best, keep + extra + moved[after])
                if moved[TURN[s]] is not None:
                    best = _least(best, rerole + extra + moved[TURN[s]])
            edited.append(best)
        values = gap(edited)
    best = values[0]
    letters = format(best & low, "o").zfill(digits).rstrip("0").translate(LETTERS)
    return best >> width, letters


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _plan(turns: list, marks: list, initials: list[str], faults: list[int]) -> list:
    """``COUNTS`` and the letters of one conversation."""
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    seen: set[bytes] = set()
    blank = duplicate = truncated = 0
    doomed = []
    for mark, fault in zip(marks, faults, strict=True):
        again = mark in seen
        seen.add(mark)
        doomed.append(fault == BLANK or again)
        blank += fault == BLANK
        duplicate += fault != BLANK and again
        truncated += fault == CUT and not again
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    # "x" for a role that fits nowhere; the empty role has no letter.
    cost, letters = cheapest("".join(i or "x" for i in initials), faults, doomed)
    return [gaps, blank, duplicate, truncated, illegal, cost, letters]


def _rows(df: DataFrame, copies: Column | None) -> DataFrame:
    """The rows with their order, flags and number of copies."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("key"), "conv_id",
        F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        (F.lit(1) if copies is None else copies).cast("int").alias("copies"),
    )
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), CLEAN).otherwise(CUT)
    return rows.select(
        "*", F.unhex(row_key(F.col("role"), F.col("text"))).alias("mark"), F.left("role", F.lit(1)).alias("initial"),
        fault.alias("fault"),
    )


def plans(df: DataFrame, copies: Column | None = None) -> DataFrame:
    """One row a conversation: ``key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``df`` has ``conv_id, turn, role, text``. ``copies`` says how often a row stands (0: it only
    names its conversation). A row counts under its first fault: blank, duplicate, truncated.
    """
    small = _rows(df, copies).select("key", "conv_id", "turn", "mark", "initial", "fault", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key"):
            for part in _by_rows(table):
                yield part

    counts = ", ".join(f"{c} long" for c in COUNTS)
    kind = small.schema["conv_id"].dataType.simpleString()
    dealt = small.repartition("key").sortWithinPartitions("key", "turn", "mark")
    return dealt.mapInArrow(run, f"key string, conv_id {kind}, {counts}, audit string")


def _by_rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Plans of the conversations of a table of whole conversations."""
    keys = table.column("key").to_pylist()
    turn, mark, initial, fault, copies = (table.column(c).to_pylist() for c in ("turn", "mark", "initial", "fault", "copies"))
    starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
    found = []
    for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
        rows = [i for i in range(a, b) for _ in range(copies[i])]
        found.append(_plan([turn[i] for i in rows], [mark[i] for i in rows], [initial[i] for i in rows], [fault[i] for i in rows]))
    columns = list(zip(*found, strict=True))
    arrays = [pa.array(c, pa.int64()) for c in columns[: len(COUNTS)]] + [pa.array(columns[-1], pa.string())]
    first = table.select(["key", "conv_id"]).take(starts).combine_chunks()
    whole = pa.Table.from_arrays([first.column("key"), first.column("conv_id"), *arrays], names=["key", "conv_id", *COUNTS, "audit"])
    yield from whole.to_batches()


def _edited(df: DataFrame, found: DataFrame, copies: Column | None) -> DataFrame:
    """For each conversation a row of its plan (place 0), then its repaired rows in order, all in one task."""
    texts = _rows(df, copies).select("key", "conv_id", F.lit(1).alias("part"), "turn", "mark", "role", "text", "copies")
    heads = found.select(
        "key", "conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("mark"),
        F.to_json(F.struct(*COUNTS)).alias("role"), F.col("audit").alias("text"), F.lit(1).alias("copies"),
    )
    dealt = heads.unionAll(texts).repartition("key").sortWithinPartitions("key", "part", "turn", "mark")
    names = ["key", "conv_id", "place", "edit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor = _Editor()
        kind = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            _, offsets = text_bytes(batch.column("text"))
            for a, b in row_slices(offsets, _SLICE):
                rows = batch.slice(a, b - a).to_pydict()
                for row in zip(*(rows[c] for c in ("key", "conv_id", "part", "role", "text", "copies")), strict=True):
                    editor.take(*row)
                yield _batch(editor.out, names, kind)
                editor.out = []
        editor.end()
        if editor.out:
            yield _batch(editor.out, names, kind)

    kind = texts.schema["conv_id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"key string, conv_id {kind}, place long, edit string, role string, text string")


def _batch(rows: list, names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    types = [pa.string(), kind, pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


class _Editor:
    """Applies the letters of a conversation to its rows as they come."""

    def __init__(self) -> None:
        self.out: list[tuple] = []
        self.letters, self.at, self.state, self.place = "", 0, 0, 0
        self.key = self.conv = None

    def take(self, key, conv, part, role, text, copies) -> None:
        if part == 0:
            self.end()
            self.key, self.conv, self.letters, self.at, self.state, self.place = key, conv, text, 0, 0, 0
            self.out.append((key, conv, 0, None, role, text))
            return
        for _ in range(copies):
            self.inserts()
            letter = self.letters[self.at]
            self.at += 1
            if letter == "K":
                self.emit(letter, STEP[self.state, role[:1]], role, text)
            elif letter == "R":
                self.emit(letter, TURN[self.state], NAMES[TURN[self.state]], text)

    def inserts(self) -> None:
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            self.emit("I", TURN[self.state], NAMES[TURN[self.state]], "")

    def emit(self, letter: str, state: int, role: str, text: str) -> None:
        self.state, self.place = state, self.place + 1
        self.out.append((self.key, self.conv, self.place, letter, role, text))

    def end(self) -> None:
        self.inserts()
        self.letters, self.at = "", 0


def repaired(df: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id, place`` (from 1), ``edit`` (K, R or I), ``role, text``."""
    rows = _edited(df, plans(df, copies), copies)
    return rows.filter("place > 0").select("conv_id", "place", "edit", "role", "text")


def judged(df: DataFrame, copies: Column | None = None) -> DataFrame:
    """The plans with ``repaired_sha256``: of the repaired ``role:text``, joined by newlines, in UTF-8."""
    rows = _edited(df, plans(df, copies), copies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, more = None, None, False
        for batch in batches:
            columns = batch.to_pydict()
            done = []
            for conv, place, role, text in zip(*(columns[c] for c in ("conv_id", "place", "role", "text")), strict=True):
                if place == 0:
                    if head is not None:
                        done.append((*head, digest.hexdigest()))
                    head, digest, more = (conv, role, text), hashlib.sha256(), False
                    continue
                digest.update(f"{chr(10) if more else ''}{role}:{text}".encode())
                more = True
            yield _digests(done, batch.schema.field("conv_id").type)
            kind = batch.schema.field("conv_id").type
        if head is not None:
            yield _digests([(*head, digest.hexdigest())], kind)

    kind = rows.schema["conv_id"].dataType.simpleString()
    hashed = rows.mapInArrow(run, f"conv_id {kind}, counts string, audit string, repaired_sha256 string")
    schema = ", ".join(f"{c} long" for c in COUNTS)
    return hashed.select("conv_id", F.from_json("counts", schema).alias("counts"), "audit", "repaired_sha256").select(
        "conv_id", "counts.*", "audit", "repaired_sha256"
    )


def _digests(rows: list, kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    types = [kind, pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv_id", "counts", "audit", "repaired_sha256"]
    )


def damage(df: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with faults by a hash of ``conv_id:turn``, and how often each stands (0: dropped).

    Of 20 hash values, 0 drops a row, 1 empties its text, 2 takes the ends of its sentences,
    3 repeats it, 4 gives it to the user. Nulls are one space.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    lot = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = df.select(
        "conv_id", "turn", F.when(lot == 4, "user").otherwise(role).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1).alias("copies"),
    )
    return rows, F.col("copies")
