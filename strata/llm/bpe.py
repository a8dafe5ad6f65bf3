"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

Every match of the split pattern is encoded for itself. A segment tree over the
byte positions of the match stores, in each node, the lowest pair rank below it
and, among equal ranks, the leftmost position. The root names the next merge.
A merge changes three leaves: the pair that went, and the pairs on both sides of
the new token, found through links between live positions. Each change is written
up the tree in a logarithmic number of steps.

Matches of the same padded length go through their trees together, as rows of one
array; long matches (over ``LONG`` bytes) go one by one through the same tree in
plain lists. Encoded matches are remembered in a table of at most ``REMEMBERED``
entries per worker.

Rows: a null or empty text has no tokens and decodes to the empty text. Repeated
rows stay. Extra columns stay; one with the name of an output column is replaced.
An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.support import binary_array, row_slices, text_bytes

LONG = 128
REMEMBERED = 200_000
_SLICE = 1 << 20
_CELLS = 1 << 18
_NONE = np.int64(1) << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file: one base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of many ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


class Codec:
    """Encodes and decodes by one vocabulary; lives as long as its Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # The tiktoken library reads \s as the Unicode property White_Space.
        self.split = regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.pairs = pairs
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_lengths = np.array([len(t) for t in tokens], np.int64)
        self.token_starts = np.concatenate([[0], np.cumsum(self.token_lengths)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.uint32)
        self.used = 0

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, or a value above all ranks."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (right >= 0), self.merged[at], _NONE >> 32)

    def together(self, pieces: list[bytes], leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of pieces of 2 to ``leaves`` bytes, one tree a row, and their number by piece."""
        m, n = len(pieces), leaves
        sizes = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(n, b"\0") for p in pieces), np.uint8).reshape(m, n)
        column = np.arange(n)
        ids = np.full((m, n + 1), -1, np.int64)
        ids[:, :n] = np.where(column < sizes[:, None], self.single[raw], -1)
        after = np.where(column + 1 < sizes[:, None], column + 1, n)
        after = np.concatenate([after, np.full((m, 1), n)], axis=1)
        before = np.tile(np.concatenate([[n], np.arange(n)]), (m, 1))
        tree = np.full((m, 2 * n), _NONE, np.int64)
        tree[:, n:] = np.where(
            column + 1 < sizes[:, None], self.rank(ids[:, :n], ids[:, 1:]) << 32 | column, _NONE
        )
        level = n
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        live = np.flatnonzero(tree[:, 1] >> 32 < _NONE >> 32)
        while len(live):
            root = tree[live, 1]
            at, new = root & 0xFFFFFFFF, root >> 32
            gone = after[live, at]
            right = after[live, gone]
            left = before[live, at]
            ids[live, at] = new
            ids[live, gone] = -1
            ids[live, n] = -1
            after[live, at] = right
            before[live, right] = at
            after[live, n] = n
            next_rank = self.rank(new, ids[live, right])
            prior = np.where(left < n, ids[live, left], -1)
            prior_rank = np.where(left < n, self.rank(prior, new), _NONE >> 32)
            tree[live, n + gone] = _NONE
            tree[live, n + at] = next_rank << 32 | at
            has = left < n
            tree[live[has], n + left[has]] = prior_rank[has] << 32 | left[has]
            nodes = [(live, n + gone), (live, n + at), (live[has], n + left[has])]
            level = n
            while level > 1:
                nodes = [(rows, spot >> 1) for rows, spot in nodes]
                for rows, spot in nodes:
                    tree[rows, spot] = np.minimum(tree[rows, 2 * spot], tree[rows, 2 * spot + 1])
                level //= 2
            live = live[tree[live, 1] >> 32 < _NONE >> 32]
        there = ids[:, :n] >= 0
        return ids[:, :n][there].astype(np.uint32), there.sum(axis=1)

    def alone(self, piece: bytes) -> np.ndarray:
        """Token ids of one long piece, by the same tree in plain lists."""
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        none = (1 << 62, 0)
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        tree = [none] * (2 * size)
        for i in range(n - 1):
            rank = pairs.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[size + i] = (rank, i)
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, rank: int | None) -> None:
            i += size
            tree[i] = none if rank is None else (rank, i - size)
            while i > 1:
                i >>= 1
                low = min(tree[2 * i], tree[2 * i + 1])
                if low == tree[i]:
                    break
                tree[i] = low

        while tree[1] != none:
            rank, at = tree[1]
            gone = after[at]
            right, left = after[gone], before[at]
            ids[at], ids[gone], after[at] = rank, -1, right
            put(gone, None)
            if right < n:
                before[right] = at
                put(at, pairs.get(rank << 32 | ids[right]))
            else:
                put(at, None)
            if left >= 0:
                put(left, pairs.get(ids[left] << 32 | rank))
        return np.array([i for i in ids if i >= 0], np.uint32)

    def pieces(self, pieces: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Groups of the pieces, the token ids of each group and their number by piece."""
        whole: list[str] = []
        by_size: dict[int, list[str]] = {}
        for piece in pieces:
            raw = piece.encode()
            if raw in self.ranks:
                whole.append(piece)
            elif len(raw) > LONG:
                ids = self.alone(raw)
                yield [piece], ids, np.array([len(ids)])
            else:
                by_size.setdefault(1 << (len(raw) - 1).bit_length(), []).append(piece)
        yield whole, np.array([self.ranks[p.encode()] for p in whole], np.uint32), np.ones(len(whole), np.int64)
        for leaves, those in by_size.items():
            step = max(1, _CELLS // leaves)
            for a in range(0, len(those), step):
                part = those[a : a + step]
                yield part, *self.together([p.encode() for p in part], leaves)

    def learn(self, found: list[str]) -> None:
        """Encode the matches that are not in the table yet, and put them in."""
        missing = set(found).difference(self.known)
        if len(self.known) + len(missing) > REMEMBERED:
            self.forget()
            missing = set(found)
        for new, ids, sizes in self.pieces(list(missing)):
            first = len(self.known)
            total, filled = first + len(new), self.used + len(ids)
            if total > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros(total, np.int64)])
                self.lengths = np.concatenate([self.lengths, np.zeros(total, np.int64)])
            if filled > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(filled, np.uint32)])
            self.pool[self.used : filled] = ids
            self.lengths[first:total] = sizes
            self.starts[first:total] = self.used + np.cumsum(sizes) - sizes
            self.used = filled
            self.known.update(zip(new, range(first, total), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the n + 1 offsets of the texts in them."""
        found: list[str] = []
        ends = [0]
        for text in texts:
            found += self.split.findall(text)
            ends.append(len(found))
        if not found:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        self.learn(found)
        which = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        lengths = self.lengths[which]
        offsets = np.concatenate([[0], np.cumsum(lengths)])[ends]
        return self.pool[_spans(self.starts[which], lengths)], offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts one after the other, and the n + 1 offsets of the texts in them."""
        lengths = self.token_lengths[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.token_bytes[_spans(self.token_starts[ids], lengths)], ends[offsets]


def _same_rows(left: np.ndarray, left_ends: np.ndarray, right: np.ndarray, right_ends: np.ndarray) -> list[bool]:
    """Whether each row has the same bytes in two arrays with n + 1 offsets each."""
    rows = zip(left_ends, left_ends[1:], right_ends, right_ends[1:], strict=False)
    return [np.array_equal(left[a:b], right[c:d]) for a, b, c, d in rows]


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(vocabulary: str, shared, pattern: str) -> Codec:
    """The worker's codec for a vocabulary (named by the digest of its ranks) and a pattern."""
    if (vocabulary, pattern) not in _codecs:
        _codecs.clear()
        _codecs[vocabulary, pattern] = Codec(shared.value, pattern)
    return _codecs[vocabulary, pattern]


def _share(df: DataFrame, vocabulary: str):
    ranks = read_ranks(vocabulary)
    name = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    return name, df.sparkSession.sparkContext.broadcast(ranks)


def encode(
    df: DataFrame, vocabulary: str, pattern: str, text: str = "text", keep: tuple[str, ...] | None = None, decoded: bool = False,
    round_trip: bool = False,
) -> DataFrame:
    """Add ``tokens``: the ids of each text as little-endian unsigned 32-bit integers.

    ``vocabulary`` is a ``.tiktoken`` file that the driver reads; its ranks, a few
    hundred kilobytes whatever the data, are broadcast. ``keep`` names the columns to
    return beside it, all by default. With ``decoded`` the ids are decoded in the same pass
    and their bytes added too, as :func:`decode` would. With ``round_trip`` they are decoded and
    compared with the text where they are: a flag is added, and no second copy of the text leaves the task.
    """
    name, shared = _share(df, vocabulary)
    new = ["tokens", *(["decoded"] if decoded else []), *(["round_trip"] if round_trip else [])]
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    # A text that is kept goes to Python once.
    given = text if text in kept else "__text"
    source = df.select(*[F.col(f"`{c}`") for c in kept], *([] if text in kept else [F.col(f"`{text}`").alias("__text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, shared, pattern)
        for batch in batches:
            _, offsets = text_bytes(batch.column(given))
            for a, b in row_slices(offsets, _SLICE):
                part = batch.slice(a, b - a)
                ids, ends = codec.encode([t or "" for t in part.column(given).to_pylist()])
                out = [binary_array(ids.astype("<u4").view(np.uint8), ends * 4)]
                back = codec.decode(ids, ends) if decoded or round_trip else None
                if decoded:
                    out.append(binary_array(*back))
                if round_trip:
                    out.append(pa.array(_same_rows(*back, *text_bytes(part.column(given))), pa.bool_()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *out], names=[*kept, *new])

    kinds = [F.lit(c == "round_trip" or b"").alias(c) for c in new]
    schema = source.select(*[f"`{c}`" for c in kept], *kinds).schema
    return source.mapInArrow(run, schema)


def decode(
    df: DataFrame, vocabulary: str, pattern: str, tokens: str = "tokens", keep: tuple[str, ...] | None = None
) -> DataFrame:
    """Add ``decoded``: the bytes that the ids in ``tokens`` stand for; null decodes to no bytes."""
    name, shared = _share(df, vocabulary)
    kept = [c for c in (df.columns if keep is None else keep) if c != "decoded"]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{tokens}`").alias("__tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, shared, pattern)
        for batch in batches:
            _, offsets = text_bytes(batch.column("__tokens"))
            for a, b in row_slices(offsets, _SLICE):
                part = batch.slice(a, b - a)
                raw, ends = text_bytes(part.column("__tokens"))
                data, bounds = codec.decode(np.ascontiguousarray(raw).view("<u4"), ends // 4)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), binary_array(data, bounds)], names=[*kept, "decoded"]
                )

    schema = source.select(*[f"`{c}`" for c in kept], F.lit(b"").alias("decoded")).schema
    return source.mapInArrow(run, schema)
