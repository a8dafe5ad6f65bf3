"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are bigrams and trigrams of the lower-case text, every run of other characters
than letters being one space, hashed to ``DIMENSIONS`` places; weights are
(1 + log count) * idf, divided by their length. Document frequencies are counted over all
documents that may be learned from. The classifier is trained on a bounded sample of them,
at most ``SAMPLE`` documents in equal shares a language, chosen by a hash: follow-the-
regularised-leader with an elastic net (``L1``, ``L2``). Every fifth sampled document is kept
back to fit one temperature, by which the scores are divided so that they are probabilities.

The driver gets the document frequencies (one number a place), the sample's features, and
returns the weights, a broadcast of ``DIMENSIONS`` numbers a language.

Rows: a text that is null or has no letter is ``und`` with score 0. With nothing to learn
from every text is ``und``. Repeated rows stay. Extra columns stay; columns with the names of
the outputs are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.support import row_slices, text_bytes

DIMENSIONS = 1 << 15
# N-grams that every text is granted in its coverage: a few unknown ones prove nothing.
TAKEN_AS_SEEN = 10
SAMPLE = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-3, 1e-3
_PASS = 1 << 22  # characters of one text counted at a time
_SLICE = 1 << 20  # bytes of texts of a batch that are Python strings at a time
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter(map(str.isalpha, map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1)
    return _letters


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams of a text and how often each occurs; empty without letters."""
    total = None
    for start in range(0, len(text), _PASS):
        # Parts overlap by two characters, so every n-gram is in one of them.
        part = text[max(start - 2, 0) : start + _PASS].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        letter = _letter_table()[codes]
        if not letter.any():
            continue
        codes = np.where(letter, codes, np.uint64(32))
        codes = codes[np.concatenate([[True], letter[1:] | letter[:-1]])]  # one space for each run
        codes = np.concatenate([np.array([32], np.uint64), codes, np.array([32], np.uint64)])
        two = codes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        three = (two[:-1] ^ codes[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
        places = np.concatenate([two * np.uint64(0xD6E8FEB86659FD93), three]) >> np.uint64(64 - 15)
        found = np.bincount(places.astype(np.int64), minlength=DIMENSIONS)
        total = found if total is None else total + found
    if total is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.flatnonzero(total)
    return places, total[places]


def weights(places: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(times)) * idf[places]
    return x / max(np.sqrt(x @ x), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # a row a place, a column a language
    bias: np.ndarray
    temperature: float
    seen: np.ndarray | None = None  # which places the training sample has

    def logits(self, places: np.ndarray, times: np.ndarray) -> np.ndarray:
        return weights(places, times, self.idf) @ self.weights[places] + self.bias

    def coverage(self, places: np.ndarray, times: np.ndarray) -> float:
        """The share of a text's n-grams that the training sample has, short texts drawn towards 1; 0 without any.

        The sample is of bounded size, so the share does not grow with the corpus.
        """
        if self.seen is None or not len(places):
            return 0.0
        return float((times[self.seen[places]].sum() + TAKEN_AS_SEEN) / (times.sum() + TAKEN_AS_SEEN))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(*counts(text or ""))

    def judge(self, places: np.ndarray, times: np.ndarray) -> tuple[str, float]:
        """``predict`` from the counted n-grams."""
        if not len(places) or not self.languages:
            return "und", 0.0
        p = _softmax(self.logits(places, times) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """Fit weights and temperature; ``rows`` are language, places and counts, in a fixed order."""
    languages = sorted({r[0] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    fitted = [r for i, r in enumerate(rows) if i % 5 or len(rows) < 10]
    kept_back = rows[::5]
    c = len(languages)
    z, n = np.zeros((DIMENSIONS + 1, c)), np.zeros((DIMENSIONS + 1, c))

    def current(at: np.ndarray) -> np.ndarray:
        zs, lead = z[at], (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / lead)

    for _ in range(EPOCHS):
        for language, places, times in fitted:
            at = np.append(places, DIMENSIONS)  # the last place is the bias
            x = np.append(weights(places, times, idf), 1.0)
            w = current(at)
            slope = _softmax(x @ w)
            slope[number[language]] -= 1
            g = x[:, None] * slope
            old = n[at]
            z[at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / ALPHA * w
            n[at] = old + g * g
    w = current(np.arange(DIMENSIONS + 1))
    model = Model(languages, idf, w[:-1].astype(np.float32), w[-1], 1.0)
    if kept_back and c > 1:
        logits = np.array([model.logits(places, times) for _, places, times in kept_back])
        truth = np.array([number[r[0]] for r in kept_back])
        model.temperature = _temperature(logits, truth)
    return model


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of least log loss between 1/e and e**3, by golden section on its logarithm."""
    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, step = -1.0, 3.0, (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - step * (high - low), low + step * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _parts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``_SLICE`` bytes of text, or of one row."""
    for batch in batches:
        for a, b in row_slices(text_bytes(batch.column(text))[1], _SLICE):
            yield batch.slice(a, b - a)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, documents = np.zeros(DIMENSIONS, np.int64), 0
    for part in _parts(batches, "text"):
        for text in part.column("text").to_pylist():
            places, _ = counts(text or "")
            seen[places] += 1
            documents += len(places) > 0
    there = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(there, -1)), pa.array(np.append(seen[there], documents))], names=["place", "n"]
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches, "text"):
        found = [counts(t or "") for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("lang"), part.column("chance"),
                pa.array([p.astype("<u2").tobytes() for p, _ in found], pa.binary()),
                pa.array([t.astype("<u4").tobytes() for _, t in found], pa.binary()),
            ],
            names=["lang", "chance", "places", "times"],
        )


def fit(df: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Train on all rows of ``df`` with a language; the rows have to be those that may be learned from."""
    rows = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).dropna(subset=["lang", "text"])
    frequent = rows.select("text").mapInArrow(_frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    seen = {r.place: r.n for r in frequent.collect()}
    documents = seen.pop(-1, 0)
    idf = np.full(DIMENSIONS, np.log(1.0 + documents) + 1)
    for place, n in seen.items():
        idf[place] = np.log((1 + documents) / (1 + n)) + 1
    by_language = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = by_language.count()
    if not languages:
        return Model([], idf, np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0), 1.0)
    share = max(1, sample // languages)
    # One row a language, counted above; without the hint all texts would be dealt out by language.
    by_language = F.broadcast(by_language) if languages <= 10_000 else by_language
    # Rows are thinned by hash before they are numbered, so a language brings few more than its share.
    chance = (F.xxhash64("text", "lang").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    drawn = rows.withColumn("chance", chance).join(by_language, "lang").filter(F.col("chance") * F.col("n") <= 2.0 * share + 50)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("chance", "text"))
    drawn = drawn.withColumn("i", place).filter(F.col("i") <= share).select("text", "lang", "chance")
    features = drawn.mapInArrow(_features, "lang string, chance double, places binary, times binary").collect()
    features.sort(key=lambda r: (r.chance, r.lang, r.places, r.times))
    learned = [(r.lang, np.frombuffer(r.places, "<u2").astype(np.int64), np.frombuffer(r.times, "<u4")) for r in features if r.places]
    model = train(learned, idf)
    model.seen = np.zeros(DIMENSIONS, bool)
    for _, places, _ in learned:
        model.seen[places] = True
    return model


def judged(batches: Iterator[pa.RecordBatch], model: Model, text: str, kept: list[str], coverage: bool) -> Iterator[pa.RecordBatch]:
    """The columns ``kept`` with the outputs of :func:`identify`; the n-grams of one text are held at a time."""
    names = [*kept, "lang_pred", "score", *(["coverage"] if coverage else [])]
    for part in _parts(batches, text):
        found = []
        for t in part.column(text).to_pylist():
            grams = counts(t or "")
            found.append((*model.judge(*grams), model.coverage(*grams) if coverage else 0.0))
        out = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *out][: len(names)], names=names)


def identify(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] | None = None, coverage: bool = False) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to ``df`` (or to its columns ``keep``); only the text is looked at.

    With ``coverage`` also the share of the text's n-grams that training has seen. The score says
    which learned language is likely, the coverage whether it is one of them at all: it does not
    depend on how many there are.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    new = ("lang_pred", "score", *(("coverage",) if coverage else ()))
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]

    # A text that is kept goes to Python once.
    given = text if text in kept else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from judged(batches, shared.value, given, kept, coverage)

    source = df.select(*[F.col(f"`{c}`") for c in kept], *([] if text in kept else [F.col(f"`{text}`").alias("__text")]))
    empty = [F.lit("").alias("lang_pred"), *[F.lit(0.0).alias(c) for c in new[1:]]]
    schema = source.select(*[f"`{c}`" for c in kept], *empty).schema
    return source.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document must not be learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
