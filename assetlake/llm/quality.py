"""Quality of texts by a regularised quadratic discriminant over document statistics.

Each whole text becomes a vector of statistics (shares of kinds of signs, word lengths, repetition
of words, pairs and lines, entropy), transformed so that they are about normal: shares as log odds, smoothed
for short texts, sizes as logarithms.  Each class of the labelled rows has a mean and a covariance.
A covariance is drawn to the pooled one, the more the fewer rows the class has (by
p / (p + rows) for p statistics), and then by ``ridge`` to the diagonal of its own variances, so
that it can be inverted whatever the rows.  Its Cholesky factor is computed once and broadcast; the
score is the difference of the two Mahalanobis log densities and log shares, passed through a
logistic scale fitted on the same labelled rows, as densities of dependent statistics are too sure.

The fit reads every usable labelled row: the moments are sums over tasks, p * p numbers a class,
and so are the two numbers of the logistic scale; nothing is sampled.

Edge cases: null, empty and blank texts have the statistics of a text without signs and are scored;
without labelled rows of both kinds every score is the share of rows with label 1 (one half if
there are none); null labels and labels of unknown documents are ignored; a document with labels
of both kinds has the lower one; rows repeated under one doc_id are rows each; equal texts get
equal scores; long texts are read whole.  Only ``doc_id`` (to join the labels) and ``text`` are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from assetlake.sources.scratch import stored

from .words import blocks

RIDGE = 0.05
SCALE_STEPS = 8
# Kinds of bytes: letter, capital, digit, blank, stop, mark of emphasis, other sign, byte beyond ASCII.
_KIND = np.full(256, 6)
_KIND[[*range(97, 123)]], _KIND[[*range(65, 91)]], _KIND[[*range(48, 58)]] = 0, 1, 2
_KIND[[32, 9, 10, 11, 12, 13]], _KIND[[ord(c) for c in ".,;:'\"-()"]], _KIND[[33, 63]] = 3, 4, 5
_KIND[128:] = 7
_SIGNS = frozenset(b"!?#$%&*+/<=>@[\\]^_`{|}~")
_MEMO = 1 << 18
NAMES = (
    "words", "word_length", "word_spread", "longest", "capitals", "digits", "stops", "emphasis", "signs", "beyond",
    "blanks", "signed_words", "capital_words", "repeated", "variety", "pairs", "commonest", "lines", "line_length", "entropy",
)


def _odds(part: float, whole: float) -> float:
    """Log odds of a share, drawn to one half by a few unseen signs."""
    return math.log((part + 0.5) / (whole - part + 0.5))


def _shares(part: float, whole: float) -> float:
    """Log odds of a share of rare things: a text without any looks like 1 in 2000."""
    share = (part + 0.0005 * 200) / (whole + 200)
    return math.log(share / (1 - share))


class Statistics:
    """Turns texts into vectors; remembers the traits of words, _MEMO at most."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, bool, bool]] = {}

    def _traits(self, word: bytes) -> tuple[int, bool, bool]:
        """Code points, whether it ends in a sign, whether it begins with a capital."""
        found = self.known.get(word)
        if found is None:
            text = word.decode("utf-8", "surrogatepass")
            found = len(text), word[-1] in _SIGNS, text[0].isupper()
            if len(self.known) < _MEMO:
                self.known[word] = found
        return found

    def of(self, text: str | None) -> list[float]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        kinds = np.bincount(_KIND, weights=counts, minlength=8)
        size, words = len(raw), raw.split()
        n = len(words)
        traits = [self._traits(w) for w in words]
        lengths = np.array([t[0] for t in traits] or [0])
        letters = kinds[0] + kinds[1] + kinds[7]
        seen = Counter(words)
        pairs = len(set(zip(words, words[1:], strict=False)))
        repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
        lines = [x for x in raw.split(b"\n") if x]
        shares = counts[counts > 0] / max(size, 1)
        return [
            math.log1p(n),
            math.log1p(lengths.mean()),
            math.log1p(lengths.std()),
            math.log1p(lengths.max()),
            _shares(kinds[1], letters),
            _shares(kinds[2], size),
            _shares(kinds[4], size),
            _shares(kinds[5], size),
            _shares(kinds[6], size),
            _odds(kinds[7], size),
            _shares(kinds[3], size),
            _shares(sum(t[1] for t in traits), n),
            _shares(sum(t[2] for t in traits), n),
            _shares(repeated, n),
            math.log1p(len(seen)) / math.log(n + 2),
            math.log1p(pairs) / math.log(n + 2),
            _shares(max(seen.values(), default=0), n),
            _shares(len(lines) - len(set(lines)), len(lines)),
            math.log1p(size / max(len(lines), 1)),
            float(-(shares * np.log(shares)).sum()),
        ]


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_statistics`` beside all its columns."""
    docs = docs.drop("_statistics")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reads = Statistics()
        for batch in blocks(batches, "text"):
            vectors = [reads.of(t) for t in batch.column("text").to_pylist()]
            column = pa.array(vectors, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "_statistics"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(measure, f"{fields}, _statistics array<double>")


@dataclass
class Discriminant:
    """Two Gaussians by mean, inverse Cholesky factor and log density at the mean, and a logistic scale."""

    means: np.ndarray
    factors: np.ndarray
    heights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, vectors: np.ndarray) -> np.ndarray:
        """Log density and share of class 1 less those of class 0."""
        densities = [
            h - 0.5 * (((vectors - m) @ f.T) ** 2).sum(axis=1) for m, f, h in zip(self.means, self.factors, self.heights, strict=True)
        ]
        return densities[1] - densities[0]

    def score(self, vectors: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(vectors) + self.shift, -60, 60)))


def discriminant(rows: np.ndarray, sums: np.ndarray, squares: np.ndarray, ridge: float = RIDGE) -> Discriminant:
    """From the rows, sums and sums of products of both classes."""
    p = sums.shape[1]
    means = sums / rows[:, None]
    spread = [squares[c] - rows[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (spread[0] + spread[1]) / rows.sum()
    factors, heights = [], []
    for c in (0, 1):
        drawn = p / (p + rows[c])
        covariance = (1 - drawn) * spread[c] / rows[c] + drawn * pooled
        covariance = (1 - ridge) * covariance + ridge * np.diag(np.diag(covariance)) + 1e-6 * np.eye(p)
        factor = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(factor))
        heights.append(math.log(rows[c] / rows.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(factors), np.array(heights))


def _task_sums(known: DataFrame, make, width: int) -> np.ndarray:
    """The sum over all tasks of ``make(labels, vectors)``, ``width`` numbers."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if len(batch):
                vectors = np.array(batch.column("_statistics").to_pylist())
                total += make(batch.column("label").to_numpy(), vectors)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["place", "value"])

    parts = known.select("label", "_statistics").mapInArrow(add, "place long, value double")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()  # ``width`` rows
    total = np.zeros(width)
    total[found["place"].to_numpy()] = found["value"].to_numpy()
    return total


def fit(known: DataFrame, ridge: float = RIDGE) -> Discriminant | float:
    """From rows (label 0 or 1, _statistics); the share of label 1 if one kind of label is missing."""
    p = len(NAMES)

    def moments(labels: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        sums = []
        for c in (0, 1):
            mine = vectors[labels == c]
            sums += [np.array([len(mine)]), mine.sum(axis=0), (mine.T @ mine).ravel()]
        return np.concatenate(sums)

    found = _task_sums(known, moments, 2 * (1 + p + p * p)).reshape(2, 1 + p + p * p)
    rows = found[:, 0]
    if not rows.all():
        return float(rows[1] / rows.sum()) if rows.sum() else 0.5
    model = discriminant(rows, found[:, 1 : 1 + p], found[:, 1 + p :].reshape(2, p, p), ridge)
    # the logistic scale, by Newton steps on sums of five numbers; both classes count alike in it
    share = rows / rows.sum()
    model.slope = 0.2
    for _ in range(SCALE_STEPS):

        def newton(labels: np.ndarray, vectors: np.ndarray, now: Discriminant = model) -> np.ndarray:
            margin = np.clip(now.margin(vectors), -200, 200)
            chance = 1 / (1 + np.exp(-np.clip(now.slope * margin + now.shift, -60, 60)))
            weight = 0.5 / share[labels.astype(int)]
            curve = weight * chance * (1 - chance)
            off = weight * (labels - chance)
            return np.array([(off * margin).sum(), off.sum(), (curve * margin**2).sum(), (curve * margin).sum(), curve.sum()])

        a, b, aa, ab, bb = _task_sums(known, newton, 5) / rows.sum()
        aa, bb = aa + 1e-3, bb + 1e-3
        a, b = a - 1e-3 * (model.slope - 0.2), b - 1e-3 * model.shift  # a weak pull to the start keeps separable rows finite
        step = np.linalg.solve([[aa, ab], [ab, bb]], [a, b])
        step /= max(1.0, np.abs(step).max())
        model = Discriminant(model.means, model.factors, model.heights, max(model.slope + step[0], 1e-3), model.shift + step[1])
        if np.abs(step).max() < 1e-4:
            break
    return model


def scored(measured: DataFrame, model: Discriminant | float) -> DataFrame:
    """``measured`` with ``_quality`` (0 to 1) in place of ``_statistics``."""
    if isinstance(model, float):
        return measured.drop("_statistics").withColumn("_quality", F.lit(model))
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.array(batch.column("_statistics").to_pylist()).reshape(-1, len(NAMES))
            kept = batch.drop_columns(["_statistics"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(shared.value.score(vectors))], [*kept.schema.names, "_quality"])

    fields = [f for f in measured.schema.fields if f.name != "_statistics"]
    return measured.mapInArrow(score, StructType([*fields, StructField("_quality", DoubleType())]))


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the documents whose labels are only for testing."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, ridge: float = RIDGE) -> DataFrame:
    """doc_id and ``_quality`` of every row of ``docs``, learnt from the labels that are not held out."""
    marks = labels.where("quality is not null and doc_id is not null").where(~held_out())
    marks = marks.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("label"))
    measured = stored(statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    known = stored(measured.join(marks, "doc_id"), "labelled")
    return scored(measured, fit(known, ridge))
