"""Toxicity of texts that may be disguised: a noisy-channel decoder before a linear score.

Writers hide words by look-alike signs (l0ser), by spacing (l o s e r) and by repetition
(loooser).  Each suspicious stretch of a text becomes a lattice of what its signs may stand for;
a Viterbi search finds the restoration that a character language model and the costs of the
channel together make likeliest.  The rest of the text has one path through its lattice and stays
as it is.

* The language model counts character 4-grams (26 letters with accents folded, a border, other
  signs) over every text of the corpus; it has 28**4 numbers at most, whatever the corpus.
* The score is a logistic regression over prefixes and whole words of the restored text.  It is
  fitted on labelled rows, at most ``max_rows`` different ones, chosen by a hash of the text; that is
  the one bounded sample here.  The model has at most ``max_features`` features: of those met in
  MIN_DOCS rows or more, the ones whose presence tells most about the label (the G statistic of
  presence against label over those rows, ties by the feature itself), found by a distributed
  order and limit.  The bound is one of the model, whatever the vocabulary; no other feature has a weight.
* A text is scored by windows of WINDOW words, each starting half a window after the one before,
  and has the score of its worst window; so a long text is not toxic by its length alone.  What is
  learnt from are the windows of the clean rows, and the toxic rows as a whole, as nobody says which
  of their windows are toxic.
* Both models are broadcast: 28**4 numbers, and the weights other than zero (``max_features`` at most).

Edge cases: null, empty and blank texts get the score of a text without words; without labelled
rows of both kinds every score is the share of toxic rows (0 if there are none); null labels and
labels of unknown documents are ignored; several labels of one document count as toxic if any
is; every window of a text is scored; equal texts get equal scores; rows repeated under one doc_id are
scored each, and repeated equal rows are one row to learn from with their number as its weight.  No
other column is read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from assetlake.sources.scratch import stored

from .words import blocks

LETTERS = 28  # a-z, border, other
BORDER, OTHER = 26, 27
MIN_DOCS = 3
WINDOW = 256
PREFIXES = (3, 4, 5, 7)
MAX_ROWS = 20_000
MAX_FEATURES = 1 << 13
FIT_TASKS = 16
KEPT_WORDS, KEPT_DULL = 1 << 16, 1 << 18
COUNTED_AT_ONCE = 1 << 20
# Signs and the letters they may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c",
}
# Costs in nats: a sign for a letter, a letter struck twice, more often, a letter set apart, a sign kept inside a word.
SWAP, TWICE, AGAIN, APART, KEPT = 1.5, 3.0, 1.0, 0.5, 6.0
_SIGNS = regex.escape("".join(LOOK_ALIKES), special_only=False)
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_FOLDED = "aaaaaaceeeeiiiinooooouuuuyy"
WORD = regex.compile(r"\S+")
LONE = rf"(?<![\p{{L}}\p{{M}}\d])[\p{{L}}{_SIGNS}](?![\p{{L}}\p{{M}}\d])"
SPACED = regex.compile(rf"(?<!\S){LONE}(?:[ .\-_*]{{1,2}}{LONE}){{2,}}(?![^\s.,;:!?])")
# What every spaced stretch, and every repetition, holds: cheap to look for first.
STOPS = ".,;:?"
MAYBE_SPACED = re.compile(r"(?<!\S)\S[ .\-_*]{1,2}\S[ .\-_*]{1,2}\S(?![^\W_])")
REPEATED = re.compile(r"(.)\1\1")
DISGUISED = regex.compile(rf"\p{{L}}[{_SIGNS}]+\p{{L}}|(?<!\S)[{_SIGNS}]\p{{L}}|\p{{L}}[{_SIGNS.replace("!", "")}](?=\P{{L}}*(?:\s|$))|(\p{{L}})\1\1")
EDGES = regex.compile(r"^[\P{L}]+|[\P{L}]+$")


def letter_codes() -> bytes:
    """The code of each Latin-1 sign: lower case, accents folded."""
    codes = bytearray([OTHER]) * 256
    for i in range(26):
        codes[97 + i] = codes[65 + i] = i
    for accented, plain in zip(_ACCENTED, _FOLDED, strict=True):
        codes[ord(accented)] = ord(plain) - 97
        if ord(accented) != 255:  # its capital is not in Latin-1
            codes[ord(accented.upper())] = ord(plain) - 97
    for blank in b" \t\n\r\v\f":
        codes[blank] = BORDER
    return bytes(codes)


_CODES = letter_codes()


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("latin-1", "replace").translate(_CODES), np.uint8)


@lru_cache(maxsize=1 << 12)
def reading_codes(reading: str) -> tuple[int, ...]:
    return tuple(codes_of(reading).tolist())


def tripled(text: str) -> bool:
    """Whether a sign stands three times in a row anywhere in a text."""
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    same = signs[1:] == signs[:-1]
    return bool((same[1:] & same[:-1]).any())


def character_counts(docs: DataFrame) -> np.ndarray:
    """4-gram counts over all texts; each task sends one row per 4-gram it met."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LETTERS**4, np.int64)
        for batch in blocks(batches, "text"):
            # three borders stand between two texts, so no 4-gram holds letters of both
            whole = codes_of("   ".join(["", *(t for t in batch.column("text").to_pylist() if t is not None), ""]))
            for start in range(0, len(whole) - 3, COUNTED_AT_ONCE):
                codes = whole[start : start + COUNTED_AT_ONCE + 3].astype(np.int32)
                grams = ((codes[:-3] * LETTERS + codes[1:-2]) * LETTERS + codes[2:-1]) * LETTERS + codes[3:]
                counts += np.bincount(grams, minlength=LETTERS**4)
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["gram", "n"])

    found = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(LETTERS**4)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()  # at most 28**4 rows
    return counts


def language_model(counts: np.ndarray) -> np.ndarray:
    """Costs (negative logs) of a sign after three, smoothed with those after two, one and none."""
    total = counts.reshape(LETTERS, LETTERS, LETTERS, LETTERS)
    chances = np.full(LETTERS, 1 / LETTERS)
    for known in range(4):
        seen = total.sum(axis=tuple(range(3 - known)))
        chances = (seen + 5 * chances) / (seen.sum(axis=-1, keepdims=True) + 5)
    return -np.log(chances).ravel().astype(np.float32)


class Decoder:
    """Finds the likeliest reading of a stretch of text."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()

    def best(self, options: list[list[tuple[float, str]]]) -> str:
        """Viterbi over a lattice: at each place, readings with their channel costs."""
        start = (BORDER * LETTERS + BORDER) * LETTERS + BORDER
        paths = {start: (0.0, None)}
        for readings in [*options, [(0.0, " ")]]:
            reached: dict[int, tuple] = {}
            for state, (cost, path) in paths.items():
                for extra, reading in readings:
                    now, total = state, cost + extra
                    for code in reading_codes(reading):
                        total += self.costs[now * LETTERS + code]
                        now = now % (LETTERS * LETTERS) * LETTERS + code
                    if now not in reached or total < reached[now][0]:
                        reached[now] = (total, (path, reading))
            paths = reached
        path, parts = min(paths.values(), key=lambda p: p[0])[1], []
        while path:
            path, reading = path
            parts.append(reading)
        return "".join(reversed(parts))[:-1]

    def readings(self, sign: str, times: int, inside: bool) -> list[tuple[float, str]]:
        """What a run of one sign may stand for."""
        again = 0.0 if times == 1 else TWICE if times == 2 else AGAIN * math.log(times)
        if sign.isalpha():
            return [(0.0 if times <= 2 else KEPT, sign * min(times, 2)), (again, sign)]
        found = [(KEPT if inside else SWAP / 3, sign * times)]
        for letter in LOOK_ALIKES.get(sign, ""):
            found += [(SWAP + again, letter), (SWAP * times, letter * min(times, 2))]
        return found

    def word(self, word: str) -> str:
        """The restored form of a disguised word, without the signs behind it."""
        body = word.lower().rstrip(".,;:!?*#%&\"')")
        runs = [*regex.finditer(r"(?s)(.)\1*", body)]
        return self.best([self.readings(m[1], len(m[0]), m.start() > 0 and m.end() < len(body)) for m in runs])

    def stretch(self, stretch: str) -> str:
        """The restored form of letters set apart: joined to words where that is likelier."""
        options: list[list[tuple[float, str]]] = []
        for letter in regex.findall(rf"[\p{{L}}{_SIGNS}]", stretch.lower()):
            if options:
                options.append([(APART, ""), (0.0, " ")])
            options.append(self.readings(letter, 1, True))
        return self.best(options)


class Reader:
    """Turns texts into features; remembers words with features, KEPT_WORDS at most."""

    def __init__(self, costs: np.ndarray, weights: dict[str, float] | None = None):
        self.decoder = Decoder(costs)
        self.weights = weights  # features without a weight are not kept
        self.starts = None if weights is None else {f[: PREFIXES[0]] for f in weights}
        self.known: dict[str, tuple[str, ...]] = {}
        self.read: dict[str, str] = {}
        self.dull: set[str] = set()  # words without features that count, KEPT_DULL at most

    def restored(self, text: str) -> str:
        """The text with its disguised stretches restored."""
        text = SPACED.sub(lambda m: self._remember(m[0], self.decoder.stretch), text)
        return WORD.sub(lambda m: self._word(m[0]), text)

    def _word(self, word: str) -> str:
        return self._remember(word, self.decoder.word) if DISGUISED.search(word) else word

    def _remember(self, key: str, make) -> str:
        found = self.read.get(key)
        if found is None:
            if len(self.read) >= KEPT_WORDS:
                self.read.clear()
            found = self.read[key] = make(key)
        return found

    def _of_word(self, word: str) -> tuple[str, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KEPT_WORDS:
                self.known.clear()
            shown = word
            if (not word.isalpha() or REPEATED.search(word)) and DISGUISED.search(word):
                shown = self._remember(word, self.decoder.word)
            plain = shown.lower()
            if not plain.isalpha():
                plain = EDGES.sub("", plain)
            parts = (plain + "$", *(plain[:k] for k in PREFIXES if len(plain) >= k)) if plain else ()
            found = self.known[word] = parts if self.weights is None else tuple(p for p in parts if p in self.weights)
        return found

    def places(self, text: str | None) -> tuple[list[tuple[int, tuple[str, ...]]], int]:
        """The features of each word that has any, with its place, and the number of words.

        Words beside restored stretches count as they stand, too.  Stops behind a word tell nothing
        and are cut off before it is looked up.
        """
        words, telling, fresh = (text or "").split(), {}, []
        plainly = self.starts is not None and not (words and tripled(text))
        for word in set(words).difference(self.dull):
            bare = word.rstrip(STOPS)
            # most words are letters alone and begin like no feature with a weight
            if plainly and bare.isalpha() and (bare.lower() + "$")[: PREFIXES[0]] not in self.starts:
                fresh.append(word)
            elif features := self._of_word(bare):
                telling[word] = features
            else:
                fresh.append(word)
        if len(self.dull) + len(fresh) > KEPT_DULL:
            self.dull.clear()
        self.dull.update(fresh)
        found = [(i, telling[w]) for i, w in enumerate(words) if w in telling] if telling else []
        at = before = 0
        for match in SPACED.finditer(text) if words and MAYBE_SPACED.search(text) else ():
            before, at = before + len(text[at : match.start()].split()), match.start()
            found += [(before, f) for f in map(self._of_word, self._remember(match[0], self.decoder.stretch).split()) if f]
        return found, len(words)

    def windows(self, text: str | None, step: int) -> list[set[str]]:
        """The features of each window of the text; one window begins ``step`` words after the other."""
        found, n = self.places(text)
        if n <= WINDOW:
            return [set().union(*(f for _, f in found))]
        sets = [set() for _ in range(1 + -(-(n - WINDOW) // step))]
        for i, features in found:
            for k in range(max(0, (i - WINDOW) // step + 1), min(i // step + 1, len(sets))):
                sets[k].update(features)
        return sets

    def features(self, text: str | None) -> set[str]:
        """The features of the whole text."""
        return set().union(*(f for _, f in self.places(text)[0]))

    def score(self, text: str | None) -> float:
        """The sum of weights of the worst window."""
        return max(math.fsum(self.weights[k] for k in w) for w in self.windows(text, WINDOW // 2))


def learn(
    docs: DataFrame, labels: DataFrame, costs: np.ndarray, usable: Column, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES
) -> tuple[dict[str, float], float]:
    """Weights of the features other than zero, and the intercept.

    ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); ``usable`` says from the doc_id which labels may be used.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    spark = docs.sparkSession
    marks = labels.where("toxic is not null and doc_id is not null").where(usable)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    known = docs.select("doc_id", "key").join(marks, "doc_id").groupBy("doc_id", "key", "label").agg(F.count("key").alias("times"))
    chosen = known.orderBy("key", "doc_id").limit(max_rows)
    # max_rows rows at most; equal rows are one, with their number
    rows = docs.join(F.broadcast(chosen), ["doc_id", "key"]).dropDuplicates(["doc_id", "key"])
    shared = spark.sparkContext.broadcast(costs)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            reads, found, fresh, owners, shares = reader(shared), [], [], [], []
            for i, (text, label) in enumerate(zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                sets = [reads.features(text)] if label else reads.windows(text, WINDOW)
                seen: set[str] = set()
                for mine in sets:
                    new = mine - seen
                    seen |= new
                    fresh.append(len(new)), found.append([*new, *(mine - new)])
                owners += [i] * len(sets)
                shares += [1 / len(sets)] * len(sets)
            of = batch.select(["label", "times"]).take(pa.array(owners, pa.int64()))
            first = np.diff(owners, prepend=-1) > 0
            columns = [pa.array(first), pa.array(shares, pa.float64()), pa.array(fresh, pa.int32()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*of.columns, *columns], ["label", "times", "first", "share", "fresh", "features"])

    # ``first`` marks one window of each row; ``fresh``: so many of the features, the first ones, are in no window before
    schema = "label double, times long, first boolean, share double, fresh int, features array<string>"
    rows = stored(rows.select("text", "label", "times").mapInArrow(read, schema), "labelled")
    n, toxic = rows.where("first").agg(F.sum("times"), F.sum(F.col("times") * F.col("label"))).first()
    if not n or not 0 < toxic < n:
        share = (toxic or 0.0) / max(n or 0, 1)
        return {}, math.log(max(share, 1e-9) / max(1 - share, 1e-9))
    fresh = rows.select("label", "times", F.explode(F.slice("features", F.lit(1), F.col("fresh"))).alias("feature"))
    counts = fresh.groupBy("feature").agg(F.count("feature").alias("rows"), F.sum("times").alias("n"), F.sum(F.col("times") * F.col("label")).alias("t"))

    def part(seen: Column, total: float, share: Column) -> Column:
        """One cell of the G statistic: seen * log(seen / expected)."""
        return F.when(seen > 0, seen * F.log(seen / (share * total))).otherwise(0.0)

    held = F.col("n") / n
    told = part(F.col("t"), toxic, held) + part(F.col("n") - F.col("t"), n - toxic, held)
    told += part(toxic - F.col("t"), toxic, 1 - held) + part(n - toxic - F.col("n") + F.col("t"), n - toxic, 1 - held)
    usual = counts.where(F.col("rows") >= MIN_DOCS).orderBy(F.round(told, 6).desc(), "feature").select("feature").limit(max_features)
    vocabulary = usual.toArrow()["feature"].to_pylist()  # max_features at most
    if not vocabulary:
        return {}, math.log(toxic / (n - toxic))
    # sparse weights; the windows of a row count as one together, and toxic rows twice: they are few
    weight = (F.col("label") + 1.0) * F.col("share") * F.col("times")
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="features", outputCol="vector").setBinary(True)
    train = vectors.transform(rows.select("label", weight.alias("weight"), "features")).select("label", "weight", "vector")
    train = stored(train.coalesce(FIT_TASKS), "vectors").persist()
    try:
        model = LogisticRegression(
            featuresCol="vector", maxIter=60, regParam=0.0003, elasticNetParam=1.0, standardization=False, weightCol="weight"
        ).fit(train)
        weights = model.coefficients.toArray()
        return {vocabulary[i]: float(weights[i]) for i in np.nonzero(weights)[0]}, float(model.intercept)
    finally:
        train.unpersist()


_READERS: dict[tuple, Reader] = {}


def reader(shared, linear=None) -> Reader:
    """One reader per worker process and models."""
    key = tuple(b._jbroadcast_id if hasattr(b, "_jbroadcast_id") else id(b.value) for b in (shared, linear) if b is not None)
    if key not in _READERS:
        _READERS.clear()
        _READERS[key] = Reader(shared.value, linear.value[0] if linear is not None else None)
    return _READERS[key]


def scored(docs: DataFrame, costs: np.ndarray, weights: tuple[dict[int, float], float]) -> DataFrame:
    """``docs`` with ``_toxicity`` (0 to 1, in place of a column of that name) beside all its columns."""
    docs = docs.drop("_toxicity")
    context = docs.sparkSession.sparkContext
    model, linear = context.broadcast(costs), context.broadcast(weights)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reads, intercept = reader(model, linear), linear.value[1]
        for batch in blocks(batches, "text"):
            sums = [intercept + reads.score(t) for t in batch.column("text").to_pylist()]
            chances = 1 / (1 + np.exp(-np.clip(sums, -60, 60)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chances, pa.float64())], [*batch.schema.names, "_toxicity"])

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField("_toxicity", DoubleType())]))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the documents whose labels are only for testing."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` with ``_toxicity``, learnt from the labels that are not held out."""
    costs = language_model(character_counts(docs))
    weights = learn(docs, labels, costs, ~held_out(), max_rows)
    return scored(docs, costs, weights)
