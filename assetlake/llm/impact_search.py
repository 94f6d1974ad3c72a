"""Ranked lexical search by the Best Position Algorithm.

Terms are longest runs of letters and digits of ASCII and of all signs beyond it, A-Z lower-cased.
A term's weight falls with the documents that hold it; its impact on a document rises with its
occurrences there and falls with the document's length.  A document's score for an item is the
sum of the impacts of the item's terms, repeats included.  All of it is whole numbers but the
logarithm in the weight.

* One pass counts the documents that hold each term of an item, all documents and all their terms.
* The second pass searches.  Each task gathers blocks of about BLOCK_POSTINGS postings (more only
  where one document holds more) and lays out, for each term, its impact list: documents by falling
  impact.  The lists of an item are read from their tops in turns.  A document met for the first
  time is looked up directly in the item's other lists, so its whole score is known and its
  positions there count as seen as well.  The best position of a list is the end of its seen
  positions without a gap; a document not met yet has, in each list, the impact of the position
  after it at most.  The search of a block ends once the sum of these is strictly below the k-th
  score that the task knows by then, from this block and those before it: so equal scores are
  never lost.  Lists that are read to their end add nothing.
* Each task returns its k best documents of each item.  They are cut to k in two steps, first
  within SALTS parts of an item, then as a whole, so no task gets all the candidates of an item.

The items are the query set: they are taken in blocks of about ITEM_BYTES of text, each block read
by every task of a pass of its own, so what is broadcast does not grow with the documents.

Edge cases: null texts and texts without a term hold nothing, as documents and as items; long texts
are read whole; repeated documents are ranked each, equal scores by ascending doc_id, null ids last;
repeated equal items are one, several texts under one item_id are ranked each on its own; empty
tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .words import blocks

ITEM_BYTES = 8 << 20
BLOCK_POSTINGS = 1 << 20
SALTS = 64
FIRST_STEP = 32
# Every byte that ends a term becomes a blank; bytes above 0x7F belong to letters beyond ASCII.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


@dataclass
class Items:
    """A block of items: their texts' terms as numbers, with how often each occurs."""

    keys: list[tuple]
    words: dict[bytes, int]
    asked: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: Iterable[tuple]) -> Items:
        keys, words, asked = [], {}, []
        for item_id, text in rows:
            found = Counter(terms(text))
            if found:
                numbers = [words.setdefault(t, len(words)) for t in found]
                keys.append((item_id, text))
                asked.append((np.array(numbers), np.array(list(found.values()))))
        return cls(keys, words, asked)


def _numbers(texts: Iterable[str | None], words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of the terms asked for, and the terms of each text."""
    lengths, found = [], []
    for text in texts:
        mine = terms(text)
        lengths.append(len(mine))
        found.append(np.fromiter(map(words.get, mine, repeat(-1)), np.int64, len(mine)))
    numbers = np.concatenate([np.empty(0, np.int64), *found])
    owner = np.repeat(np.arange(len(lengths)), lengths)
    kept = numbers >= 0
    keys, times = np.unique(owner[kept] * len(words) + numbers[kept], return_counts=True)
    return np.stack([keys // len(words), keys % len(words), times]), np.array(lengths, np.int64)


def _statistics(docs: DataFrame, words: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        held, n_docs, n_terms = np.zeros(len(words), np.int64), 0, 0
        for batch in blocks(batches, "text"):
            postings, lengths = _numbers(batch.column("text").to_pylist(), words)
            held += np.bincount(postings[1], minlength=len(words))
            n_docs, n_terms = n_docs + int((lengths > 0).sum()), n_terms + int(lengths.sum())
        at = np.nonzero(held)[0]
        numbers, counts = [-2, -1, *at.tolist()], [n_docs, n_terms, *held[at].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(counts, pa.int64())], ["term", "n"])

    found = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    known = dict(zip(found["term"].to_pylist(), found["n"].to_pylist(), strict=True))  # a row per term of the items
    shared.unpersist()
    return known.get(-2, 0), known.get(-1, 0), np.array([known.get(i, 0) for i in range(len(words))], np.int64)


def weights(n_docs: int, held: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * h + 1))) for h in held.tolist()], np.int64)


class ImpactLists:
    """The impact lists of a block of documents, with direct access by document."""

    def __init__(self, postings: np.ndarray, n_terms: int, doc_order: np.ndarray):
        """``postings``: (document, term, impact) rows; ``doc_order``: the place of each document by its id."""
        docs, terms_, impacts = postings
        order = np.lexsort((doc_order[docs], -impacts, terms_))
        self.docs, self.impacts = docs[order], impacts[order]
        self.starts = np.searchsorted(terms_[order], np.arange(n_terms + 1))
        self.n_docs = len(doc_order)
        keys = terms_[order] * self.n_docs + self.docs
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]

    def direct(self, term: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the documents are in the list of a term, and their positions."""
        low, high = self.starts[term], self.starts[term + 1]
        at = low + np.searchsorted(self.keys[low:high], term * self.n_docs + docs)
        inside = at < high
        inside[inside] = self.keys[at[inside]] == term * self.n_docs + docs[inside]
        return inside, self.by_key[at[inside]]

    def best(self, asked: np.ndarray, times: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, among them all of the k best whose score reaches ``bar``."""
        lists = [(t, c) for t, c in zip(asked.tolist(), times.tolist(), strict=True) if self.starts[t + 1] > self.starts[t]]
        met = np.zeros(self.n_docs, bool)
        seen = [np.zeros(self.starts[t + 1] - self.starts[t], bool) for t, _ in lists]
        ends = [0] * len(lists)  # the first position of each list that is not seen: one after the best position
        found_docs, found_scores, kth, depth, step = [], [], bar, 0, FIRST_STEP
        while True:
            rest = 0
            for i, (t, c) in enumerate(lists):
                open_ = seen[i][ends[i] :]
                gap = int(open_.argmin()) if len(open_) else 0
                ends[i] += len(open_) if len(open_) and open_[gap] else gap
                if ends[i] < len(seen[i]):
                    rest += c * int(self.impacts[self.starts[t] + ends[i]])
            if not rest or rest < kth:
                break
            new = [self.docs[self.starts[t] + depth : min(self.starts[t] + depth + step, self.starts[t + 1])] for t, _ in lists]
            new = np.unique(np.concatenate(new))
            new = new[~met[new]]
            met[new] = True
            scores = np.zeros(len(new), np.int64)
            for i, (t, c) in enumerate(lists):
                inside, positions = self.direct(t, new)
                scores[inside] += c * self.impacts[positions]
                seen[i][positions - self.starts[t]] = True
            found_docs.append(new[scores >= kth]), found_scores.append(scores[scores >= kth])
            known = np.concatenate(found_scores)
            if len(known) >= k:
                kth = max(kth, int(np.partition(known, -k)[-k]))
            depth, step = depth + step, step * 2
        if not found_docs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, scores = np.concatenate(found_docs), np.concatenate(found_scores)
        return docs[scores >= max(kth, 1)], scores[scores >= max(kth, 1)]


class _Block:
    """Postings of one task, gathered until they are enough for a search."""

    def __init__(self):
        self.ids, self.postings, self.lengths, self.n, self.n_postings = [], [], [], 0, 0

    def add(self, ids: list, postings: np.ndarray, lengths: np.ndarray) -> None:
        postings[0] += self.n
        self.ids += ids
        self.postings.append(postings), self.lengths.append(lengths)
        self.n, self.n_postings = self.n + len(ids), self.n_postings + postings.shape[1]

    def lists(self, n_docs: int, n_terms: int, weight: np.ndarray) -> ImpactLists:
        docs, numbers, times = np.concatenate(self.postings, axis=1)
        length = 75 + 25 * np.concatenate(self.lengths) * n_docs // n_terms
        impacts = weight[numbers] * (1_000_000_000 * times // (1000 * times + 12 * length[docs]))
        places = np.empty(self.n, np.int64)
        places[sorted(range(self.n), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))] = np.arange(self.n)
        return ImpactLists(np.stack([docs, numbers, impacts]), len(weight), places)


def _found(docs: DataFrame, items: Items, k: int) -> DataFrame | None:
    """(item, doc_id, score): the best documents of each task."""
    n_docs, n_terms, held = _statistics(docs, items.words)
    if not n_docs:
        return None
    shared = docs.sparkSession.sparkContext.broadcast((items.words, items.asked, weights(n_docs, held)))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, asked, weight = shared.value
        best: list[list[tuple[int, bool, int | None]]] = [[] for _ in asked]  # (-score, no id, id)

        def take(block: _Block) -> None:
            lists = block.lists(n_docs, n_terms, weight)
            for i, (numbers, times) in enumerate(asked):
                bar = -best[i][-1][0] if len(best[i]) == k else 0
                rows, scores = lists.best(numbers, times, k, bar)
                if len(rows):
                    new = [(-s, block.ids[d] is None, block.ids[d]) for d, s in zip(rows.tolist(), scores.tolist(), strict=True)]
                    best[i] = sorted(best[i] + new, key=lambda x: (x[0], x[1], x[2] or 0))[:k]

        block = _Block()
        for batch in blocks(batches, "text"):
            block.add(batch.column("doc_id").to_pylist(), *_numbers(batch.column("text").to_pylist(), words))
            if block.n_postings >= BLOCK_POSTINGS:
                take(block)
                block = _Block()
        if block.n_postings:
            take(block)
        rows = [(i, doc_id, -score) for i, mine in enumerate(best) for score, _, doc_id in mine]
        columns = [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(search, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, item_text, rank (from 1), doc_id and score of each item's ``k`` best documents.

    ``docs`` (doc_id: long, text), ``items`` (item_id, text).
    """
    spark = docs.sparkSession
    items = items.select("item_id", "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // ITEM_BYTES)
    schema = f"_item long, item_id {items.schema['item_id'].dataType.simpleString()}, item_text string"
    ranked = spark.createDataFrame([], f"{schema.split(', ', 1)[1]}, rank int, doc_id long, score long")
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).toArrow()  # about ITEM_BYTES
        block = Items.of(sorted(zip(mine["item_id"].to_pylist(), mine["text"].to_pylist(), strict=True), key=repr))
        found = _found(docs, block, k) if block.keys else None
        if found is None:
            continue
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "_salt").orderBy(*order)))
        whole = Window.partitionBy("item").orderBy(*order)
        first = salted.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, *key) for i, key in enumerate(block.keys)], schema)
        named = first.join(F.broadcast(names), F.col("item") == F.col("_item"))  # the items of this block
        ranked = ranked.unionByName(named.select("item_id", "item_text", "rank", "doc_id", "score"))
    return ranked
