"""Removal of repeated passages: paragraphs compared by MinHash banding.

Two kinds of paragraphs are searched, both of at least ``min_words`` words:

* lines, as sets of word shingles: BANDS bands of ROWS coordinates each, tuned for recall (at a
  similarity of 0.8 a pair is missed once in 10,000), then verified by exact Jaccard similarity;
* passages inside lines and across them: from each anchor (a word that is the least by hash
  among WINDOW neighbours, so the same words have the same anchors in every text) the next
  PASSAGE words.  Whatever WINDOW + PASSAGE words or more two texts share holds a whole such
  passage, wherever it stands; these are equal or not, so one band of the whole is enough.

Equal paragraphs are grouped first; different lines that collide are compared with one leader of
each bucket, and what a bucket leaves in several components with the leaders of the others
(see ``fast_sketch``).  Clusters are connected components; the first place of a cluster (least
doc_id, then position) stays, the others are to be removed.

Edge cases: null, empty and short texts have no paragraphs; a passage repeated inside one document
only is no repeat across documents and stays; rows repeated under one doc_id are one document,
whose paragraphs are listed once per row;
rows with a null doc_id are left out, as nothing could be removed from them; a document is cut
whole, whatever its length.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

from .components import components
from .fast_sketch import alike, band_keys, bitmap, sketches
from .words import WordHashes, blocks, mixed, set_key, shingle_set, word_hashes

BANDS, ROWS = 12, 3
WINDOW, PASSAGE = 16, 35
_BASE = np.uint64(0x9E3779B97F4A7C15)


def anchors(hashes: np.ndarray, window: int = WINDOW, length: int = PASSAGE) -> np.ndarray:
    """Starts of the anchored passages of a text's word hashes."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.int64)
    grams = mixed(hashes[: n - 1] * _BASE + hashes[1:])
    reach = min(window, len(grams))
    windows = np.lib.stride_tricks.sliding_window_view(grams, reach)
    starts = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return starts[starts + length <= n]


def passage_keys(hashes: np.ndarray, starts: np.ndarray, length: int = PASSAGE) -> np.ndarray:
    """Keys of the passages that start at the given places of a row of word hashes."""
    key = np.zeros(len(starts), np.uint64)
    for k in range(length):
        key = mixed(key * _BASE + hashes[starts + k])
    return key.view(np.int64)


def anchored(hashes: np.ndarray, window: int = WINDOW, length: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and keys of the anchored passages of a text's word hashes."""
    starts = anchors(hashes, window, length)
    return starts, passage_keys(hashes, starts, length)


def paragraphs(docs: DataFrame, width: int, min_words: int) -> DataFrame:
    """doc_id, kind (line or passage), start, words, node and bands of every paragraph."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in blocks(batches, "text"):
            ids, kinds, starts, sizes, nodes, sets, owners = [], [], [], [], [], [], []
            # the passages of all texts of a block get their keys together
            texts, passages, at_rows, before = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                lines = [word_hashes(line, memo) for line in (text or "").split("\n")]
                at = 0
                for line in lines:
                    if len(line) >= min_words:
                        shingles = shingle_set(line, width)
                        ids.append(doc_id), kinds.append("line"), starts.append(at), sizes.append(len(line))
                        nodes.append(set_key(shingles)), owners.append(len(ids) - 1), sets.append(shingles)
                    at += len(line)
                texts += lines
                places = anchors(np.concatenate([np.empty(0, np.uint64), *lines]))
                m = len(places)
                passages.append(before + places)
                at_rows.append((len(ids), m))
                before += at
                ids += [doc_id] * m
                kinds += ["passage"] * m
                starts += places.tolist()
                sizes += [PASSAGE] * m
                nodes += [0] * m
            keys, taken = passage_keys(np.concatenate(texts), np.concatenate(passages)).tolist(), 0
            for row, m in at_rows:
                nodes[row : row + m] = keys[taken : taken + m]
                taken += m
            bands: list = [None] * len(ids)
            for owner, keys in zip(owners, band_keys(sketches(sets, BANDS * ROWS), BANDS, ROWS) if sets else (), strict=True):
                bands[owner] = keys
            columns = [pa.array(ids, pa.int64()), pa.array(kinds), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32())]
            columns += [pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kind", "start", "words", "node", "bands"])

    rows = docs.select("doc_id", "text").where("doc_id is not null")
    return rows.mapInArrow(cut, "doc_id long, kind string, start int, words int, node long, bands array<long>")


def _line_texts(docs: DataFrame, wanted: DataFrame, width: int, min_words: int) -> DataFrame:
    """node, shingles and bitmap of one place of each wanted line (node, doc_id, start)."""
    texts = docs.select("doc_id", "text").join(wanted.groupBy("doc_id").agg(F.collect_list(F.struct("start", "node")).alias("lines")), "doc_id")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in blocks(batches, "text"):
            nodes, found = [], []
            for text, lines in zip(batch.column("text").to_pylist(), batch.column("lines").to_pylist(), strict=True):
                places, at = {x["start"]: x["node"] for x in lines}, 0
                for line in (text or "").split("\n"):
                    hashes = word_hashes(line, memo)
                    if at in places and len(hashes) >= min_words:
                        shingles = shingle_set(hashes, width)
                        if set_key(shingles) == places[at]:
                            nodes.append(places[at]), found.append(shingles.view(np.int64))
                    at += len(hashes)
            bits = [bitmap(f.view(np.uint64)) for f in found]
            columns = [pa.array(nodes, pa.int64()), *[pa.array(x, pa.list_(pa.int64())) for x in (found, bits)]]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles", "bits"])

    found = texts.select("text", "lines").mapInArrow(sets, "node long, shingles array<long>, bits array<long>")
    return found.dropDuplicates(["node"])


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets have 100 * intersection >= percent * union."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(one, "a").join(two, "b")
    return joined.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def repeats(docs: DataFrame, width: int = 5, percent: int = 80, min_words: int = 30) -> DataFrame:
    """doc_id, kind, start, words, cluster_id, first_doc_id, first_start, documents and removed of every repeated paragraph.

    A row per paragraph of a cluster that two documents or more share; places count words.
    """
    found = stored(paragraphs(docs, width, min_words), "paragraphs")
    lines = found.where("kind = 'line'")
    nodes = lines.groupBy("node").agg(F.min(F.struct("doc_id", "start")).alias("at"), F.first("bands").alias("bands"))
    nodes = stored(nodes.select("node", "at.doc_id", "at.start", "bands"), "lines")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    buckets = stored(buckets.join(shared, "bucket"), "buckets")
    pairs = buckets.where("node <> lo").select(F.col("node").alias("a"), F.col("lo").alias("b"))
    pairs = pairs.union(buckets.where("node <> hi").select("node", "hi")).distinct()
    wanted = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "start")
    sets = stored(_line_texts(docs, wanted, width, min_words), "line_sets")
    links = stored(_alike(pairs, sets, percent), "links")
    known = components(links, "stars")
    # what the two leaders leave apart: by the rarest shingles, exactly
    of_node = buckets.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = of_node.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rest = of_node.join(apart, "bucket", "left_semi").select("node", "component").distinct()
    again = _prefix_pairs(stored(sets.join(rest, "node"), "rest"), percent)
    links = links.union(stored(_alike(again, sets, percent), "links"))
    known = components(links, "components").withColumnRenamed("component", "cluster_id")
    places = lines.select("doc_id", "start", "words", "node").join(known, "node", "left")
    places = places.withColumn("cluster_id", F.coalesce("cluster_id", "node")).drop("node")
    passages = found.where("kind = 'passage'").select("doc_id", "start", "words", F.col("node").alias("cluster_id"))
    return _clustered(places, "line").union(_clustered(passages, "passage"))


def _clustered(places: DataFrame, kind: str) -> DataFrame:
    """The places (doc_id, start, words, cluster_id) of clusters in two documents or more."""
    first = F.min(F.struct("doc_id", "start")).alias("first")
    clusters = places.groupBy("cluster_id").agg(first, F.max("doc_id").alias("last_doc_id"), F.count(F.lit(1)).alias("places"))
    clusters = clusters.where("first.doc_id <> last_doc_id").drop("last_doc_id")
    return places.join(clusters, "cluster_id").select(
        "doc_id",
        F.lit(kind).alias("kind"),
        "start",
        "words",
        "cluster_id",
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.start").alias("first_start"),
        "places",
        (F.struct("doc_id", "start") != F.col("first")).alias("removed"),
    )


def _prefix_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components of ``rest`` (node, shingles, bits, component) that may be alike.

    The bitmaps rule unlike pairs out inside the join, without loss, so few are handed on.
    """
    n = F.size("shingles")
    order = rest.select("node", "component", n.alias("size"), F.explode("shingles").alias("shingle"), (n - F.ceil(n * percent / 100) + 1).alias("need"))
    counts = order.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    ranked = order.join(counts, "shingle").groupBy("node", "component", "size", "need")
    # the rarest shingles of each line; a line is a bounded group
    first = ranked.agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "shingle", "x", "y"))), F.lit(1), F.first("need").cast("int")).alias("p"))
    first = first.select("node", "component", "size", F.explode("p").alias("p")).where("p.x <> p.y")
    first = stored(first.select("node", "component", "size", F.col("p.shingle").alias("shingle")), "prefixes")
    first = first.join(rest.select("node", "bits"), "node")
    one, two = (first.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "component", "size", "bits")]) for x in "ab")
    close = (one["shingle"] == two["shingle"]) & (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
    pairs = one.join(two, close & alike("size_a", "size_b", "bits_a", "bits_b", percent))
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def removed_spans(found: DataFrame) -> DataFrame:
    """doc_id and the merged spans (start, end in words) that go, from the rows of ``repeats``."""
    spans = found.where("removed").groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("words")).alias("end")))).alias("s"))
    merged = F.aggregate(
        "s",
        F.slice("s", 1, 0),
        lambda done, x: F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(F.try_element_at(done, F.lit(-1))["start"].alias("start"), F.greatest(F.try_element_at(done, F.lit(-1))["end"], x["end"]).alias("end"))),
        )).otherwise(F.concat(done, F.array(x))),
    )
    return spans.select("doc_id", merged.alias("spans"))
