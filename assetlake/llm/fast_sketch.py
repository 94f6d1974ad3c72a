"""Near-duplicate documents by fast similarity sketching.

A document is the set of its distinct word shingles.  Its sketch has BANDS * ROWS coordinates,
filled in rounds: in each of the first rounds every element is hashed to one bin with a value
that rises with the round, in the later ones bin after bin takes all elements, and the document
is done as soon as every bin is filled.  So each coordinate fills, after about
n + t log t steps, and the share of equal coordinates is concentrated about the Jaccard
similarity like that of as many independent minima.

Documents whose bands agree are candidates.  Each is compared with one leader of its bucket, on
full sets.  What is then apart is searched through the rarest shingles of each set, as many as an
exact join needs.  Joining all pairs that share one would take the square of a large group of near
copies, so it goes in rounds: in each, every set is compared with one leader of each of its shingles
(another one in each round) that is in another component, the confirmed links contract the components, and shingles held by one
component only fall away.  Rounds end when the pairs still apart are no more than PAIRS_A_ROW for each
row of the index, or when a round leaves most of them; only then are the pairs left joined, without
those refuted before.  Links are kept between components, one for each pair of them.
So no bucket is multiplied out, no partner is capped, and the result is that of comparing all pairs.

Edge cases: a text with fewer words than a shingle is one shingle; a null or blank text has an
empty set, is linked with nothing and is its own component; rows with equal sets are linked
without comparison, rows repeated under one doc_id too; rows with a null doc_id take part, and
their component is the least doc_id in it (null if there is none).  Other columns are ignored.
Sets are kept as 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

from .components import components
from .words import WordHashes, blocks, mixed, set_key, shingle_set, word_hashes

BANDS, ROWS = 16, 4  # at a similarity of 0.85 a pair is missed with 8 in a million, at 0.8 with 2 in 10,000
SLOW = 0.7  # a round that leaves a larger share of the pairs apart is the last but one
PAIRS_A_ROW = 2  # so many pairs for each row of the index of rare shingles are joined at once
WEIGHT_BUCKETS = 1 << 18
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` coordinates for each set; the rows of empty sets stay unfilled."""
    table = np.full(len(sets) * size, _EMPTY, dtype=np.uint64)
    elements = np.concatenate([np.empty(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for turn in range(2 * size):
        if not len(elements):
            break
        hashed = mixed(elements + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        bins = (hashed % np.uint64(size)).astype(np.int64) if turn < size else turn - size
        np.minimum.at(table, owner * size + bins, np.uint64(turn << 54) | (hashed >> np.uint64(10)))
        open_sets = (table.reshape(-1, size) == _EMPTY).any(axis=1)
        going = open_sets[owner]
        elements, owner = elements[going], owner[going]
    return table.reshape(-1, size)


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key per row and band."""
    keys = np.empty((len(table), bands), dtype=np.uint64)
    for band in range(bands):
        value = np.full(len(table), band + 1, dtype=np.uint64)
        for k in range(rows):
            value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + table[:, band * rows + k])
        keys[:, band] = value
    return keys.view(np.int64)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set: 1024 bits for up to 512 elements, then four times as many each time."""
    bits = 1024
    while len(shingles) > bits // 2:
        bits *= 4
    at = (shingles >> np.uint64(7)) & np.uint64(bits - 1)
    odd = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def alike(size_a: str, size_b: str, bits_a: str, bits_b: str, percent: int) -> Column:
    """False only for sets that can't have the similarity, by their sizes and bitmaps."""
    differing = F.aggregate(
        F.zip_with(bits_a, bits_b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )  # null for bitmaps of two lengths
    a, b = F.col(size_a), F.col(size_b)
    return (
        (100 * a >= percent * b)
        & (100 * b >= percent * a)
        & ((100 + percent) * F.coalesce(differing, F.lit(0)) <= (100 - percent) * (a + b))
    )


def signatures(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_key, n_shingles, node (hash of the whole set; null if empty), band keys and bitmap of every row."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in blocks(batches, "text"):
            sets = [shingle_set(word_hashes(t, memo), width) for t in batch.column("text").to_pylist()]
            keys = band_keys(sketches(sets, bands * rows), bands, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([k if len(s) else [] for k, s in zip(keys, sets, strict=True)], pa.list_(pa.int64())),
                    pa.array([bitmap(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "bands", "bits"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        sign, "doc_id long, text_key long, n_shingles long, node long, bands array<long>, bits array<long>"
    )


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    ``texts`` has one text per node.  The texts are joined to the pairs; where many pairs share
    a node, adaptive execution splits its partition.
    """
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, last = WordHashes(), (None, None)
        for batch in blocks(batches, "text_a"):
            kept = []
            rows = zip(batch.column("b").to_pylist(), batch.column("text_a"), batch.column("text_b"), strict=True)
            for i, (b, text_a, text_b) in enumerate(rows):
                if last[0] != b:
                    last = b, shingle_set(word_hashes(text_b.as_py(), memo), width)
                mine = shingle_set(word_hashes(text_a.as_py(), memo), width)
                common = len(np.intersect1d(mine, last[1], assume_unique=True))
                if 100 * common >= percent * (len(mine) + len(last[1]) - common):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def prefixes(nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component, shingle) of the rarest shingles of each set, as many as an exact join needs.

    Two sets as alike as asked share one of these.  How rare a shingle is comes from counts in
    WEIGHT_BUCKETS hashed buckets: any fixed order gives the same pairs, a good one few candidates.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, counts = WordHashes(), np.zeros(WEIGHT_BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                counts[(shingle_set(word_hashes(text.as_py(), memo), width) % np.uint64(WEIGHT_BUCKETS)).astype(np.int64)] += 1
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    counted = nodes.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    weights = np.zeros(WEIGHT_BUCKETS, dtype=np.int64)
    found = counted.toArrow()  # at most WEIGHT_BUCKETS rows
    weights[found["bucket"].to_numpy()] = found["n"].to_numpy()
    shared = nodes.sparkSession.sparkContext.broadcast(weights)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, rank = WordHashes(), shared.value
        for batch in blocks(batches, "text"):
            at, chosen = [], []
            for i, text in enumerate(batch.column("text")):
                whole = shingle_set(word_hashes(text.as_py(), memo), width)
                order = np.lexsort((whole, rank[(whole % np.uint64(WEIGHT_BUCKETS)).astype(np.int64)]))
                need = len(whole) - -(-percent * len(whole) // 100) + 1
                chosen.append(whole[order[:need]])
                at.append(np.full(len(chosen[-1]), i))
            rows = batch.select(["node", "component"]).take(pa.array(np.concatenate(at)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(np.concatenate(chosen).view(np.int64))], ["node", "component", "shingle"]
            )

    return nodes.select("node", "component", "text").mapInArrow(
        cut, "node long, component long, shingle long"
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key (xxhash64), n_shingles, component_id and stays of every row of ``docs`` (doc_id, text).

    One document of each component stays: the one with the least doc_id.
    """
    signed = stored(signatures(docs, width), "signatures")
    nodes = signed.where("node is not null").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n_shingles", "bands", "bits")])
    nodes = stored(nodes, "nodes")
    sizes = nodes.select("node", F.col("n_shingles").alias("size"), "bits")
    buckets = stored(nodes.select("node", F.explode("bands").alias("bucket")), "buckets")
    pairs = _star(buckets.withColumn("component", F.col("node")), "bucket", 0)
    pairs = stored(_close(pairs, sizes, percent), "pairs")
    links = stored(confirmed(pairs, _texts(docs, signed, pairs), width, percent), "links")
    known = stored(components(links, "stars"), "known")
    # the nodes of buckets in several components are searched through their rarest shingles
    of_node = buckets.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rest = of_node.join(_open(of_node, "bucket"), "bucket", "left_semi").select("node", "component").distinct()
    rest = stored(rest, "rest")
    texts = _texts(docs, signed, rest.select(F.col("node").alias("a"), F.col("node").alias("b"))).join(rest, "node")
    texts = stored(texts, "rest_texts")
    index = stored(prefixes(texts, width, percent), "prefixes")
    texts, tried, turn, before = texts.select("node", "text"), pairs, 0, None
    while True:
        # the shingles are stored before, so that the join deals the rows anew and a hot one can be split
        index = stored(index.join(stored(_open(index, "shingle"), "shingles"), "shingle", "left_semi"), "open")
        rows, apart = _apart(index)
        last_turn = apart <= PAIRS_A_ROW * rows or before is not None and apart > SLOW * before
        pairs = _pairs(index, sizes, percent) if last_turn else _close(_star(index, "shingle", turn := turn + 1), sizes, percent)
        # a refuted pair is not compared again
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = stored(confirmed(pairs, texts, width, percent), "links")
        # one link for each pair of components, and the components joined by these
        places = index.select("node", "component").distinct()
        a, b = (places.toDF(f"node_{x}", x) for x in ("u", "v"))
        between = found.join(a, found["a"] == a["node_u"]).join(b, found["b"] == b["node_v"])
        between = between.select(F.col("u").alias("a"), F.col("v").alias("b")).distinct()
        joined = stored(components(between, "contracted").toDF("_of", "_to"), "joined")
        # a node alone so far is a component of its own name
        known = _moved(known, joined, "component").union(joined).distinct()
        known = stored(known.toDF("node", "component"), "known")
        if last_turn:
            break
        index, tried, before = _moved(index, joined, "component"), tried.union(pairs), apart
    rows = signed.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("bands", "bits")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")  # rows without an id come last
    least = stored(rows.where("component is not null").groupBy("component").agg(F.min(place).alias("least")), "least")
    alone = F.col("component").isNull()
    is_least = place.eqNullSafe(F.col("least"))
    return rows.join(least, "component", "left").select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        (alone | is_least).alias("stays"),
    )


def _side(sizes: DataFrame, name: str) -> DataFrame:
    return sizes.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("bits").alias(f"bits_{name}"))


def _star(rows: DataFrame, group: str, turn: int) -> DataFrame:
    """(a, b), a < b: each node with one node of its group, another in each turn, if their components differ."""
    leader = F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "component")).alias("leader")
    # stored, so that the join deals the rows anew and a hot group can be split
    leaders = stored(rows.groupBy(group).agg(leader), "leaders")
    pairs = rows.join(leaders, group).where("component <> leader.component")
    return _ordered(pairs.select("node", F.col("leader.node").alias("other")))


def _pairs(index: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: the nodes of two components that share a shingle and that sizes and bitmaps don't rule out.

    The bitmaps are compared inside the join, so it gives few rows also for large groups of unlike sets.
    """
    held = index.join(sizes, "node")
    one, two = (held.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "component", "size", "bits")]) for x in "ab")
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
    close = (one["shingle"] == two["shingle"]) & apart & alike("size_a", "size_b", "bits_a", "bits_b", percent)
    return one.join(two, close).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _close(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sizes and bitmaps don't rule out."""
    both = pairs.join(_side(sizes, "a"), "a").join(_side(sizes, "b"), "b")
    return both.where(alike("size_a", "size_b", "bits_a", "bits_b", percent)).select("a", "b")


def _open(rows: DataFrame, group: str) -> DataFrame:
    """The groups that are held by several components."""
    held = rows.groupBy(group).agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return held.where("lo <> hi").select(group)


def _apart(index: DataFrame) -> tuple[int, float]:
    """The rows of the index, and how many pairs of two components its shingles hold, counted at each shingle."""
    held = index.groupBy("shingle", "component").agg(F.count("node").cast("double").alias("n"))
    held = held.groupBy("shingle").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    rows, pairs = held.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("own")) / 2)).first()
    return int(rows or 0), pairs or 0.0


def _moved(rows: DataFrame, joined: DataFrame, column: str) -> DataFrame:
    """The rows with the components that theirs have become part of."""
    moved = rows.join(joined, rows[column] == joined["_of"], "left")
    return moved.withColumn(column, F.coalesce("_to", column)).drop("_of", "_to")


def _texts(docs: DataFrame, signed: DataFrame, pairs: DataFrame) -> DataFrame:
    """One text for each node in ``pairs``: that of the node's least row."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = signed.where("node is not null").join(nodes, "node", "left_semi")
    owner = wanted.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("o"))
    owner = owner.select("node", F.col("o.doc_id").alias("owner_id"), F.col("o.text_key").alias("text_key"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).join(owner, "text_key")
    return rows.where(F.col("doc_id").eqNullSafe(F.col("owner_id"))).select("node", "text").dropDuplicates(["node"])
