"""Benchmark decontamination by spaced seeds.

A seed is a hash of some tokens of a window; the mask says which positions count, the others may
differ.  The seeds of all test items and of all training texts are joined; a hit fixes a diagonal
(place in the document minus place in the item), along which the item is laid on the document and
equal tokens are counted.  An overlap stands if the part of the item that lies inside the document
has at least ``min_share`` of the item's tokens equal, substitutions between them allowed.

Tokens are runs of letters and digits, lower-cased.  Everything is built-in expressions: the
windows of a text are zipped slices of its token hashes, so that seeds are hashed in generated
code.  Items shorter than a mask use the mask of their own length; items of fewer than
``min_tokens`` tokens are not searched, as they would be found anywhere.

The items' seeds are broadcast if they number at most BROADCAST_ROWS (checked by a count), else
joined by a shuffle, in which adaptive execution splits frequent seeds.  Only the texts of
documents with hits are fetched again.

Edge cases: null and empty texts have no tokens and no hits; items that are equal are all
reported; rows repeated under one doc_id are reported once per overlap; a null doc_id is carried
along; an empty benchmark or empty documents give an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

MASKS = ("111011001011", "110100111011", "111101010110")  # the positions of a window that count: eight of twelve
BROADCAST_ROWS = 2_000_000


def tokens(text: Column | str) -> Column:
    """Lower-case runs of letters and digits."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", F.lit(" "))), " ")
    return F.filter(words, lambda w: w != "")


def masks_of(length: int) -> list[list[int]]:
    """The counted positions of each mask, cut to windows of ``length`` tokens."""
    cut = [[i for i, c in enumerate(mask[:length]) if c == "1"] for mask in MASKS]
    if length < len(MASKS[0]):
        cut.append(list(range(length)))
    return [list(m) for m in dict.fromkeys(map(tuple, cut))]


def seeds(rows: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """keys, pos and seed of every window of the token hashes in ``hashes``."""
    found = None
    for length in lengths:
        places = F.size("hashes") - (length - 1)
        slices = [F.slice("hashes", F.lit(k + 1), F.greatest(places, F.lit(0))) for k in range(length)]
        windows = F.arrays_zip(F.sequence(F.lit(0), F.greatest(places, F.lit(1)) - 1), *[s.alias(f"t{k}") for k, s in enumerate(slices)])
        one = rows.where(places > 0).select(*keys, F.inline(windows)).toDF(*keys, "pos", *[f"t{k}" for k in range(length)])
        hashed = [F.xxhash64(F.lit(100 * length + i), *[f"t{k}" for k in mask]) for i, mask in enumerate(masks_of(length))]
        one = one.select(*keys, "pos", F.explode(F.array(*hashed)).alias("seed"))
        found = one if found is None else found.union(one)
    return found


def overlaps(docs: DataFrame, items: DataFrame, min_share: float = 0.6, min_tokens: int = 6) -> DataFrame:
    """doc_id, text_key (xxhash64), item_id, start, end (token places in the document), equal and share of every overlap.

    ``docs`` has doc_id and text, ``items`` item_id and text.
    """
    full = len(MASKS[0])
    tests = items.select("item_id", tokens("text").alias("item"))
    tests = stored(tests.where(F.size("item") >= min_tokens).withColumn("hashes", F.transform("item", lambda w: F.xxhash64(w))), "items")
    n = F.size("item")
    lengths = [r[0] for r in tests.select(F.least(n, F.lit(full))).distinct().collect()]  # at most ``full`` numbers
    tested = None
    for length in lengths:
        mine = tests.where(n >= full) if length == full else tests.where(n == length)
        part = seeds(mine, ["item_id"], [length])
        tested = part if tested is None else tested.union(part)
    hit_type = "doc_id bigint, text_key bigint, item_id bigint, start bigint, end bigint, equal int, share double"
    if tested is None:
        return docs.sparkSession.createDataFrame([], hit_type)
    tested = stored(tested.select("item_id", F.col("pos").alias("item_pos"), "seed"), "seeds")
    few = tested.count() <= BROADCAST_ROWS
    texts = docs.select("doc_id", "text").where("text is not null")
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_key"), F.transform(tokens("text"), lambda w: F.xxhash64(w)).alias("hashes"))
    trained = seeds(texts, ["doc_id", "text_key"], sorted(lengths))
    hits = trained.join(F.broadcast(tested) if few else tested, "seed")
    diagonals = hits.select("doc_id", "text_key", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    diagonals = stored(diagonals, "diagonals")
    # verify: lay the item's tokens on the document's
    suspects = stored(diagonals.select("text_key").distinct(), "suspects")
    if suspects.count() <= BROADCAST_ROWS:
        suspects = F.broadcast(suspects)
    words = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).where("text is not null")
    words = words.join(suspects, "text_key", "left_semi").dropDuplicates(["doc_id", "text_key"])
    words = words.select(F.col("doc_id").alias("of"), F.col("text_key").alias("key"), tokens("text").alias("words"))
    same = diagonals["doc_id"].eqNullSafe(words["of"]) & (diagonals["text_key"] == words["key"])
    laid = diagonals.join(words, same)
    laid = laid.join(F.broadcast(tests) if few else tests, "item_id")
    start, end = F.greatest("shift", F.lit(0)), F.least(F.col("shift") + F.size("item"), F.size("words"))
    here = F.slice("words", start + 1, F.greatest(end - start, F.lit(0)))
    there = F.slice("item", start - F.col("shift") + 1, F.greatest(end - start, F.lit(0)))
    equal = F.size(F.filter(F.zip_with(here, there, lambda a, b: a == b), lambda e: e))
    laid = laid.select(
        "doc_id",
        "text_key",
        "item_id",
        start.cast("long").alias("start"),
        end.cast("long").alias("end"),
        equal.alias("equal"),
        (equal / F.size("item")).alias("share"),
    )
    return laid.where(F.col("share") >= min_share).distinct()


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without an overlap, with all their columns."""
    found = stored(overlaps(docs, items, **options).select("doc_id", "text_key").distinct(), "contaminated")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    found = found.toDF("_found_id", "_found_key")
    same = docs["doc_id"].eqNullSafe(F.col("_found_id")) & (F.xxhash64(docs["text"]) == F.col("_found_key"))
    return docs.join(found, same, "left_anti")
