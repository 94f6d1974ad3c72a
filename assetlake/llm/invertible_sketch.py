"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A text is cut into short paragraphs (lines, cut further after sentence ends and every
PIECE_WORDS words), each with a 64-bit digest; the k-th equal paragraph of a text counts as
another one.  A table has cells of a count, the XOR of the digests and the XOR of their checks;
each digest is in three cells.  The difference of two tables holds the digests that only one of
the texts has: peeling takes out what stands alone in a cell until the table is empty.  If that
fails, both texts are put into tables of LARGER times the cells and peeled again.

The fingerprint is the smallest table, BASE_CELLS cells, in hexadecimal digits.  The likeness of two texts is
the share of their paragraphs that did not come out of the difference.

Edge cases: null and empty texts have no paragraphs and the all-zero fingerprint; two of them are
alike (1.0), one of them and another text are not (0.0); equal texts have likeness 1.0 without
peeling; the last document is followed by the first, a single document by itself; documents with
a null doc_id come first; equal ids are in the order of their rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

from .words import mixed

BASE_CELLS, HASHES, PIECE_WORDS, LARGER = 16, 3, 5, 8
PIECES = regex.compile(rf"(?:\S++(?<![.!?])[^\S\n]++){{0,{PIECE_WORDS - 1}}}+\S++")
_ODD = np.uint64(0x5851F42D4C957F2D)
COLUMNS = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def paragraphs(text: str | None) -> np.ndarray:
    """The distinct digests of a text's paragraphs, repeats numbered."""
    if not text:
        return np.empty(0, np.uint64)
    found = [xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) for p in PIECES.findall(text)]
    digests, counts = np.unique(np.array(found, dtype=np.uint64), return_counts=True)
    if len(digests) == len(found):
        return digests
    digests = np.repeat(digests, counts)
    nth = (np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    return np.where(nth == 0, digests, mixed(digests + nth))


def spots(digests: np.ndarray) -> np.ndarray:
    """HASHES numbers for each digest; taken modulo the cells they are its places."""
    return np.concatenate([digests, digests >> np.uint64(21), (digests * _ODD) >> np.uint64(20)])


def checks(digests: np.ndarray) -> np.ndarray:
    return (digests ^ (digests >> np.uint64(31))) * _ODD  # not linear under XOR


class Digests:
    """A set of digests with what every table of them needs."""

    def __init__(self, digests: np.ndarray):
        self.digests = digests
        self.spots = spots(digests)
        self.keys = np.concatenate([digests] * HASHES)
        self.checks = np.concatenate([checks(digests)] * HASHES)

    def __len__(self) -> int:
        return len(self.digests)


class Table:
    """Counts, XOR of digests and XOR of checks of each cell."""

    def __init__(self, found: Digests | None, cells: int):
        self.cells = cells
        self.counts = np.zeros(cells, np.int64)
        self.keys, self.checks = np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)
        if found is not None:
            at = (found.spots & np.uint64(cells - 1)).astype(np.int64)
            self.counts = np.bincount(at, minlength=cells).astype(np.int64)
            np.bitwise_xor.at(self.keys, at, found.keys)
            np.bitwise_xor.at(self.checks, at, found.checks)

    def raw(self) -> bytes:
        """The table as bytes: counts, digests, checks."""
        return self.counts.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes() + self.checks.astype("<u8").tobytes()

    @classmethod
    def of_raw(cls, raw: bytes) -> Table:
        table, n = cls(None, len(raw) // 20), len(raw) // 20
        table.counts = np.frombuffer(raw, "<i4", n).astype(np.int64)
        table.keys = np.frombuffer(raw, "<u8", n, 4 * n).copy()
        table.checks = np.frombuffer(raw, "<u8", n, 12 * n).copy()
        return table

    def minus(self, other: Table) -> Table:
        result = Table(None, self.cells)
        result.counts = self.counts - other.counts
        result.keys, result.checks = self.keys ^ other.keys, self.checks ^ other.checks
        return result

    def peel(self) -> tuple[np.ndarray, np.ndarray] | None:
        """The digests only the first and only the second table has; None if some can't be told."""
        mine: list[np.ndarray] = []
        other: list[np.ndarray] = []
        while True:
            alone = np.nonzero(np.abs(self.counts) == 1)[0]
            alone = alone[checks(self.keys[alone]) == self.checks[alone]]
            if not len(alone):
                break
            keys, first = np.unique(self.keys[alone], return_index=True)
            signs = self.counts[alone][first]
            (mine.append(keys[signs > 0]), other.append(keys[signs < 0]))
            at, all_keys = (spots(keys) & np.uint64(self.cells - 1)).astype(np.int64), np.concatenate([keys] * HASHES)
            np.subtract.at(self.counts, at, np.concatenate([signs] * HASHES))
            np.bitwise_xor.at(self.keys, at, all_keys)
            np.bitwise_xor.at(self.checks, at, np.concatenate([checks(keys)] * HASHES))
        if self.counts.any() or self.keys.any() or self.checks.any():
            return None
        none = [np.empty(0, np.uint64)]
        return np.concatenate(none + mine), np.concatenate(none + other)


def difference(first: Digests, second: Digests, cells: int = BASE_CELLS) -> tuple[np.ndarray, np.ndarray]:
    """What only the first and only the second set of digests has, by peeling ever larger tables.

    A table with fewer cells than the sets differ in number can't be peeled and is passed over; so is
    one whose counts tell that about as many digests differ, since a larger one gives the same.
    """
    while True:
        if abs(len(first) - len(second)) < cells:
            table = Table(first, cells).minus(Table(second, cells))
            # each digest that differs adds one to the expected square of HASHES counts
            found = table.peel() if int(table.counts @ table.counts) <= HASHES * cells else None
            if found is not None:
                return found
        cells *= LARGER


def likeness(first: Digests, second: Digests) -> float:
    """Share of the paragraphs of both that are common; 1 for equal ones."""
    total = len(first) + len(second)
    if not total or np.array_equal(first.digests, second.digests):
        return 1.0
    if not len(first) or not len(second):
        return 0.0
    mine, other = difference(first, second)
    return (total - len(mine) - len(other)) / total


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by the start of the following one."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


class _Version:
    """A text with its digests."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.digests = Digests(paragraphs(self.text))
        self.fingerprint = Table(self.digests, BASE_CELLS).raw()


def compared(one: _Version, following: _Version) -> tuple:
    """The values of COLUMNS (as bytes) for a text and the next one."""
    change = _Version(edited(one.text, following.text))
    return (
        len(one.text),
        hashlib.sha256(change.text.encode("utf-8", "surrogatepass")).digest(),
        one.fingerprint,
        change.fingerprint,
        likeness(one.digests, change.digests),
        likeness(one.digests, following.digests),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and COLUMNS of every row of ``docs``, each compared with the next by doc_id.

    The texts are dealt once by ranges of doc_id and walked in order; a task holds two texts.
    Where a range ends, its last text and the first of the next range are compared afterwards.
    """

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            rows, edges = [], []
            for i in range(batch.num_rows):
                doc_id, part, text = (batch.column(c)[i].as_py() for c in range(3))
                version = _Version(text)
                if before is None:
                    edges.append((doc_id, part, "first", text))
                else:
                    rows.append((before[0], part, *compared(before[1], version)))
                before = (doc_id, version, part)
            yield _batch(rows, edges)
        if before is not None:
            yield _batch([], [(before[0], before[2], "last", before[1].text)])

    def _batch(rows: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
        whole = [(r[0], r[1], None, None, *r[2:]) for r in rows] + [(*e, *[None] * 6) for e in edges]
        columns = list(zip(*whole, strict=True)) or [()] * 10
        kinds = [pa.int64(), pa.int32(), *[pa.string()] * 2, pa.int64(), *[pa.binary()] * 3, *[pa.float64()] * 2]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def join_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["doc_id"], r["part"], *compared(_Version(r["text"]), _Version(r["following"]))) for r in batch.to_pylist()]
            yield _batch(rows, [])

    schema = f"doc_id long, part int, edge string, text string, {COLUMNS}"
    names = [c.split()[0] for c in schema.split(", ")]
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    rows = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    rows = rows.select("doc_id", F.spark_partition_id().alias("part"), "text")
    found = stored(rows.mapInArrow(walk, schema), "fingerprints")
    # two rows per range: the last text of each with the first of the next one
    starts = found.where("edge = 'first'").select("part", F.col("text").alias("following"))
    order = starts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy(F.lit(1)))).alias("next"))
    ends = found.where("edge = 'last'").select("doc_id", "part", "text").join(order, "part")
    ends = ends.join(starts.withColumnRenamed("part", "next"), "next").select("doc_id", "part", "text", "following")
    whole = found.where("edge is null").unionByName(ends.mapInArrow(join_ends, schema))
    whole = whole.drop("part", "edge", "text")
    return whole.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})
