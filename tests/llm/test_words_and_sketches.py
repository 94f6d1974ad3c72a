"""Near duplicates, repeated passages and their helpers against brute force."""

import random

import numpy as np
import pytest
from conftest import rows_of

from assetlake.llm import fast_sketch, passages
from assetlake.llm.components import components
from assetlake.llm.ordering import ranked
from assetlake.llm.words import split_words

VOCABULARY = [a + b for a in ("ba", "ko", "mi", "tu", "re", "so") for b in ("la", "ne", "pi", "do", "ru")]


def words_of(rng, n):
    return [rng.choice(VOCABULARY) + str(rng.randrange(40)) for _ in range(n)]


def brute(rows, width, percent):
    """Component of each row by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = [w.decode() for w in split_words(text)]
        n = min(width, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))]


def near_copies(seed=3):
    rng = random.Random(seed)
    rows = []
    for base in range(12):
        words = words_of(rng, rng.choice([30, 60, 120]))
        for _ in range(rng.choice([1, 3, 12])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = "x%d" % rng.randrange(1000)
            rows.append(" ".join(copy))
    rows += ["", None, " \t\n", "one", "ONE", "one two", "a b c", "A  b\nc", "a b c d"]
    return [(100 + i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_as_brute_force(spark, width, percent):
    rows = near_copies()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, bits int")
    got = fast_sketch.near_duplicates(docs, width, percent)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(brute(rows, width, percent), key=repr)
    assert got.where("stays").count() == len({c for _, n, c in brute(rows, width, percent)})


def test_what_leaders_miss_is_found_by_prefixes(spark):
    """A chain: each text is near the next one, but not the leader."""
    rng = random.Random(5)
    words, rows = words_of(rng, 80), []
    for i in range(12):
        rows.append((i, " ".join(words)))
        words = list(words)
        words[5 * i : 5 * i + 2] = ["n%d" % i, "m%d" % i]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fast_sketch.near_duplicates(docs, 3, 85)
    assert {r["component_id"] for r in got.collect()} == {0}


def test_candidates_of_a_large_group_grow_with_its_size(spark, monkeypatch):
    """Near copies of one text, about half of whose pairs are near enough: rounds, not all pairs."""
    made = {}
    real = fast_sketch.stored
    monkeypatch.setattr(fast_sketch, "stored", lambda frame, name: made.setdefault(name, []).append(real(frame, name)) or made[name][-1])
    counts = {}
    for n in (300, 1200):
        made.clear()
        rng = random.Random(9)
        words = words_of(rng, 200)
        rows = []
        for i in range(n):
            copy = list(words)
            for _ in range(rng.randrange(3, 9)):
                copy[rng.randrange(len(copy))] = "y%d" % rng.randrange(40)
            rows.append((i, " ".join(copy)))
        got = fast_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
        if n == 300:
            assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(brute(rows, 3, 85), key=repr)
        counts[n] = sum(frame.count() for frame in made["pairs"])
    assert counts[1200] < 10 * max(counts[300], 300) and counts[1200] < 1200 * 1199 / 20


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "else where now"), (8, None)]
    got = fast_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert rows_of(got, "doc_id", "component_id", "stays") == [
        (7, 7, True), (7, 7, True), (8, 8, True), (None, 7, False), (None, 7, False), (None, None, True),
    ]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fast_sketch.near_duplicates(empty, 3, 85).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 600, dtype=np.uint64)
    a, b, one = np.unique(pool[:400]), np.unique(pool[100:500]), pool[:1]
    table = fast_sketch.sketches([a, b, one, pool[:0]], 256)
    assert (table[:3] != fast_sketch._EMPTY).all() and (table[3] == fast_sketch._EMPTY).all()
    assert abs((table[0] == table[1]).mean() - 0.6) < 0.12


def test_bitmaps_never_rule_out_an_alike_pair():
    rng = np.random.default_rng(2)
    for n in (10, 500, 3000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.union1d(a[n // 20 :], rng.integers(0, 2**63, n // 25, dtype=np.uint64))
        bits = [np.unpackbits(fast_sketch.bitmap(x).view(np.uint8)) for x in (a, b)]
        if len(bits[0]) == len(bits[1]):
            assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)] + [(200, x) for x in range(201, 230)]
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == (
        dict.fromkeys(range(41), 0) | {100: 100, 101: 100} | dict.fromkeys(range(200, 230), 200)
    )


def test_ranks_and_running_sums(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), rng.randrange(50)) for _ in range(500)]
    got = ranked(spark.createDataFrame(rows, "k int, v long").repartition(5), ["k", "v"], ["v"]).orderBy("_rank").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r["k"], r["v"]) for r in got] == order
    assert [r["_run_v"] for r in got] == np.cumsum([v for _, v in order]).tolist()
    assert [r["_rank"] for r in got] == list(range(500))


def test_planted_passages_are_found(spark):
    rng = random.Random(6)
    passage, line = words_of(rng, 55), words_of(rng, 90)
    near = list(line)
    near[20] = "other"
    rows = [(i, " ".join(words_of(rng, 150))) for i in range(6)]
    rows += [(20 + i, " ".join([*words_of(rng, 40 + i), *passage, *words_of(rng, 30)])) for i in range(4)]
    rows += [(30, " ".join(words_of(rng, 40)) + "\n" + " ".join(line)), (31, " ".join(near) + "\n" + " ".join(words_of(rng, 40)))]
    rows += [(40, None), (41, ""), (None, " ".join(passage)), (42, " ".join([*passage[:20]] * 3))]
    got = passages.repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    found = got.collect()
    assert {r["doc_id"] for r in found} == {20, 21, 22, 23, 30, 31}
    assert {r["doc_id"] for r in found if not r["removed"]} == {20, 30}
    spans = {r["doc_id"]: r["spans"] for r in passages.removed_spans(got).collect()}
    assert set(spans) == {21, 22, 23, 31}
    start, end = spans[22][0]
    assert 42 <= start and end <= 42 + 55 and end - start >= passages.PASSAGE
    assert passages.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keys_of_joined_texts_are_those_of_each():
    rng = np.random.default_rng(5)
    texts = [rng.integers(1, 2**63, n).astype(np.uint64) for n in (40, 0, 36, 300)]
    apart = [passages.anchored(text) for text in texts]
    ends = np.cumsum([0, *map(len, texts)])
    starts = np.concatenate([end + passages.anchors(text) for end, text in zip(ends, texts)])
    keys = passages.passage_keys(np.concatenate(texts), starts)
    assert keys.tolist() == [k for _, found in apart for k in found.tolist()]
