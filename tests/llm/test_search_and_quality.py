"""Ranked search against scoring every document; the quadratic discriminant against numpy and held-out rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlake.llm import impact_search, quality

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k):
    """(item_id, text, rank, doc_id, score) by the score of every document."""
    held, sizes, n_terms = Counter(), [], 0
    bags = [Counter(found(text)) for _, text in docs]
    for bag in bags:
        held.update(bag.keys())
        sizes.append(bag.total())
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    rows = set()
    for item_id, text in set(items):
        scored = []
        for (doc_id, _), bag, size in zip(docs, bags, sizes, strict=True):
            score = 0
            for term, times in Counter(found(text)).items():
                if bag[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[term] + 1)))
                    m = 75 + 25 * size * n_docs // n_terms
                    score += times * weight * (10**9 * bag[term] // (1000 * bag[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            rows.add((item_id, text, rank, doc_id, -score))
    return rows


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "naïve", "x2", "The", "the"]
    chances = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, chances, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " .,; "), (None, docs[3][1]), (None, docs[3][1]), (5, docs[7][1]), (n + 3, "w1 " * 5000)]
    return docs + [(n + 10 + i, docs[4][1]) for i in range(9)], [
        (i, " ".join(rng.choices(words, k=rng.choice([1, 3, 12])))) for i in range(12)
    ] + [(100, None), (101, "?!"), (102, "unknown words"), (1, "w1 w1 w2"), (103, "THE-the w3"), (103, "THE-the w3"), (None, "w59, naïve")]


@pytest.mark.parametrize("postings", [1 << 20, 40])
def test_search_equals_brute_force(spark, monkeypatch, postings):
    monkeypatch.setattr(impact_search, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(impact_search, "FIRST_STEP", 2)
    docs, items = corpus(300, 1)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("rank", F.lit("clash"))
    wanted = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1))
    got = [tuple(r) for r in impact_search.search(frame, wanted, 20).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_force(docs, items, 20)


def test_search_in_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(impact_search, "ITEM_BYTES", 60)
    docs, items = corpus(40, 2)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {tuple(r) for r in impact_search.search(frame, spark.createDataFrame(items, "item_id long, text string"), 3).collect()}
    assert got == brute_force(docs, items, 3)
    assert impact_search.search(frame.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert impact_search.search(frame, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_search_stops_before_the_ends_of_the_lists():
    """A document that leads the rare term's list ends the search with most of the common list unread."""
    rng = np.random.default_rng(0)
    n = 5000
    common = np.stack([np.arange(n), np.zeros(n, np.int64), rng.integers(1, 100, n)])
    rare = np.stack([np.arange(30), np.ones(30, np.int64), np.full(30, 10_000)])
    lists = impact_search.ImpactLists(np.concatenate([common, rare], axis=1), 2, np.arange(n))
    looked = []
    direct = lists.direct
    lists.direct = lambda term, docs: looked.append(len(docs)) or direct(term, docs)
    docs, scores = lists.best(np.array([0, 1]), np.array([1, 1]), 20, 0)
    assert sum(looked) < n / 2
    best = sorted(zip(-scores, docs, strict=True))[:20]
    whole = sorted((-(10_000 + common[2][d]), d) for d in range(30))[:20]
    assert [(int(s), int(d)) for s, d in best] == [(int(s), int(d)) for s, d in whole]


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("_quality", F.lit("clash")).withColumn("label", F.lit(3))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = quality.quality(docs, labels)
    assert scores.count() == docs.count()
    rows = scores.join(labels, "doc_id").where(quality.held_out()).select("_quality", "quality").collect()
    right = [(r["_quality"] >= 0.7) == (r["quality"] == 1) for r in rows]
    assert len(rows) > 50 and sum(right) / len(rows) >= 0.97
    clean = [r["_quality"] >= 0.7 for r in rows if r["quality"] == 1]
    assert sum(clean) / len(clean) >= 0.97


def test_quality_does_not_see_held_out_labels(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = ({r["doc_id"]: r["_quality"] for r in quality.quality(docs, x).collect()} for x in (labels, turned))
    assert one == pytest.approx(two)


def test_discriminant_is_the_gaussian_log_density():
    rng = np.random.default_rng(1)
    classes = [rng.normal(0, 1, (400, 3)) @ rng.normal(0, 1, (3, 3)) + rng.normal(0, 1, 3) for _ in range(2)]
    sums = [np.array([len(c) for c in classes], float), np.array([c.sum(0) for c in classes]), np.array([c.T @ c for c in classes])]
    model = quality.discriminant(*sums, ridge=0.1)
    x = rng.normal(0, 1, (5, 3))
    pooled = sum(np.cov(c.T, bias=True) * len(c) for c in classes) / 800
    logs = []
    for c in classes:
        drawn = 3 / 403
        s = (1 - drawn) * np.cov(c.T, bias=True) + drawn * pooled
        s = 0.9 * s + 0.1 * np.diag(np.diag(s)) + 1e-6 * np.eye(3)
        off = x - c.mean(0)
        logs.append(math.log(0.5) - 0.5 * np.log(np.linalg.det(s)) - 0.5 * (off @ np.linalg.inv(s) * off).sum(1))
    assert model.margin(x) == pytest.approx(logs[1] - logs[0])


def test_quality_edge_cases(spark):
    rng = random.Random(4)
    good = ["The " + " ".join(rng.choices(["river", "stone", "walked", "slowly", "home"], k=30)) + "." for _ in range(40)]
    bad = [" ".join(rng.choices(["BUY!!!", "$$$", "###"], k=30)) for _ in range(40)]
    texts = good + bad + [None, "", " \n ", "x" * 1_000_000, "é" * 9, good[0], "Buy."]
    docs = spark.createDataFrame([*enumerate(texts), (0, good[0]), (None, good[1])], "doc_id long, text string")
    labels = [(i, int(i < 40)) for i in range(80)] + [(0, None), (None, 1), (9999, 1), (3, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.quality(docs, frame).collect()
    assert len(got) == len(texts) + 2 and all(0 <= r["_quality"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["_quality"] for r in got}
    assert by_id[0] == by_id[85]  # equal texts
    assert min(by_id[i] for i in range(40)) >= 0.7 > max(by_id[i] for i in range(40, 80))
    one_kind = quality.quality(docs, frame.where("quality = 1"))
    assert {r["_quality"] for r in one_kind.collect()} == {1.0}
    assert {r["_quality"] for r in quality.quality(docs, frame.limit(0)).collect()} == {0.5}
    assert quality.quality(docs.limit(0), frame).count() == 0
