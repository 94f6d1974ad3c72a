"""Mixing, sharding, the pipeline and its registration."""

import random
import zlib

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from assetlake.llm import fair_mix, kd_shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(n=400, seed=1):
    rng = random.Random(seed)
    found = []
    for i in range(n):
        text = " ".join("w" * rng.randrange(1, 9) for _ in range(rng.choice([3, 10, 40])))
        source = rng.choice(["a", "a", "a", "b", "c", "Z", "é", None])
        found.append((i, text, rng.choice(["en", "de", None]), source, len(text)))
    return found + [(n, None, "en", "a", 0), (n + 1, "", "en", "empty", 0), (None, "no id here", None, None, None), (5, "again", "en", "b", 5), (5, "again", "en", "b", 5)]


def expected_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        level = left / open_weight if open_weight else 0
        over = {s for s in names if s not in capped and most * sizes[s] <= level * weight[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def test_mix(spark):
    data = rows()
    frame = spark.createDataFrame(data, SCHEMA).withColumn("place", F.lit("clash")).withColumn("size", F.lit(1))
    got = fair_mix.mix(frame).collect()
    sizes = {}
    for _, text, _, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = expected_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
    assert len(got) == len(data)
    assert all(abs(taken[s] - targets[s]) <= 45 for s in sizes), (taken, targets)
    again = fair_mix.mix(frame.repartition(7))
    assert rows_of(again, "doc_id", "source", "size", "taken") == sorted(((r["doc_id"], r["source"], r["size"], r["taken"]) for r in got), key=repr)
    assert fair_mix.mix(frame.limit(0)).count() == 0


def test_shards(spark):
    data = rows(600)
    frame = spark.createDataFrame(data, SCHEMA).withColumn("leaf", F.lit("clash"))
    got = kd_shards.kd_shards(frame, 8).collect()
    assert len(got) == len(data)
    sizes, slots = [0] * 8, [[] for _ in range(8)]
    texts = {d: t for d, t, *_ in data}
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        if r["doc_id"] != 5:
            raw = texts[r["doc_id"]]
            assert r["size"] == len((raw or "").encode()) + 16
            assert r["text_crc32"] == (None if raw is None else zlib.crc32(raw.encode()))
    assert max(sizes) - min(sizes) < 0.15 * max(sizes)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert {r["shard"] for r in kd_shards.kd_shards(frame, target_bytes=10_000).collect()} == set(
        range(-(-sum(sizes) // 10_000))
    )
    assert kd_shards.kd_shards(frame.limit(0), 4).count() == 0


def test_one_value_everywhere_is_cut_all_the_same(spark):
    frame = spark.createDataFrame([(1, "same", "en", "s", 4)] * 200, SCHEMA)
    counts = [r["count"] for r in kd_shards.kd_shards(frame, 4).groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 2


def test_pipeline_and_registration(spark):
    import __spark_entry__
    import corpus_pipeline

    known = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in known) == 1
    assert known["pipeline"] is corpus_pipeline.run
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, seen, sf)
        assert kept.columns == columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        assert kept.select("doc_id").subtract(seen.select("doc_id")).count() == 0
        seen = kept
    placed = corpus_pipeline.shard(spark, seen, sf)
    assert placed.count() == seen.count()
