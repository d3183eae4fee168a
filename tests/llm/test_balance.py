"""Mixing, sharding, the classifier and nearest neighbours."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from serieslake.llm import mixing, neighbours, quality, sharding
from serieslake.llm.common import running_totals, select_rows
from serieslake.llm.textvec import hashed_words, shingle_sets


def water_fill(sizes):
    """Targets by handing the excess round until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}
    budget, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = budget / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        open_ -= full
    return target


def mixed_docs(spark):
    rng = random.Random(5)
    rows = []
    for k in range(400):
        source = rng.choice(["a", "a", "a", "a", "b", "c", "Z", "é", None])
        rows.append((k, "w " * rng.randint(0, 60), source))
    rows += [(7, None, "a"), (None, "x y z", "b"), (8, rows[8][1], rows[8][2]), (401, " \n ", "empty")]
    return rows, spark.createDataFrame(
        [(*r, 1, "k") for r in rows], "doc_id long, text string, source string, size int, key string"
    )


def test_mixing(spark):
    rows, docs = mixed_docs(spark)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 2 and (r.size > 0 or r.copies == 0)
    want = water_fill(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-9
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixing_prefers_quality(spark):
    docs = spark.createDataFrame([(k, "w w w", s) for k in range(600) for s in ["z"]] + [(1000, "w " * 9000, "a")], "doc_id long, text string, source string")
    weights = spark.createDataFrame([(k, 8.0 if k % 2 else 1.0) for k in range(600)], "doc_id long, weight double")
    got = mixing.mix_sources(docs, weights, weights=(1.0, 0.1), share=0.2).where("source = 'z' AND copies > 0")
    odd = got.where("doc_id % 2 = 1").count()
    assert odd > 2 * (got.count() - odd) > 0


def test_mixing_empty(spark):
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_running_totals(spark):
    rows = [(k % 3, (k * 37) % 101, k) for k in range(500)]
    got = running_totals(spark.createDataFrame(rows, "g int, o int, v long"), "g", [F.col("o"), F.col("v")], "v", "t")
    seen = defaultdict(int)
    totals = {(r.g, r.o, r.v): r.t for r in got.collect()}
    for g, o, v in sorted(rows):
        assert totals[g, o, v] == seen[g]
        seen[g] += v


def test_select_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "x"), (1, "b", "y"), (None, "c", "z"), (2, None, "n")], "doc_id long, text string, copies string"
    )
    plan = docs.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"))
    plan = plan.distinct().withColumn("copies", F.when(F.col("doc_id") == 2, 3).otherwise(1))
    got = sorted(map(str, select_rows(docs, plan).collect()))
    want = [(1, "a", "x"), (1, "b", "y"), (None, "c", "z"), *[(2, None, "n")] * 3]
    assert got == sorted(str(r) for r in spark.createDataFrame(want, docs.schema).collect())


def shard_rows(spark, rows, shards=5):
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, row int, shard int")
    return sharding.shard_documents(docs, shards=shards).collect()


def check_law(got, rows, shards=5):
    counts = Counter(r.shard for r in got)
    assert len(got) == len(rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_sharding(spark):
    rng = random.Random(2)
    rows = [(k, f"text {rng.randint(0, 150)}") for k in range(300)] + [(301, None), (302, ""), (None, "text 3"), (5, "é")]
    got = shard_rows(spark, rows)
    check_law(got, rows)
    where = defaultdict(set)
    for r in got:
        where[r.digest].add(r.shard)
    assert all(len(own) == 1 for own in where.values())
    by_id = {r.doc_id: r for r in got if r.doc_id in (301, 302)}
    assert by_id[301].size == by_id[302].size == 16 and by_id[301].text_crc32 == 0
    assert {(r.size, r.text_crc32) for r in got if r.digest and r.size == 18} >= {(18, zlib.crc32("é".encode()))}


@pytest.mark.parametrize("rows", [[(k, "copy") for k in range(200)], [(k, "copy" if k % 3 else f"own {k}") for k in range(200)], [(1, "a"), (2, "a")]])
def test_sharding_hot_family(spark, rows):
    """A family larger than a shard is split; quotas hold."""
    got = shard_rows(spark, rows)
    check_law(got, rows)
    family = [r.shard for r in got if r.digest == got[0].digest]
    assert len(set(family)) <= -(-len(family) // (len(rows) // 5)) + 1 if len(rows) > 5 else True


def test_propagation_on_a_graph(spark):
    """Two cliques with one link between them are pulled apart, whatever the ids."""
    rng = random.Random(9)
    names = rng.sample(range(1000), 16)
    links = [(names[a], names[b]) for side in (0, 8) for a in range(side, side + 8) for b in range(side, a)]
    links.append((names[0], names[8]))
    labels = {r.node: r.shard for r in sharding.propagate(spark.createDataFrame(links, "a long, b long"), [10, 10], rounds=8).collect()}
    assert max(Counter(labels.values()).values()) <= 10
    assert sum(labels[a] != labels[b] for a, b in links) <= 12


def test_sharding_empty(spark):
    assert shard_rows(spark, []) == []


def quality_rows():
    rng = random.Random(4)
    words = [f"word{k}" for k in range(200)]
    rows = []
    for k in range(400):
        own = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        good = k % 4 != 0
        rows.append((k, " ".join(own if good else [w.upper() + "!!" for w in own]), int(good)))
    return rows


def test_quality_held_out(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in rows] + [(None, None, "x", 1.0), (900, "", "x", 1.0), (3, rows[3][1], "x", 1.0)], "doc_id long, text string, label string, score double")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5, None), (7, 0), (7, 1), (12345, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("h"), quality.score_column(docs, model).alias("s")).collect()
    truth = {i: q for i, _, q in rows}
    own = [(r.s >= 0.5) == (truth[r.doc_id] == 1) for r in scored if r.h and r.doc_id in truth]
    assert len(own) > 100 and np.mean(own) > 0.97
    assert all(0 <= r.s <= 1 for r in scored) and len(scored) == len(rows) + 3
    assert len({r.s for r in scored if r.doc_id in (None, 900)}) == 1
    for r in scored:
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_quality_never_sees_held_out_labels(spark):
    rows = quality_rows()[:60]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    true = [(i, q) for i, _, q in rows]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in true]
    models = [quality.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (true, flipped)]
    assert np.array_equal(models[0][0], models[1][0]) and models[0][1] == models[1][1]


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r[0] for r in docs.select(quality.score_column(docs, model)).collect()] == [0.5]


def brute_neighbours(rows, nearest):
    rows = list({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = set()
    for q, qv in rows:
        if q % 20:
            continue
        close = [(-float((np.array(v) * np.array(qv)).sum()), i) for i, v in rows if (i, v) != (q, qv) and len(v) == len(qv)]
        out |= {(q, rank + 1, i) for rank, (_, i) in enumerate(sorted(close)[:nearest])}
    return out


def test_neighbours_small_table_is_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(k, np.float32(rng.normal(size=8)).astype(float).tolist()) for k in range(300)]
    rows += [(k, rows[40][1]) for k in range(300, 340)]  # ties
    rows += [(400, None), (420, [0.0] * 8), (440, [1.0, None] + [0.0] * 6), (460, [float("nan")] * 8), (480, [float("inf")] + [0.0] * 7)]
    rows += [rows[20], (None, rows[3][1]), (500, [1.0, 2.0]), (501, [3.0, 4.0]), (520, [])]
    table = spark.createDataFrame([(i, v, 1, 1) for i, v in rows], "vec_id long, embedding array<double>, row int, block int")
    got = neighbours.nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == brute_neighbours(rows, 20)


def test_neighbours_recall(spark, monkeypatch):
    """Vectors without structure, in several blocks: the forest finds nine tenths at least."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 3000)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 100)
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(6000, 32)) * rng.uniform(0.5, 1.5, size=(6000, 1))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in neighbours.nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
        assert r.score == float((vectors[r.query_id] * vectors[r.vec_id]).sum())
    hits = 0
    for q, own in got.items():
        close = vectors @ vectors[q]
        close[q] = -np.inf
        hits += len(own & set(np.argsort(-close)[:20].tolist()))
    assert len(got) == 300 and hits / (300 * 20) >= 0.9


def test_neighbours_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert neighbours.nearest_neighbours(none, F.col("vec_id") % 20 == 0).count() == 0


def test_words_do_not_depend_on_slices(monkeypatch):
    from serieslake.llm import textvec

    rng = random.Random(1)
    texts = ["".join(rng.choice("abC é \n\t") for _ in range(rng.randint(0, 400))) for _ in range(60)] + ["", None, "x" * 9000]
    column = pa.array(texts)
    whole = hashed_words(column)
    sets = [s.tolist() for s in shingle_sets(column, 5)]
    monkeypatch.setattr(textvec, "SLICE", 50)
    parts = hashed_words(column)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    assert [s.tolist() for s in shingle_sets(column.slice(3), 5)] == sets[3:]
    counts = [len((t or "").encode().split()) for t in texts]
    assert np.diff(whole[1]).tolist() == counts


def test_shingle_sets_work_on_small_slices():
    """Hashing the words of some megabytes of text takes little more than a small slice's arrays."""
    words = np.random.default_rng(3).integers(0, 50_000, (1000, 400))
    texts = pa.array([" ".join(f"word{k}" for k in row) for row in words])
    tracemalloc.start()
    for _ in shingle_sets(texts, 5):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20
