"""Exact dedup and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from serieslake.llm import exact_dedup, jaccard
from serieslake.llm.graph import components
from serieslake.session import cut_lineage

SCHEMA = "doc_id long, text string, level string, name string, digest string, row string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in rows], SCHEMA)


LONG = "abcdefghij" * 3000
EXACT = [
    (1, "same"),
    (2, "same"),
    (3, LONG),
    (4, LONG + "!"),
    (5, LONG),
    (6, ""),
    (7, None),
    (8, " "),
    (9, "Same"),
    (None, "same"),
    (None, "alone"),
    (9, "Same"),
    (9, "other text, same id"),
    (10, "ab" * 4096),
    (11, "ab" * 4096),
    (12, "ab" * 8192),
    (13, "é" * 5000),
    (14, "é" * 5000),
]


def expected(rows):
    """One row per row; of equal texts one row with the largest id stays."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, own in groups.items():
        own.sort(key=lambda i: (i is None, -(i or 0)))
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, own[0], len(own), place == 0, sha) for place, i in enumerate(own)]
    return sorted(out, key=str)


def found(frame_):
    rows = frame_.withColumn("sha", F.lower(F.hex("digest"))).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.sha) for r in rows), key=str)


def test_exact_keeps_a_row_for_every_row(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, "b"), (None, "c"), (None, "c")]
    got = found(exact_dedup.exact_duplicates(frame(spark, rows)))
    assert len(got) == 7 and got == expected(rows)
    assert sorted(size for _, _, size, _, _ in got) == [1, 2, 2, 4, 4, 4, 4]


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_exact(spark, block):
    rows = EXACT if block > 7 else [(i, t and t[:200]) for i, t in EXACT]
    got = found(exact_dedup.exact_duplicates(frame(spark, rows), block_bytes=block))
    assert got == expected(rows)


def test_exact_with_colliding_fingerprints(spark):
    """Blocks that share a fingerprint are told apart by the blocks themselves."""

    def weak(block):
        return [(F.length(block) % 2).cast("long").alias("f1"), F.lit(0).alias("f2")]

    rows = [(i, t and t[:300]) for i, t in EXACT]
    got = found(exact_dedup.exact_duplicates(frame(spark, rows), block_bytes=16, fingerprint=weak))
    assert got == expected(rows)


def test_exact_empty(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if sets[k] and i is not None:
            ids[root(k)].append(i)
    return sorted(
        (
            (i, len(sets[k]), min(ids[root(k)], default=i) if sets[k] else i)
            for k, (i, _) in enumerate(rows)
        ),
        key=str,
    )


def near_rows():
    """Families whose members differ by a word here and there, chains, and a shared passage."""
    rows, number = [], 0
    passage = " ".join(f"p{k}" for k in range(30))
    for family in range(6):
        words = [f"w{family}x{k}" for k in range(90)]
        for member in range(9):
            own = list(words)
            for k in range(family):
                own[(member * 11 + k * 17) % 90] = f"edit{family}.{member}.{k}"
            rows.append((number, " ".join(own)))
            number += 3
    for k in range(12):
        rows.append((number + k, passage + " " + " ".join(f"u{k}v{j}" for j in range(20))))
    chain = [f"c{k}" for k in range(120)]
    for k in range(8):
        rows.append((500 + k, " ".join(chain[3 * k : 3 * k + 80])))
    rows += [(900, ""), (901, None), (902, " \n\t"), (903, "one two"), (904, "ONE  two"), (905, "two one")]
    rows += [(None, rows[0][1]), (None, "lonely words here"), (3, rows[1][1]), (906, "a b c d e " * 4000)]
    return rows


def test_jaccard(spark):
    rows = near_rows()
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, run int, n string")
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(table).collect()),
        key=str,
    )
    assert got == brute(rows)


def test_jaccard_without_frequent_runs(spark, monkeypatch):
    """The table of frequent runs changes the cost, never the result."""
    monkeypatch.setattr(jaccard, "FREQUENT_RUNS", 3)
    rows = near_rows()[:70]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows)


def test_jaccard_does_not_write_the_pairs_of_a_family(spark, monkeypatch):
    """A family just below the threshold is compared in blocks: its pairs never become rows."""
    rows = []
    for member in range(90):
        words = [f"w{k}" for k in range(100)]
        words[(member * 7) % 50] = f"left{member}"
        words[50 + (member * 11) % 50] = f"right{member}"
        rows.append((member, " ".join(words)))
    written = []

    def counted(frame, name="table"):
        kept = cut_lineage(frame, name)
        if name == "candidates":
            written.append(kept.count())
        return kept

    monkeypatch.setattr(jaccard, "cut_lineage", counted)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows)
    assert 0 < sum(written) < 10 * len(rows)


def test_jaccard_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(none).count() == 0
    assert jaccard.keep_one_each(none).count() == 0


def test_keep_one_each(spark):
    rows = near_rows()
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, digest string")
    kept = [(r.doc_id, r.text) for r in jaccard.keep_one_each(table).collect()]
    sets = [shingles(t) for _, t in kept]
    for a in range(len(kept)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            assert not both or 100 * both < 80 * len(sets[a] | sets[b])
    heads = {c for i, n, c in brute(rows) if n and c is not None}
    assert heads <= {i for i, _ in kept}
    assert {900, 901, 902} <= {i for i, _ in kept}


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (4, 6), (7, 7), (2, 1), *[(100 + k, 101 + k) for k in range(40)]]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, **{100 + k: 100 for k in range(41)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
