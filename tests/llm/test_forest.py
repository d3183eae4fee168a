"""Near duplicates through the LSH forest against brute force."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest

from serieslake.llm import lsh_forest


def shingles(text, width=3):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(own) < width:
        return {tuple(own)} if own else set()
    return {tuple(own[k : k + width]) for k in range(len(own) - width + 1)}


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if sets[k] and i is not None:
            ids[root(k)].append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        own = min(ids[root(k)], default=i) if sets[k] else i
        out.append((i, len(sets[k]), own, i == own))
    return sorted(out, key=str)


def near_rows(copies=9):
    """Families whose members differ by a few words, chains, a shared passage and odd rows."""
    rng = np.random.default_rng(3)
    rows, number = [], 0
    passage = " ".join(f"p{k}" for k in range(30))
    for family in range(6):
        words = [f"w{family}x{k}" for k in range(150)]
        for member in range(copies):
            own = list(words)
            for place in rng.integers(0, 150, family):
                own[place] = f"edit{family}.{member}.{place}"
            rows.append((number, " ".join(own)))
            number += 3
    for k in range(12):
        rows.append((number + k, passage + " " + " ".join(f"u{k}v{j}" for j in range(20))))
    chain = [f"c{k}" for k in range(160)]
    for k in range(8):
        rows.append((5000 + k, " ".join(chain[4 * k : 4 * k + 110])))
    rows += [(9000, ""), (9001, None), (9002, " \n\t"), (9003, "one two"), (9004, "ONE  two"), (9005, "two one")]
    rows += [(None, rows[0][1]), (None, "lonely words here"), (3, rows[1][1]), (9006, "a b c d e " * 4000)]
    return rows


def answers(spark, rows):
    table = spark.createDataFrame(
        [(i, t, 1, "x", 2, b"z") for i, t in rows],
        "doc_id long, text string, cluster int, signature string, n int, digest binary",
    )
    found = lsh_forest.near_duplicates(table).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str)


def test_forest(spark):
    assert answers(spark, near_rows()) == brute(near_rows())


@pytest.mark.parametrize("settings", [{"BLOCK_SETS": 4, "BLOCK_RUNS": 1000}, {"REGION": 2}, {"REMEMBERED": 2}])
def test_forest_in_small_blocks(spark, monkeypatch, settings):
    """Cutting clusters into blocks and crowded regions by depth changes the cost, not the result."""
    for name, value in settings.items():
        monkeypatch.setattr(lsh_forest, name, value)
    rows = near_rows(30)
    assert answers(spark, rows) == brute(rows)


def test_forest_empty(spark):
    assert lsh_forest.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("sets", [2, 3, 40])
def test_similar_pairs(sets):
    rng = np.random.default_rng(sets)
    made = [np.unique(rng.integers(0, 40, rng.integers(1, 60)).astype(np.int64)) for _ in range(sets)]
    got = {tuple(p) for p in lsh_forest.similar_pairs(made, 50).tolist()}
    wanted = set()
    for b in range(sets):
        for a in range(b):
            x, y = set(made[a].tolist()), set(made[b].tolist())
            if x & y and 100 * len(x & y) >= 50 * len(x | y):
                wanted.add((a, b))
    assert got == wanted


def test_minima_estimate_similarity():
    rng = np.random.default_rng(9)
    both = rng.integers(0, 2**63, 850).astype(np.uint64)
    left, right = (np.append(both, rng.integers(0, 2**63, 75).astype(np.uint64)) for _ in range(2))
    agree = (lsh_forest.minima(left) == lsh_forest.minima(right)).mean()
    assert abs(agree - 0.85) < 0.15
