"""Importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from serieslake.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def features(own, width=2):
    return [" ".join(own[k : k + n]) for n in range(1, width + 1) for k in range(len(own) - n + 1)]


def counted(texts, buckets):
    out = np.zeros(buckets, np.int64)
    for text in texts:
        for feature in features(words(text)):
            out[zlib.crc32(feature.encode()) % buckets] += 1
    return out


def brute(docs, target, buckets=10_000, least=20, percent=25, seed=7):
    s, t = counted([x for _, x in docs], buckets), counted(target, buckets)
    gains = [
        math.floor(1000 * math.log((b + 1.0) * (s.sum() + buckets) / ((a + 1.0) * (t.sum() + buckets))))
        for a, b in zip(s.tolist(), t.tolist())
    ]
    rows = []
    for doc_id, text in docs:
        own = words(text)
        found = features(own)
        weight = sum(gains[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        name = f"{seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), len(found), weight, weight + noise, None])
    able = [r for r in rows if r[1] >= least]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for place, row in enumerate(able[: len(able) * percent // 100]):
        row[5] = place + 1
    return sorted(map(tuple, rows), key=str)


def texts():
    rng = np.random.default_rng(5)
    pool = [f"w{k}" for k in range(60)] + ["Größe", "ÉTÉ", "日本語", "x" * 40, "a", "I", "don't", "e-mail", "\x7f"]
    rows = []
    for k in range(120):
        size = int(rng.integers(0, 90))
        rows.append((k, " ".join(pool[j] for j in rng.integers(0, len(pool), size))))
    rows += [(3, "again the same id " * 9), (3, "again the same id " * 9), (None, "no id here " * 10)]
    rows += [(500, ""), (501, None), (502, " \n.,;"), (503, "one"), (504, "end"), (505, "beginning")]
    rows += [(506, "long " * 3000 + "y" * 5000 + " tail" * 500), (507, "z" * 9000)]
    return rows


@pytest.mark.parametrize("piece, width", [(64, 2), (1000, 2), (300, 3), (1 << 20, 2)])
def test_slices_of_any_size_give_the_same_counts(monkeypatch, piece, width):
    """Texts and words go on across the borders of slices."""
    monkeypatch.setattr(resampling, "SLICE", piece)
    own = [t and t[:3000] for _, t in texts()]
    got, words_of = [Counter() for _ in own], np.zeros(len(own), int)
    for body, starts, ends, owners, of_words in resampling.ngram_slices(pa.array(own, pa.string()), width):
        np.add.at(words_of, of_words, 1)
        for a, b, k in zip(starts, ends, owners):
            got[k][body[a:b].tobytes().decode()] += 1
    assert got == [Counter(features(words(t), width)) for t in own]
    assert words_of.tolist() == [len(words(t)) for t in own]


def test_resampling(spark):
    rows, target = texts(), ["w1 w2 w3 Größe", None, "", "w1 w2 x", "no ID here"]
    table = spark.createDataFrame(
        [(i, t, "x", 1.0, 2) for i, t in rows], "doc_id long, text string, rank string, weight double, eligible int"
    )
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample_to_target(table, aim)
    got = [(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()]
    assert sorted(got, key=str) == brute(rows, target)


def test_resampling_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(k, "a b c " * 20) for k in range(8)], "doc_id long, text string")
    assert resampling.resample_to_target(none, some).count() == 0
    got = resampling.resample_to_target(some, none).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2]


def test_keys_are_those_of_the_library():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.integers(33, 127, n, np.uint8)) for n in range(1, 80) for _ in range(5)]
    body = np.frombuffer(b" ".join(strings) + b" " * 40, np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    starts = ends - [len(s) for s in strings]
    seen = resampling.Interned(body, starts, ends, np.zeros(len(strings), np.int64))
    for start, length, key in zip(seen.starts, seen.lengths, seen.keys):
        assert key == xxhash.xxh64_intdigest(body[start : start + length].tobytes())


def test_colliding_keys_are_told_apart_by_bytes():
    """With keys of two values every run is still counted for itself."""
    text = pa.array(["a b a c bb a b", "b a c cc dddddddddd a b"])

    def weak(lanes, length):
        return np.full(lanes.shape[1], length % 2, np.uint64)

    (slice_,) = resampling.ngram_slices(text, 2)
    body, starts, ends, owners, _ = slice_
    seen = resampling.Interned(body, starts, ends, owners, weak)
    got = {
        body[seen.starts[h] : seen.starts[h] + seen.lengths[h]].tobytes().decode(): int(seen.counts[slot])
        for slot, h in zip(seen.taken, seen.holders)
    }
    assert got == Counter(f for t in text.to_pylist() for f in features(t.split()))
