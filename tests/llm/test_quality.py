"""The quality classifier: features by slices, and training against a dense reference."""

from __future__ import annotations

import gc
import math

import numpy as np
import pyarrow as pa
import pytest

from serieslake.llm import quality, textvec

TEXTS = ["One two, three four.", "", None, "x " * 300, "Ünïcode words 12 and-so on " * 40, "a", "two words"]


@pytest.mark.parametrize("piece", [16, 100])
def test_features_do_not_depend_on_slices(monkeypatch, piece):
    whole = [quality._vector(pa.array([t], pa.string())) for t in TEXTS]
    monkeypatch.setattr(textvec, "SLICE", piece)
    for text, (places, values) in zip(TEXTS, whole):
        own = quality._vector(pa.array([text], pa.string()))
        assert np.array_equal(own[0], places) and np.allclose(own[1], values)


def test_features_of_a_batch_are_those_of_its_texts(monkeypatch):
    monkeypatch.setattr(textvec, "SLICE", 64)
    together = {}
    for number, places, owner in quality.feature_families(pa.array(TEXTS, pa.string())):
        for place, of in zip(places.tolist(), owner.tolist()):
            together.setdefault((of, number), []).append(place)
    for k, text in enumerate(TEXTS):
        alone = {}
        for number, places, _ in quality.feature_families(pa.array([text], pa.string())):
            alone.setdefault(number, []).extend(places.tolist())
        for number in range(len(quality.FAMILIES)):
            assert sorted(together.get((k, number), [])) == sorted(alone.get(number, []))


def test_training_equals_a_dense_reference(monkeypatch):
    monkeypatch.setattr(quality, "BITS", 4)
    rng = np.random.default_rng(4)
    rows = []
    for k in range(60):
        places = rng.integers(0, 16, rng.integers(0, 9)).astype(np.int32)
        rows.append((places, rng.uniform(0, 3, len(places)), float(k % 2)))
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return (math.copysign(quality.L1, z[i]) - z[i]) / (
            (quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2
        )

    for _ in range(quality.EPOCHS):
        for places, values, label in rows:
            x = [0.0] * 16 + [1.0]
            for place, value in zip(places, values):
                x[place] += value
            w = [weight(i) for i in range(17)]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            for i in range(17):
                if x[i]:
                    g = (p - label) * x[i]
                    z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                    n[i] += g * g
    got, bias = quality.follow_leader(rows)
    assert np.allclose(np.append(got, bias), [weight(i) for i in range(17)], atol=1e-9)


def test_training_holds_no_vectors_beside_its_own_form():
    """Rows come from an iterator, a batch is freed once its rows are taken over."""
    seen = []

    def batches():
        for at in range(6):
            rng = np.random.default_rng(at)
            places = [np.sort(rng.choice(1 << quality.BITS, 20, replace=False)).astype(np.int32) for _ in range(10)]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{at}-{k}" for k in range(10)]),
                    pa.array(rng.integers(0, 2, 10).astype(float)),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array([rng.random(20) for _ in range(10)], pa.list_(pa.float64())),
                ],
                ["doc_id", "label", "places", "values"],
            )
            del places
            yield batch
            del batch
            gc.collect()
            seen.append(pa.total_allocated_bytes())

    start = pa.total_allocated_bytes()
    fitted = next(quality._fit(batches()))
    assert len(seen) == 6 and fitted.num_rows >= 1
    assert max(seen) - start < 2 * (seen[0] - start) + 1000
    assert next(quality._fit(iter([]))).to_pydict() == {"place": [-1], "weight": [0.0]}
