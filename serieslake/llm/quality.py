"""Quality classifier: hashed n-gram logistic regression, trained with follow-the-regularised-leader.

Features are runs of one and two words and runs of one to three word shapes (which kinds of
characters a word has, and the mark it ends with), hashed into one table of weights. A feature's
value is its share of the text's runs of that kind, so length alone does not move a score.
Training sees a bounded, documented sample of labelled rows; scoring is a sparse dot product in
the scanning tasks, with the weights (at most ``1 << BITS``) broadcast.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import column, small_batches, text_of
from serieslake.llm.textvec import combine, hash_words, mix, word_slices

BITS = 18
#: The most labelled rows that training looks at, those with the smallest hashes of their ids.
TRAIN_ROWS = 8000
#: Rows of a batch of texts or vectors in training.
TRAIN_BATCH = 250
EPOCHS = 4
SCALE = 20.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.002, 0.1

_KIND = np.full(256, 32, np.uint64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:], _KIND[[44, 46]] = 1, 2, 4, 8, 16
_MARK = np.arange(256, dtype=np.uint64)
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 0


def _shapes(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    letters = part[np.repeat(starts - first, lengths) + np.arange(lengths.sum())]
    kinds = np.bitwise_or.reduceat(_KIND[letters], first)
    return mix(kinds * np.uint64(256) + _MARK[part[ends - 1]])


#: The kinds of runs: of words or of shapes, and how many of them.
FAMILIES = (("words", 1), ("words", 2), ("shapes", 1), ("shapes", 2), ("shapes", 3))
_LONGEST = max(width for _, width in FAMILIES)


def feature_families(column_: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For one slice of the texts after another and each kind of run: (its number, table places,
    document of each). The last words of a slice are carried over, so that runs across its border
    count once; memory is bounded by a slice, not by the batch."""
    held: dict[str, np.ndarray] = {}
    shift = np.uint64(64 - BITS)
    for part, starts, ends, owner in word_slices(column_):
        if not len(starts):
            continue
        own = {"words": hash_words(part, starts, ends), "shapes": _shapes(part, starts, ends), "owner": owner}
        carried = len(held["owner"]) if held else 0
        own = {name: np.concatenate([held[name], own[name]]) if held else own[name] for name in own}
        for number, (kind, width) in enumerate(FAMILIES):
            first = max(carried - width + 1, 0)  # earlier runs belong to the slice before
            tokens, owners = own[kind][first:], own["owner"][first:]
            last = len(tokens) - width + 1
            if last <= 0:
                continue
            inside = owners[:last] == owners[width - 1 :]
            runs = mix(combine(tokens, width) + np.uint64(number * 7919))
            yield number, (runs[inside] >> shift).astype(np.int32), owners[:last][inside]
        held = {name: values[1 - _LONGEST :] for name, values in own.items()}


def _vector(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places of one text by kind of run, and their values."""
    found: list[list[np.ndarray]] = [[] for _ in FAMILIES]
    for number, places, _ in feature_families(text):
        found[number].append(places)
    places, values = [np.zeros(0, np.int32)], [np.zeros(0)]
    for family in found:
        runs = np.concatenate(family) if family else np.zeros(0, np.int32)
        own, times = np.unique(runs, return_counts=True)
        places.append(own)
        values.append(times * (SCALE / max(len(runs), 1)))
    return np.concatenate(places), np.concatenate(values)


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, label, text to label, places, values."""
    for batch in batches:
        texts = batch.column(2)
        places, values = [], []
        for k in range(batch.num_rows):
            own = _vector(texts.slice(k, 1))
            places.append(own[0])
            values.append(own[1])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.string()),
                batch.column(1).cast(pa.float64()),
                pa.array(places, pa.list_(pa.int32())),
                pa.array(values, pa.list_(pa.float64())),
            ],
            ["doc_id", "label", "places", "values"],
        )


def follow_leader(rows: Iterable[tuple[np.ndarray, np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """Weights and bias after EPOCHS passes; the bias is a feature of its own. Rows are read once and
    held one after the other in two arrays, which go back to the system whole when they are freed."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        gate = np.sign(own) * L1 - own
        found = gate / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(own) <= L1, 0.0, found)

    flat, held, bounds, labels = array("i"), array("d"), [0], []
    for places, values, label in rows:
        own, back = np.unique(places, return_inverse=True)
        summed = np.bincount(back, values, len(own)) if len(own) else np.zeros(0)
        flat.frombytes(np.append(own, size - 1).astype(np.int32).tobytes())
        held.frombytes(np.append(summed, 1.0).tobytes())
        bounds.append(len(flat))
        labels.append(label)
    all_places, all_values = np.frombuffer(flat, np.int32), np.frombuffer(held, np.float64)
    for _ in range(EPOCHS if labels else 0):
        for first, last, label in zip(bounds, bounds[1:], labels):
            at, x = all_places[first:last], all_values[first:last]
            w = weights(at)
            slope = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            step = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / ALPHA
            z[at] += slope - step * w
            n[at] += slope * slope
    found = weights(np.arange(size))
    return found[:-1], float(found[-1])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        for batch in batches:
            for k, label in enumerate(batch.column(1).to_pylist()):
                places, values = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in (2, 3))
                yield places, values, label

    found, bias = follow_leader(rows())
    kept = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(kept, -1), pa.int32()),
            pa.array(np.append(found[kept], bias), pa.float64()),
        ],
        ["place", "weight"],
    )


def held_out(doc_id: Column) -> Column:
    """Rows kept away from training: CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> tuple[np.ndarray, float]:
    """Weights and bias. Null ids and labels are passed over; of conflicting labels the larger
    counts, of documents that repeat an id the least text. Without rows all scores are 0.5."""
    usable = (
        labels.select(column("doc_id").alias("doc_id"), column(label_column).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select(column("doc_id").alias("doc_id"), text_of().alias("text"))
    # At most train_rows small rows.
    joined = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.min("text").alias("text")
    )
    vectors = joined.select("doc_id", "label", "text").mapInArrow(
        _featurize, "doc_id string, label double, places array<int>, values array<double>"
    )
    fitted = (
        vectors.repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
        .mapInArrow(_fit, "place int, weight double")
    )
    with small_batches(docs.sparkSession, TRAIN_BATCH):
        model = fitted.toPandas()
    weights = np.zeros(1 << BITS)
    kept = model[model["place"] >= 0]
    weights[kept["place"].to_numpy()] = kept["weight"].to_numpy()
    return weights, float(model.loc[model["place"] < 0, "weight"].iloc[0]) if len(model) else 0.0


def score_column(docs: DataFrame, model: tuple[np.ndarray, float], text_column: str = "text") -> Column:
    """The probability of label 1 from the text alone; without words that of the bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        weights, bias = shared.value
        sums, sizes = np.zeros((2, len(FAMILIES), len(texts)))
        for number, places, owner in feature_families(texts):
            sums[number] += np.bincount(owner, weights[places], len(texts))
            sizes[number] += np.bincount(owner, minlength=len(texts))
        total = bias + SCALE * (sums / np.maximum(sizes, 1)).sum(axis=0)
        return pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))

    return score(text_of(text_column))
