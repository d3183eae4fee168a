"""Target-distribution importance resampling over hashed n-grams.

Documents are drawn in proportion to how much likelier their n-grams are in a target corpus than
in the corpus itself. Both corpora are reduced to counts of n-grams by bucket; a bucket's gain is
the logarithm of the ratio of its smoothed shares, a document's weight the mean gain of its
n-grams, and Gumbel noise on the weight turns the highest scores into a draw without replacement.

N-grams are interned slice by slice in an open-addressed table of numpy arrays. The key is the
XXH64 of the n-gram's bytes, probing is linear, and a slot is taken over only if the bytes agree as
well, so a collision of keys costs a probe and never a wrong count. Slots hold the bucket and the
number of occurrences; every occurrence keeps its slot's number, through which it gathers a gain.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import column, text_of
from serieslake.llm.textvec import buffers
from serieslake.operators.totals import running_totals
from serieslake.session import cut_lineage

WIDTH = 2
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
SLICE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words are runs of digits, letters and anything beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Fixed values of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(0x9E3779B185EBCA87),
    np.uint64(0xC2B2AE3D27D4EB4F),
    np.uint64(0x165667B19E3779F9),
    np.uint64(0x85EBCA77C2B2AE63),
    np.uint64(0x27D4EB2F165667C5),
)
#: Runs below this many bytes fit the lanes and take the short form of XXH64.
SHORT = 32


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _short_keys(lanes: np.ndarray, length: int) -> np.ndarray:
    """XXH64 of byte strings of one length below 32, given as rows of little-endian lanes."""
    keys = np.full(lanes.shape[1], _P5 + np.uint64(length))
    for lane in lanes[: length // 8]:
        keys ^= _turn(lane * _P2, 31) * _P1
        keys = _turn(keys, 27) * _P1 + _P4
    rest = length % 8
    if rest:
        tail = lanes[length // 8]
        if rest >= 4:
            keys ^= (tail & _MASKS[4]) * _P1
            keys = _turn(keys, 23) * _P2 + _P3
        for place in range(4 * (rest >= 4), rest):
            keys ^= ((tail >> np.uint64(8 * place)) & np.uint64(255)) * _P5
            keys = _turn(keys, 11) * _P1
    keys ^= keys >> np.uint64(33)
    keys *= _P2
    keys ^= keys >> np.uint64(29)
    keys *= _P3
    return keys ^ (keys >> np.uint64(32))


class Interned:
    """The n-grams of one slice: buckets and counts by slot, the slot of every occurrence."""

    def __init__(
        self,
        body: np.ndarray,
        starts: np.ndarray,
        ends: np.ndarray,
        owners: np.ndarray,
        hashed: Callable[[np.ndarray, int], np.ndarray] = _short_keys,
    ):
        """``body`` ends with at least 32 bytes of padding."""
        lengths = ends - starts
        order = np.argsort(np.minimum(lengths, SHORT).astype(np.uint8), kind="stable")
        self.body, self.owners = body, owners[order]
        self.starts, self.lengths = starts[order], lengths[order]
        self._key(hashed)
        self._place()

    def _key(self, hashed: Callable[[np.ndarray, int], np.ndarray]) -> None:
        count = len(self.starts)
        self.keys, self.lanes = np.zeros(count, np.uint64), np.zeros((4, count), np.uint64)
        windows = np.ndarray((len(self.body) - 7,), "<u8", self.body, strides=(1,))
        borders = np.searchsorted(self.lengths[: np.count_nonzero(self.lengths < SHORT)], range(SHORT + 1))
        for length in range(1, SHORT):
            low, high = borders[length], borders[length + 1]
            if low == high:
                continue
            lanes = self.lanes[:, low:high]
            for lane in range(-(-length // 8)):
                lanes[lane] = windows[self.starts[low:high] + 8 * lane]
            lanes[(length - 1) // 8] &= _MASKS[(length - 1) % 8 + 1]
            self.keys[low:high] = hashed(lanes, length)
        long: dict[bytes, int] = {}  # told apart by their bytes; the number stands in for the lanes
        for place in range(borders[SHORT], count):
            start = self.starts[place]
            text = self.body[start : start + self.lengths[place]].tobytes()
            self.keys[place] = xxhash.xxh64_intdigest(text)
            self.lanes[0, place] = long.setdefault(text, len(long))

    def _place(self) -> None:
        count = len(self.starts)
        size = 1 << max(2 * count, 2).bit_length()
        mask = np.uint64(size - 1)
        table = np.full(size, -1, np.int32)
        self.slots = np.zeros(count, np.int64)
        waiting = np.arange(count, dtype=np.int32)
        at = (self.keys & mask).astype(np.int64)
        while len(waiting):
            holder = table[at]
            free = holder < 0
            if free.any():
                table[at[free]] = waiting[free]
                holder = table[at]
            same = (self.keys[holder] == self.keys[waiting]) & (
                self.lengths[holder] == self.lengths[waiting]
            )
            for lane in self.lanes:
                same &= lane[holder] == lane[waiting]
            self.slots[waiting[same]] = at[same]
            waiting = waiting[~same]
            at = (at[~same] + 1) & int(mask)
        self.counts = np.bincount(self.slots, minlength=size)
        self.taken = np.flatnonzero(table >= 0)
        self.holders = table[self.taken]

    def fill_buckets(self, buckets: int) -> np.ndarray:
        text, crc = self.body.tobytes(), zlib.crc32
        starts = self.starts[self.holders]
        ends = starts + self.lengths[self.holders]
        found = [crc(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        self.buckets = np.zeros(len(self.counts), np.int64)
        self.buckets[self.taken] = np.array(found, np.int64) % buckets
        return self.buckets


def ngram_slices(texts: pa.Array, width: int) -> Iterator[tuple]:
    """Yields (body, starts, ends, owners, owners of words) of one slice after another.

    ``body`` holds the slice's words in lower case with one space after each, so that a run of
    words is a range of it. A text longer than a slice goes on in the next one, which begins with
    the words that runs over the border still need.
    """
    source, offsets = buffers(texts)
    total, at = len(source), 0
    carried, carrier = [], -1
    while at < total:
        end = _border(source, offsets, min(at + SLICE, total))
        inner = offsets[(offsets > at) & (offsets < end)] - at
        first = int(np.searchsorted(offsets, at, side="right")) - 1
        kept = carried if carrier == first else []
        lead = b"".join(word + b" " for word in kept)
        part = np.concatenate(
            [np.frombuffer(lead, np.uint8), np.insert(_LOWER[source[at:end]], inner, 32)]
        )
        gaps = inner + np.arange(len(inner)) + len(lead)
        word = _WORD[part]
        after = np.zeros(len(part), bool)
        after[1:] = word[:-1]
        begins = np.flatnonzero(word & ~after)
        closed = np.append(word, False)
        finishes = np.flatnonzero(closed[:-1] & ~closed[1:]) + 1
        owners = first + np.searchsorted(gaps, begins)
        lengths = finishes - begins
        body = np.concatenate([np.where(word, part, 32)[word | after], np.full(SHORT + 8, 32)]).astype(np.uint8)
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = []
        for run in range(1, width + 1):
            count = max(len(starts) - run + 1, 0)
            inside = owners[:count] == owners[run - 1 :]
            inside[: max(len(kept) - run + 1, 0)] = False  # counted in the slice before
            spans.append((starts[:count][inside], ends[run - 1 :][inside], owners[:count][inside]))
        yield (body, *map(np.concatenate, zip(*spans)), owners[len(kept) :])
        if len(owners):
            carrier = owners[-1]
            last = [k for k in range(max(len(owners) - width + 1, 0), len(owners)) if owners[k] == carrier]
            carried = [body[starts[k] : ends[k]].tobytes() for k in last]
        at = end


def _border(source: np.ndarray, offsets: np.ndarray, end: int) -> int:
    """The first place from ``end`` on that is not inside a word."""
    total = len(source)
    while end < total:
        stop = min(end + 4096, total)
        outside = np.flatnonzero(~_WORD[_LOWER[source[end:stop]]])
        border = int(offsets[np.searchsorted(offsets, end)])
        nearest = min(end + int(outside[0]) if len(outside) else total, border)
        if nearest <= stop:
            return nearest
        end = stop
    return total


def bucket_counts(frame: DataFrame, text_column: str, width: int, buckets: int) -> np.ndarray:
    """Occurrences by bucket over all texts. A task sends one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for body, starts, ends, owners, _ in ngram_slices(batch.column(0), width):
                seen = Interned(body, starts, ends, owners)
                found = seen.fill_buckets(buckets)[seen.taken]
                totals += np.bincount(found, seen.counts[seen.taken], buckets).astype(np.int64)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(totals[used], pa.int64())], ["bucket", "times"]
        )

    rows = (
        frame.select(text_of(text_column).alias("text"))
        .mapInArrow(count, "bucket int, times long")
        .groupBy("bucket")
        .agg(F.sum("times").alias("times"))
        .toPandas()
    )
    counts = np.zeros(buckets, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["times"].to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over source share, floored, with one added to
    every bucket."""
    whole, aimed = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * whole / ((s + 1) * aimed)))
            for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())
        ],
        np.int64,
    )


def weigh_documents(
    docs: DataFrame, gains: np.ndarray, id_column: str, text_column: str, width: int
) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = shared.value
        for batch in batches:
            rows = batch.num_rows
            words, features = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            sums = np.zeros(rows, np.int64)
            for body, starts, ends, owners, of_words in ngram_slices(batch.column(1), width):
                seen = Interned(body, starts, ends, owners)
                gained = worth[seen.fill_buckets(len(worth))][seen.slots]
                words += np.bincount(of_words, minlength=rows)
                features += np.bincount(seen.owners, minlength=rows)
                sums += np.bincount(seen.owners, gained, rows).astype(np.int64)
            weights = np.where(features > 0, sums // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(features), pa.array(weights)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    slim = docs.select(column(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel_noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise, floored, from the id alone; a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample_to_target(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    width: int = WIDTH,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_features, weight, score, rank.

    ``rank`` is 1, 2, 3 ... over the drawn rows from the highest score down, ties to the smaller id
    (null last), else null. Drawn is a share of ``percent`` of the rows with at least
    ``least_words`` words. Null and empty texts have no words, weight 0 and no rank. Very long texts
    are worked on in slices. Rows that repeat an id get the same noise and ranks of their own; rows
    that tie in score, id and length are interchangeable. Empty tables are allowed on both sides;
    further columns of either are not looked at.
    """
    gains = bucket_gains(
        bucket_counts(docs, text_column, width, buckets),
        bucket_counts(target, target_column, width, buckets),
    )
    weighed = weigh_documents(docs, gains, id_column, text_column, width)
    scored = cut_lineage(
        weighed.withColumn("score", F.col("weight") + gumbel_noise(F.col("doc_id"), seed)).withColumn(
            "eligible", F.col("n_words") >= least_words
        ),
        "scored",
    )
    drawn = scored.where("eligible").count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    placed = running_totals(scored.withColumn("one", F.lit(1)), "eligible", order, "one", "before")
    rank = F.when(F.col("eligible") & (F.col("before") < drawn), F.col("before") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
