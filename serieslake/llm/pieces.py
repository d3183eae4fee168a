"""SentencePiece encoding and decoding on a relational lattice.

Texts are cut into units at spaces, at line breaks and between letters and other marks, where no
piece of the vocabulary crosses (checked against the pieces). Every place of a unit is a row with
the longest piece that ends there. All other pieces that end there are endings of that one, so an
equi-join with the piece table, where a piece comes with its endings, gives the edges of the unit's
lattice. Edges are grouped by unit, and a higher-order aggregate folds them from left to right,
keeping the best path to every place (Viterbi). A character without a piece costs the unknown score
and becomes its bytes.

The fold keeps the best score to every place; the path is read back from the end of the unit. The
longest pieces are found by hashes of all lengths at once and compared character by character.

All this runs in the scanning tasks, without a shuffle: a task sends each unit that it does not
remember through the lattice once, ahead of the texts that hold it, and the texts follow as numbers
of units. What a task remembers is bounded; when full, it forgets the less used half. Units that are
frequent in a sample of the texts go through the lattice once, and every task starts with them: which
they are changes the cost, never the ids. Decoding joins pieces, turns byte pieces back into text and
takes off the leading mark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from serieslake.llm.common import column, small_batches, text_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Units that a task remembers, and units of texts that it gives on together.
REMEMBERED_UNITS = 300_000
DEALT_UNITS = 120_000
#: Units of texts whose ids are put together at once.
JOINED_UNITS = 100_000
#: Texts that are looked at for frequent units, as many of which a task knows from the start, and
#: units that are counted together there.
SAMPLED_TEXTS = 10_000
KNOWN_UNITS = 150_000
COUNTED_UNITS = 200_000
#: Units whose longest pieces are looked for together.
REACHED_UNITS = 20_000
#: Units this long are cut further, between characters that no piece holds side by side.
LONG_UNIT = 64
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: Size of the tables that sort out most substrings which are no pieces; a small one costs time only.
REACH_BITS = 18
_ODD = np.random.default_rng(5).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
#: Spaces and the letters or other marks that follow. Where a vocabulary has pieces that hold both
#: letters and marks, words are not cut between them.
_FINE = re.compile(rf" *[{_LATIN}]+| *[^{_LATIN} \n]+| +|\n")
_COARSE = re.compile(r" +[^ \n]*|\n|[^ \n]+")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


class Vocabulary:
    """Pieces of a SentencePiece model file, which the public library reads."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = range(model.get_piece_size())
        self.pieces = [model.id_to_piece(k) for k in count]
        self.bytes = {int(self.pieces[k][3:5], 16): k for k in count if model.is_byte(k)}
        self.normal = [
            k
            for k in count
            if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))
        ]
        self.scores = {k: float(model.get_score(k)) for k in self.normal}
        self.longest = max(len(self.pieces[k]) for k in self.normal)
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self.pairs = {
            self.pieces[k][i : i + 2].replace(MARK, " ")
            for k in self.normal
            for i in range(len(self.pieces[k]) - 1)
        }
        if any(MARK in self.pieces[k].lstrip(MARK) or "\n" in self.pieces[k] for k in self.normal):
            raise ValueError("a piece crosses a space or a line break")
        whole = [self.pieces[k].replace(MARK, " ") for k in self.normal]
        self.pattern = _FINE if all(_FINE.fullmatch(piece) for piece in whole) else _COARSE
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces to fall back on")
        #: Scores by id; the last one is that of a character without a piece.
        self.score_of = np.full(len(self.pieces) + 1, self.unknown)
        self.score_of[self.normal] = [self.scores[k] for k in self.normal]
        if self.longest > len(_ODD):
            raise ValueError("a piece is too long")
        #: Pieces that end a piece, itself included, by length: of piece k those numbered from
        #: ``first_ending[k]``, ``endings[k]`` of them. A last character without a piece is unknown.
        self.endings = np.zeros(len(self.pieces), np.int64)
        self.first_ending = np.zeros(len(self.pieces), np.int64)
        ids = {self.pieces[k]: k for k in self.normal}
        back, ended = [], []
        for k in self.normal:
            piece, self.first_ending[k] = self.pieces[k], len(back)
            for size in range(1, len(piece) + 1):
                ending = ids.get(piece[-size:], -1 - ord(piece[-1]) if size == 1 else None)
                if ending is not None:
                    back.append(size)
                    ended.append(ending)
            self.endings[k] = len(back) - self.first_ending[k]
        self.ending_back, self.ending_id = np.array(back, np.int64), np.array(ended, np.int64)
        #: By length: hashes of the pieces in order, their characters, and a table of hashes' first bits.
        self._hashed = {}
        for size in sorted({len(piece) for piece in whole if len(piece) > 1}):
            body = _codes("".join(piece for piece in whole if len(piece) == size)).reshape(-1, size)
            hashes = (body[:, ::-1].astype(np.uint64) * _ODD[:size]).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes)
            hashes, body = hashes[order], body[order]
            if (hashes[1:] == hashes[:-1]).any():
                raise ValueError("two pieces share a hash")
            table = np.zeros(1 << REACH_BITS, bool)
            table[hashes >> np.uint64(64 - REACH_BITS)] = True
            self._hashed[size] = hashes, body, table

    def units(self, text: str) -> list[str]:
        """The text, with the leading mark's space, in parts that no piece crosses."""
        if not text:
            return []
        found = self.pattern.findall(" " + text.replace(MARK, " "))
        if max(map(len, found)) <= LONG_UNIT:
            return found
        return [part for unit in found for part in self._cut(unit)]

    def reach(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For every place of every unit the length of the longest piece that ends there (1 where
        none does), and the units' lengths."""
        parts = [self._reach(units[k : k + REACHED_UNITS]) for k in range(0, len(units), REACHED_UNITS)]
        longest, lengths = zip(*parts) if parts else ([np.zeros(0, np.int32)],) * 2
        return np.concatenate(longest), np.concatenate(lengths)

    def _reach(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, units), np.int32, len(units))
        codes = _codes("".join(units).replace(MARK, " "))
        place = np.arange(1, len(codes) + 1, dtype=np.int32)
        place -= np.repeat(np.cumsum(lengths, dtype=np.int32) - lengths, lengths)
        wide = codes.astype(np.uint64)
        at, total, likely = np.arange(len(codes)), wide * _ODD[0], []
        for size in range(2, self.longest + 1):
            far = place[at] >= size
            at, total = at[far], total[far]
            total += wide[at - (size - 1)] * _ODD[size - 1]
            if size in self._hashed:
                hit = self._hashed[size][2][total >> np.uint64(64 - REACH_BITS)]
                likely.append((size, at[hit], total[hit]))
        longest = np.ones(len(codes), np.int32)
        for size, ends, own in reversed(likely):
            left = longest[ends] == 1
            ends, own = ends[left], own[left]
            hashes, body, _ = self._hashed[size]
            found = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            equal = hashes[found] == own
            ends, found = ends[equal], found[equal]
            same = np.ones(len(ends), bool)
            for k in range(size):
                same &= codes[ends - (size - 1 - k)] == body[found, k]
            longest[ends[same]] = size
        return longest, lengths

    def _cut(self, unit: str) -> list[str]:
        if len(unit) <= LONG_UNIT:
            return [unit]
        cuts = [i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in self.pairs]
        return [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)])]

    def with_bytes(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their counts by unit, with characters that have no piece as their bytes."""
        unknown = np.flatnonzero(ids < 0)
        if not len(unknown):
            return ids, sizes
        spelled = [[self.bytes[b] for b in chr(-1 - ids[k]).encode()] for k in unknown]
        widths = np.ones(len(ids), np.int64)
        widths[unknown] = [len(own) for own in spelled]
        ends = np.cumsum(widths)
        out = np.repeat(ids, widths)
        for k, own in zip(unknown, spelled):
            out[ends[k] - len(own) : ends[k]] = own
        upto = np.r_[0, ends]
        bounds = np.r_[0, np.cumsum(sizes)]
        return out, upto[bounds[1:]] - upto[bounds[:-1]]


@lru_cache(maxsize=4)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """piece, id, scores: those of the pieces that end the piece, by length (null: no piece)."""
    known = vocabulary_of(path)
    rows = []
    for k in known.normal:
        scores = [None] * len(known.pieces[k])
        first = known.first_ending[k]
        for place in range(first, first + known.endings[k]):
            scores[known.ending_back[place] - 1] = float(known.score_of[max(known.ending_id[place], -1)])
        rows.append((known.pieces[k], k, scores))
    return spark.createDataFrame(rows, "piece string, id int, scores array<double>")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places that follow one another in a task, as one row per ``seq``.

    ``places`` lists the scores of every place of the unit; ``ends`` holds the ids of the longest
    pieces there, four bytes a number. Rows of no unit pass as they are.
    """

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        seq = rows["seq"].to_numpy()
        if (np.diff(seq) < 0).any():
            raise ValueError("places of a unit are apart")
        firsts = np.flatnonzero(np.r_[True, np.diff(seq) != 0])
        borders = np.r_[firsts, len(seq)]
        scores, ids = (rows[name].combine_chunks() for name in ("scores", "id"))
        by_unit = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), scores)
        body = ids.fill_null(0).to_numpy().astype("<i4").tobytes()
        ends = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(firsts),
            [None, pa.py_buffer((borders * 4).astype(np.int64)), pa.py_buffer(body)],
        ).cast(pa.binary())
        kept = rows.drop_columns(["seq", "scores", "id"]).take(pa.array(firsts))
        columns = [c.combine_chunks() for c in kept.columns]
        return pa.RecordBatch.from_arrays(
            [*columns, by_unit, ends], [*kept.column_names, "places", "ends"]
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        seq = batch.column("seq").to_numpy()
        last = int(np.searchsorted(seq, seq[-1]))
        if last or (held and held[-1].column("seq")[-1].as_py() != seq[0]):
            if held or last:
                yield packed([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield packed(held)


def _best_scores(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ends and best: the longest pieces that end at the places of ``unit``, and the
    best score to each place, the last place first (an empty list where the unit is null).

    ``seq`` numbers the rows of a task upwards and ``reach`` has the lengths of the longest pieces.
    Places are exploded and joined to the broadcast pieces where the row is, so those of a unit
    follow one another and are grouped without a shuffle. ``unit``, ``reach`` and ``seq`` are
    not returned.
    """
    known = vocabulary_of(path)
    others = [name for name in rows.columns if name not in ("unit", "reach", "seq")]
    exploded = (
        rows.withColumn("marked", F.translate("unit", " ", MARK))
        .select("seq", *others, "marked", F.posexplode_outer("reach").alias("place", "most"))
        .withColumn("piece", F.expr("substring(marked, place + 2 - most, most)"))
        .drop("marked", "place")
    )
    # The piece table has as many rows as the vocabulary file, whatever the corpus. A character
    # without a piece is known by its code point, as a negative id.
    edges = (
        exploded.join(F.broadcast(piece_table(rows.sparkSession, path)), "piece", "left")
        .select(
            *others,
            "seq",
            F.when(F.col("most").isNotNull(), F.coalesce("scores", F.array(F.lit(known.unknown)))).alias("scores"),
            F.coalesce("id", -1 - F.ascii("piece")).alias("id"),
        )
    )
    kept = ", ".join(f"{name} {kind}" for name, kind in edges.select(*others).dtypes)
    grouped = edges.mapInArrow(_grouped, f"{kept}, places array<array<double>>, ends binary")
    # Most places end few and short pieces; their scores are compared without inner functions.
    near = [f"get(best, {k}) + get(scores, {k})" for k in range(4)]
    short = " ".join(f"WHEN {n} THEN greatest({', '.join(near[:n])})" for n in (2, 3, 4))
    fold = f"""aggregate(places, array(0D), (best, scores) -> array_prepend(best,
        CASE size(scores) {short} WHEN 1 THEN {near[0]}
        ELSE array_max(zip_with(slice(best, 1, size(scores)), scores, (b, s) -> b + s)) END))"""
    return grouped.select(
        *others, "ends", F.expr(f"if(size(places[0]) > 0, {fold}, array())").alias("best")
    )


def _paths(known: Vocabulary, ends: pa.Array, best: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best paths of units, one after another, and how many each has. Of equal scores
    the longest last piece is taken."""
    longest = np.frombuffer(b"".join(ends.to_pylist()), "<i4").astype(np.int64)
    scores = best.flatten().to_numpy()
    sizes = best.value_lengths().to_numpy().astype(np.int64)
    # Where a unit's score to its very beginning is: from there the places lie backwards.
    origin = np.cumsum(sizes) - 1
    width = pa.compute.binary_length(ends).to_numpy().astype(np.int64) // 4
    before = np.cumsum(width) - width - 1
    unit = np.flatnonzero(sizes > 1)
    place, counts, steps = sizes[unit] - 1, np.zeros(len(sizes), np.int64), []
    while len(unit):
        last = longest[before[unit] + place]
        back, taken = np.ones(len(unit), np.int64), last.copy()
        piece = np.maximum(last, 0)
        edges = np.where(last < 0, 0, known.endings[piece])
        edge = _spread(known.first_ending[piece], edges)
        own = np.repeat(np.arange(len(unit)), edges)
        there = (origin[unit] - place)[own]
        score = known.score_of[np.maximum(known.ending_id[edge], -1)]
        fits = scores[there + known.ending_back[edge]] + score == scores[there]
        own, edge = own[fits], edge[fits]
        back[own], taken[own] = known.ending_back[edge], known.ending_id[edge]  # the last, so the longest
        steps.append((unit, taken))
        counts[unit] += 1
        place = place - back
        going = place > 0
        place, unit = place[going], unit[going]
    out, ends = np.zeros(counts.sum(), np.int32), np.cumsum(counts)
    for k, (units, found) in enumerate(steps):
        out[ends[units] - 1 - k] = found
    return known.with_bytes(out, counts)


def encode_units(units: DataFrame, path: str) -> DataFrame:
    """unit, ids: the best path through each unit's lattice, for the rows of ``units``."""

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, seq = batch.columns
            reach = _listed(*vocabulary_of(path).reach(own.to_pylist()), 0)
            yield pa.RecordBatch.from_arrays([own, own, seq, reach], ["unit", "own", "seq", "reach"])

    rows = units.select("unit", F.monotonically_increasing_id().alias("seq")).mapInArrow(
        reached, "unit string, own string, seq long, reach array<int>"
    )

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, counts = _paths(vocabulary_of(path), batch.column("ends"), batch.column("best"))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), ids)
                yield pa.RecordBatch.from_arrays([batch.column("own"), lists], ["unit", "ids"])

    return _best_scores(rows, path).mapInArrow(unpacked, "unit string, ids array<int>")


class _Numbers(dict):
    """Numbers units and lists the new ones. Numbers of forgotten units are given again."""

    def __init__(self, known: list[str]):
        super().__init__(zip(known, range(len(known))))
        self.fresh: list[str] = []
        self.free: list[int] = []
        self.uses = np.zeros(len(known), np.int64)

    def __missing__(self, unit: str) -> int:
        self.fresh.append(unit)
        self[unit] = number = self.free.pop() if self.free else len(self)
        return number

    def count(self, numbers: np.ndarray) -> None:
        now = np.bincount(numbers, minlength=len(self.uses))
        now[: len(self.uses)] += self.uses
        self.uses = now

    def forget(self, kept: int) -> None:
        """Keeps the units used most, as many as ``kept``; later uses weigh more than earlier ones."""
        order = np.argsort(-self.uses, kind="stable")
        gone = np.zeros(len(self.uses), bool)
        gone[order[kept:]] = True
        for unit in [unit for unit, number in self.items() if gone[number]]:
            del self[unit]
        self.free = np.flatnonzero(gone).tolist()
        self.uses = np.where(gone, 0, self.uses // 2)


def _listed(flat: np.ndarray, lengths: np.ndarray, nulls: int) -> pa.Array:
    """Lists of these lengths, and as many nulls after them."""
    offsets = np.zeros(len(lengths) + nulls + 1, np.int32)
    np.cumsum(lengths, out=offsets[1 : len(lengths) + 1])
    offsets[len(lengths) :] = len(flat)
    absent = pa.array(np.arange(len(lengths) + nulls) >= len(lengths))
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=absent)


#: What comes before a text's numbers: the digest of the text, and the count of the numbers that
#: the new units ahead of it get.
DIGEST_BYTES, HEAD_BYTES = 32, 36


def frequent_units(
    docs: DataFrame, path: str, text_column: str, most: int
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Units that repeat most in a sample of the texts, how many ids each has, and all their ids."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = vocabulary_of(path), Counter()

        def repeated() -> pa.RecordBatch:
            found = [(unit, n) for unit, n in times.items() if n > 1]
            times.clear()
            columns = [pa.array([unit for unit, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["unit", "times"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                times.update(known.units(text))
                if len(times) > COUNTED_UNITS:
                    yield repeated()
        yield repeated()

    texts = docs.select(text_of(text_column).alias("text"))
    with small_batches(docs.sparkSession):
        share = min(1.0, SAMPLED_TEXTS / max(texts.count(), 1))
        frequent = (
            texts.sample(share, 5)
            .mapInArrow(counted, "unit string, times long")
            .groupBy("unit")
            .agg(F.sum("times").alias("times"))
            .orderBy(F.desc("times"), "unit")
            .limit(most)
            .select("unit")
            .repartition(32, "unit")
        )
        rows = encode_units(frequent, path).toArrow().combine_chunks()
    ids = rows["ids"].combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    sizes = ids.value_lengths().to_numpy().astype(np.int64)
    return rows["unit"].to_pylist(), sizes, ids.flatten().to_numpy()


def _deal(path: str, remembered: int, start):
    """Texts as numbers of units. Units that the task does not remember come first, as rows of their
    own that hold nothing else; their numbers come with the first text after them. Numbers of
    forgotten units are given again."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers, seq = vocabulary_of(path), _Numbers(start.value), 0

        def given(ids: pa.Array, digests: pa.Array, codes: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal seq
            units, numbers.fresh = numbers.fresh, []
            before, after = len(units), len(codes)
            n = before + after
            seq += n
            numbers.count(np.concatenate(codes))
            fresh = np.array([numbers[unit] for unit in units], np.int32)
            news = [fresh, *[fresh[:0]] * (after - 1)]
            bodies = [
                bytes.fromhex(digest) + np.int32(len(new)).tobytes() + new.tobytes() + own.tobytes()
                for digest, new, own in zip(digests.to_pylist(), news, codes)
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(seq - n, seq)),
                    pa.array(units + [None] * after, pa.string()),
                    _listed(*known.reach(units), after),
                    pa.concat_arrays([pa.nulls(before, ids.type), ids]),
                    pa.array([None] * before + bodies, pa.binary()),
                ],
                ["seq", "unit", "reach", "doc_id", "codes"],
            )

        for batch in batches:
            codes, first, held = [], 0, 0
            for k, text in enumerate(batch.column("text").to_pylist()):
                own = known.units(text)
                codes.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
                held += len(own)
                if held > DEALT_UNITS or len(numbers) > remembered or k == batch.num_rows - 1:
                    ids, digests = (batch.column(c).slice(first, k + 1 - first) for c in ("doc_id", "text_sha256"))
                    yield given(ids, digests, codes)
                    codes, first, held = [], k + 1, 0
                    if len(numbers) > remembered:
                        numbers.forget(remembered // 2)

    return deal


def _assembled(path: str, start):
    """Numbers of units replaced by the units' ids, whose lattices came before in the same task."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, flat = start.value
        starts = np.cumsum(sizes) - sizes
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def learn(numbers: np.ndarray) -> None:
            nonlocal flat, starts, sizes
            counts = np.concatenate([own for _, own in waiting])
            if len(counts) != len(numbers):
                raise ValueError("units and their numbers are apart")
            more = max(int(numbers.max()) + 1 - len(sizes), 0)
            starts, sizes = (np.concatenate([old, np.zeros(more, np.int64)]) for old in (starts, sizes))
            starts[numbers] = len(flat) + np.cumsum(counts) - counts
            sizes[numbers] = counts
            flat = np.concatenate([flat, *[ids for ids, _ in waiting]])
            waiting.clear()
            if len(flat) > 2 * sizes.sum() + 1_000_000:  # mostly paths of forgotten units
                flat = flat[_spread(starts, sizes)]
                starts = np.cumsum(sizes) - sizes

        for batch in batches:
            if not batch.num_rows:
                continue
            is_unit = batch.column("codes").is_null().to_numpy(zero_copy_only=False)
            bounds = np.r_[np.flatnonzero(np.r_[True, np.diff(is_unit)]), len(is_unit)]
            for low, high in zip(bounds[:-1], bounds[1:]):
                part = batch.slice(low, high - low)
                if is_unit[low]:
                    waiting.append(_paths(vocabulary_of(path), part.column("ends"), part.column("best")))
                    continue
                bodies = part.column("codes").to_pylist()
                if waiting:
                    numbers = np.frombuffer(bodies[0], np.int32, offset=DIGEST_BYTES)
                    numbers, rest = numbers[1 : 1 + numbers[0]], numbers[1 + numbers[0] :]
                    bodies[0] = bodies[0][:HEAD_BYTES] + rest.tobytes()
                    learn(numbers)
                counts = np.array([(len(body) - HEAD_BYTES) // 4 for body in bodies], np.int64)
                # A few texts at a time, as their ids take many times the room of the numbers.
                group = (np.cumsum(counts) - counts) // JOINED_UNITS
                cuts = np.r_[np.flatnonzero(np.r_[True, np.diff(group) != 0]), len(counts)]
                for first, last in zip(cuts[:-1], cuts[1:]):
                    some = bodies[first:last]
                    numbers = np.frombuffer(b"".join([body[HEAD_BYTES:] for body in some]), np.int32)
                    length = sizes[numbers]
                    ends = np.r_[0, np.cumsum(length)]
                    offsets = ends[np.r_[0, np.cumsum(counts[first:last])]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").slice(first, last - first),
                            pa.array([body[:DIGEST_BYTES].hex() for body in some], pa.string()),
                            pa.ListArray.from_arrays(
                                pa.array(offsets.astype(np.int32)), flat[_spread(starts[numbers], length)]
                            ),
                        ],
                        ["doc_id", "text_sha256", "ids"],
                    )

    return assemble


def encode_documents(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    remembered: int = REMEMBERED_UNITS,
) -> DataFrame:
    """One row per row of docs: doc_id, text_sha256, ids. Null and empty texts have no ids.

    Repeated rows and null ids stay as they are. The mark itself in a text counts as a space.
    ``remembered`` bounds the units that a task holds; it changes the cost, never the ids.
    """
    slim = docs.select(
        column(id_column).alias("doc_id"),
        F.sha2(text_of(text_column).cast("binary"), 256).alias("text_sha256"),
        text_of(text_column).alias("text"),
    )
    kind = dict(slim.dtypes)["doc_id"]
    units, *paths = frequent_units(docs, path, text_column, min(KNOWN_UNITS, remembered // 2))
    known, coded = (docs.sparkSession.sparkContext.broadcast(part) for part in (units, paths))
    dealt = slim.mapInArrow(
        _deal(path, remembered, known),
        f"seq long, unit string, reach array<int>, doc_id {kind}, codes binary",
    )
    scored = _best_scores(dealt, path)
    return scored.mapInArrow(_assembled(path, coded), f"doc_id {kind}, text_sha256 string, ids array<int>")


def decoded(ids: Column, path: str) -> Column:
    """The text of an array of ids."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        known = vocabulary_of(path)
        parts = [piece.replace(MARK, " ").encode() for piece in known.pieces]
        for value, place in known.bytes.items():
            parts[place] = bytes([value])
        every = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(part) for part in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        texts = []
        for own in lists:
            taken = own.values.to_numpy() if own.is_valid else np.zeros(0, np.int32)
            size = sizes[taken]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            body = every[np.repeat(starts[taken] - ends + size, size) + np.arange(total)].tobytes()
            texts.append(body[1:].decode("utf-8", "replace"))
        return pa.array(texts, pa.string())

    return decode(ids)
