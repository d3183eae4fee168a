"""MinHash near-duplicates through an LSH forest.

A document is the set of its distinct three-word runs. Its signature has ``TREES`` sequences of
``MOST_DEPTH`` minima; every tree orders all sets by one sequence, and sets that share a long prefix
of it are neighbours. How long is decided region by region: a region is all sets with one prefix
of ``LEAST_DEPTH`` values, and while it holds more than ``REGION`` sets it is cut by the next value.
Two sets of similarity s share the deepest prefix in at least one tree with probability
1 - (1 - s ** MOST_DEPTH) ** TREES, whatever the regions do: 0.999992 at 0.85.

From candidates to links:

* inside a region, pairs whose signatures agree in at least ``AGREE`` of the hundred places are
  candidates (a pair of similarity 0.85 falls below by chance once in some 10 ** 10 cases); a
  region that is still crowded at the deepest prefix counts as one group of candidates;
* connected candidates form a cluster, whose whole sets are brought together once, in blocks of
  bounded size. Each block is compared with itself and with the cluster's first block, by products
  of incidence matrices. Only sets that are then outside their cluster's largest component meet the
  remaining blocks. So every pair of a cluster is confirmed on full sets or already connected, and
  tasks write a spanning forest of links, never all pairs.

Runs are 64-bit hashes of words, and equal sets are one class, known by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import column, digest_of, small_batches, text_of
from serieslake.llm.graph import components
from serieslake.llm.textvec import shingle_sets
from serieslake.operators.totals import running_totals
from serieslake.session import cut_lineage

WIDTH = 3
PERCENT = 85
TREES, LEAST_DEPTH, MOST_DEPTH = 20, 3, 5
PLACES = TREES * MOST_DEPTH
REGION = 64
AGREE = 60
#: A block of a cluster: at most so many sets, and so many runs but for its last set.
BLOCK_SETS, BLOCK_RUNS = 256, 1 << 20
#: The filter that names sets which the second scan returns; false hits cost time only.
LEAST_BITS, MOST_BITS, BITS_A_SET = 1 << 16, 1 << 26, 16
#: Digests of sets a task remembers, so that it sends a repeated one without its minima.
REMEMBERED = 200_000

_RANDOM = np.random.default_rng(20250311)
_TURNS = _RANDOM.integers(0, 2**64, (PLACES, 1), np.uint64)
_FACTORS = _RANDOM.integers(0, 2**63, (PLACES, 1), np.uint64) * np.uint64(2) + np.uint64(1)


def signature_of(runs: np.ndarray) -> bytes:
    return hashlib.blake2b(runs.tobytes(), digest_size=16).digest()


def minima(runs: np.ndarray) -> np.ndarray:
    """The least of the scrambled runs for every place of the signature."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(runs), 2048):
        scrambled = (runs[None, first : first + 2048] ^ _TURNS) * _FACTORS
        scrambled ^= scrambled >> np.uint64(29)
        np.minimum(least, scrambled.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


class Remembered:
    """Digests seen in a task; forgotten when full, which costs repeated rows only."""

    def __init__(self):
        self.seen: set[bytes] = set()

    def new(self, signature: bytes) -> bool:
        if signature in self.seen:
            return False
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        self.seen.add(signature)
        return True


def signed_documents(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """doc_id, digest (of the text), n, signature, minima (null where the task sent them before)
    and row of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered()
        for batch in batches:
            sizes, signatures, least = [], [], []
            for runs in shingle_sets(batch.column(1), width):
                signature = signature_of(runs)
                sizes.append(len(runs))
                signatures.append(signature)
                new = len(runs) and known.new(signature)
                least.append(minima(runs).tobytes() if new else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(least, pa.binary()),
                ],
                ["doc_id", "digest", "n", "signature", "minima"],
            )

    slim = docs.select(
        column(id_column).alias("doc_id"),
        text_of(text_column).alias("text"),
        digest_of(text_column).alias("digest"),
    )
    kind = slim.schema["doc_id"].dataType.simpleString()
    found = slim.mapInArrow(
        sign, f"doc_id {kind}, digest binary, n long, signature binary, minima binary"
    )
    return cut_lineage(found.withColumn("row", F.monotonically_increasing_id()), "signed")


def _crowded(entries: DataFrame, depth: int) -> DataFrame:
    """Entries whose prefix of this depth others share, with the number of members."""
    counts = entries.groupBy(f"p{depth}").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return cut_lineage(entries.join(counts, f"p{depth}"), "crowded")


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Sorted rows in tables that never split the rows of one key (the first ``keys`` columns)."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        last = np.ones(table.num_rows, bool)
        for k in range(keys):
            values = table.column(k).to_numpy()
            last &= values == values[-1]
        cut = int(np.argmax(last))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None:
        yield held


def _forest(pairs: np.ndarray, parent: list[int]) -> list[int]:
    """The places of the pairs that join two trees; ``parent`` is updated."""

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    kept = []
    for place, (a, b) in enumerate(pairs.tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(place)
    return kept


def region_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """region, class, minima, sorted by region: a spanning forest of each region's candidates."""
    for table in _whole_groups(batches, 1):
        region = table.column(0).to_numpy()
        classes = table.column(1).to_numpy()
        flat = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint32)
        sketch = flat.reshape(-1, PLACES).astype(np.uint8)
        near, shift = [], 1
        at = np.arange(len(region) - 1)
        while len(at):
            at = at[at + shift < len(region)]
            at = at[region[at] == region[at + shift]]
            agree = (sketch[at] == sketch[at + shift]).sum(axis=1) >= AGREE
            near.append(np.column_stack([at[agree], at[agree] + shift]))
            shift += 1
        pairs = np.concatenate(near) if near else np.zeros((0, 2), np.int64)
        pairs = pairs[_forest(pairs, list(range(len(region))))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(classes[pairs[:, 0]]), pa.array(classes[pairs[:, 1]])], ["a", "b"]
        )


def candidate_edges(classes: DataFrame) -> DataFrame:
    """a, b: connects all classes that are candidates of each other in some tree."""
    depths = range(LEAST_DEPTH, MOST_DEPTH + 1)
    entries = classes.select(
        "class", "minima", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    ).select(
        "class",
        *[
            F.expr(f"xxhash64(tree, substring(minima, tree * {4 * MOST_DEPTH} + 1, {4 * d}))").alias(f"p{d}")
            for d in depths
        ],
    )
    order = [f"p{d}" for d in depths]
    settled, open_ = [], entries
    for depth in depths:
        open_ = _crowded(open_, depth)
        settled.append(
            open_.where(F.col("members") <= REGION).select(F.col(f"p{depth}").alias("region"), "class", *order)
        )
        open_ = open_.where(F.col("members") > REGION).drop("members")
    regions = settled[0]
    for more in settled[1:]:
        regions = regions.unionByName(more)
    # At most REGION rows share a region.
    inside = (
        regions.join(classes.select("class", "minima"), "class")
        .select("region", "class", "minima", *order)
        .repartition("region")
        .sortWithinPartitions("region", *order, "class")
        .select("region", "class", "minima")
        .mapInArrow(region_edges, "a long, b long")
    )
    deepest = f"p{MOST_DEPTH}"
    heads = open_.groupBy(deepest).agg(F.min("class").alias("a"))
    crowds = open_.join(heads, deepest).select("a", F.col("class").alias("b")).where("a != b")
    return cut_lineage(inside.unionByName(crowds), "candidates")


def _bits_of(wanted: DataFrame) -> np.ndarray:
    """A filter of bounded size over signatures."""
    count = wanted.count()
    bits = min(max(LEAST_BITS, 1 << (BITS_A_SET * count).bit_length()), MOST_BITS)
    place = F.conv(F.hex(F.substring("signature", 1, 4)), 16, 10).cast("long") % bits
    cells = (
        wanted.select(place.alias("place"))
        .groupBy(F.expr("place div 64").alias("cell"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits"))
        .toPandas()
    )
    out = np.zeros(bits // 64, np.uint64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def wanted_sets(docs: DataFrame, text_column: str, width: int, wanted: DataFrame) -> DataFrame:
    """The sets of the signatures in ``wanted``, with its other columns."""
    shared = docs.sparkSession.sparkContext.broadcast(_bits_of(wanted))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, known = shared.value, Remembered()
        bits = len(cells) * 64
        for batch in batches:
            signatures, found = [], []
            for runs in shingle_sets(batch.column(0), width):
                signature = signature_of(runs)
                at = int.from_bytes(signature[:4], "big") % bits
                if int(cells[at >> 6]) >> (at & 63) & 1 and known.new(signature):
                    signatures.append(signature)
                    found.append(runs.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signatures, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                ["signature", "runs"],
            )

    found = docs.select(text_of(text_column).alias("text")).mapInArrow(
        sets, "signature binary, runs array<long>"
    )
    once = found.groupBy("signature").agg(F.first("runs").alias("runs"))
    return cut_lineage(wanted.join(once, "signature").drop("signature"), "sets")


def similar_pairs(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """All pairs of sets (of distinct sorted numbers) whose similarity is at least ``percent``."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = np.zeros((2, 2), np.int64)
        both[0, 1] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        names = np.cumsum(times > 1) - 1  # runs that only one set has are left out
        shared = times[at] > 1
        owner, at = owner[shared], names[at[shared]]
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        both = np.zeros((len(sets), len(sets)), np.int64)
        for first in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
            low, high = np.searchsorted(at, [first, first + 4096])
            has = np.zeros((len(sets), 4096), np.float32)
            has[owner[low:high], at[low:high] - first] = 1
            both += (has @ has.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    return np.argwhere(np.triu((both > 0) & (100 * both >= percent * union), 1))


def _block_links(percent: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """cluster, part, node, known, runs, sorted by the first two: links within each part that
        join sets of different known components."""
        for table in _whole_groups(batches, 2):
            cluster, part = table.column(0).to_numpy(), table.column(1).to_numpy()
            node, known = table.column(2).to_numpy(), table.column(3).to_numpy()
            lists = table.column(4).combine_chunks()
            flat = lists.values.to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy()
            change = np.flatnonzero((np.diff(cluster) != 0) | (np.diff(part) != 0)) + 1
            borders = [0, *change.tolist(), len(node)]
            left, right = [], []
            for low, high in zip(borders[:-1], borders[1:]):
                if high - low < 2:
                    continue
                sets = [flat[offsets[k] : offsets[k + 1]] for k in range(low, high)]
                pairs = similar_pairs(sets, percent)
                _, same = np.unique(known[low:high], return_inverse=True)
                kept = _forest(same[pairs], list(range(high - low)))
                left.append(node[low + pairs[kept, 0]])
                right.append(node[low + pairs[kept, 1]])
            empty = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(left or empty)), pa.array(np.concatenate(right or empty))],
                ["a", "b"],
            )

    return links


def _compared(parts: DataFrame, percent: int, name: str) -> DataFrame:
    """``parts`` has cluster, part, node, known and runs."""
    return cut_lineage(
        parts.select("cluster", "part", "node", "known", "runs")
        .repartition("cluster", "part")
        .sortWithinPartitions("cluster", "part")
        .mapInArrow(_block_links(percent), "a long, b long"),
        name,
    )


def _in_blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Adds the block of each node: neighbours within its cluster, bounded in sets and runs."""
    weight = F.greatest(F.col("n"), F.lit(BLOCK_RUNS // BLOCK_SETS))
    placed = running_totals(nodes.withColumn("weight", weight), "cluster", [F.asc("node")], "weight", "before")
    return placed.withColumn(name, F.expr(f"before div {BLOCK_RUNS}")).drop("weight", "before")


def verified_links(
    docs: DataFrame, text_column: str, width: int, percent: int, classes: DataFrame, edges: DataFrame
) -> DataFrame:
    """Links that connect exactly what all links among the candidates' clusters connect."""
    clusters = components(edges).select(F.col("node").alias("class"), F.col("component").alias("cluster"))
    nodes = clusters.join(classes.select("class", "signature", "n"), "class").withColumnRenamed("class", "node")
    placed = cut_lineage(_in_blocks(nodes, "block"), "placed")
    lasts = placed.groupBy("cluster").agg(F.max("block").alias("last"))
    sets = wanted_sets(docs, text_column, width, placed.join(lasts, "cluster"))
    # A cluster's first block goes to all its blocks, which costs as many rows again.
    first = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("last"))).otherwise(F.array("block"))
    links = _compared(
        sets.withColumn("part", F.explode(first)).withColumn("known", F.col("node")), percent, "links"
    )
    many = sets.where("last > 0")
    if many.isEmpty():
        return links
    known = components(links)
    many = cut_lineage(
        many.join(known, "node", "left").withColumn("known", F.coalesce("component", "node")).drop("component"),
        "many",
    )
    sizes = many.groupBy("cluster", "known").agg(F.count(F.lit(1)).alias("members"))
    split = sizes.groupBy("cluster").agg(
        F.max(F.struct("members", "known"))["known"].alias("main"), F.count(F.lit(1)).alias("parts")
    )
    split = cut_lineage(split.where("parts > 1").select("cluster", "main"), "split")
    unjoined = many.join(split, "cluster")
    others = cut_lineage(
        _in_blocks(unjoined.where("known != main").select("cluster", "node", "n"), "other"), "others"
    )
    ends = others.groupBy("cluster").agg(F.max("other").alias("end"))
    sides = unjoined.join(ends, "cluster").join(others.select("node", "other"), "node", "left")
    # Blocks of others are numbered after the cluster's own blocks; a part is a pair of numbers.
    mine = F.col("last") + 1 + F.col("other")
    below, above = F.sequence(F.lit(0), mine), F.sequence(mine, F.col("last") + 1 + F.col("end"))
    pair = F.concat(
        F.transform(below, lambda k: F.struct(k.alias("x"), mine.alias("y"))),
        F.filter(
            F.transform(above, lambda k: F.struct(mine.alias("x"), k.alias("y"))), lambda p: p["x"] != p["y"]
        ),
    )
    met = F.transform(
        F.sequence(F.col("last") + 1, F.col("last") + 1 + F.col("end")),
        lambda k: F.struct(F.col("block").alias("x"), k.alias("y")),
    )
    parts = sides.withColumn("pair", F.explode(F.when(F.col("known") == F.col("main"), met).otherwise(pair)))
    more = _compared(
        parts.withColumn("part", F.col("pair.x") * F.lit(1 << 31) + F.col("pair.y")), percent, "links"
    )
    return links.unionByName(more)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, digest (of the text),
    component (a number of its own for every component, null without words).

    component_id is the smallest id reachable by links, its own included; kept says that it is the
    row's own. Null and empty texts and texts of white space have no words and link with nothing. Texts
    of any length count whole. Rows that repeat an id or a text keep rows of their own; equal sets
    link. A null id never names a component unless all its ids are null, then such rows are kept. An
    empty table gives no rows. Other columns are not looked at.
    """
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, id_column, text_column, width, percent)


def _near_duplicates(
    docs: DataFrame, id_column: str, text_column: str, width: int, percent: int
) -> DataFrame:
    signed = signed_documents(docs, id_column, text_column, width)
    classes = cut_lineage(
        signed.where("n > 0")
        .groupBy("signature")
        .agg(
            F.min(F.when(F.col("minima").isNotNull(), F.struct("row", "minima"))).alias("head"),
            F.min("doc_id").alias("least"),
            F.first("n").alias("n"),
        )
        .select("signature", "least", "n", F.col("head.row").alias("class"), F.col("head.minima").alias("minima")),
        "classes",
    )
    links = verified_links(docs, text_column, width, percent, classes, candidate_edges(classes))
    parts = components(links)
    named = cut_lineage(
        classes.select("signature", "least", "class")
        .join(parts.withColumnRenamed("node", "class"), "class", "left")
        .select("signature", "least", F.coalesce("component", "class").alias("component")),
        "named",
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = cut_lineage(named.join(smallest, "component").drop("least"), "ids")
    own = F.coalesce("component_id", "doc_id")
    return (
        signed.select("doc_id", "digest", "n", "signature")
        .join(ids, "signature", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            own.alias("component_id"),
            F.col("doc_id").eqNullSafe(own).alias("kept"),
            "digest",
            "component",
        )
    )
