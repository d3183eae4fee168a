"""Nearest neighbours by inner product from a forest of random-projection trees.

Rows are dealt into blocks of bounded size by a hash of their id. Every block grows a forest over
all its rows (nothing is sampled): a tree splits its rows at the median of their projections on the
line between two random rows. A query meets every block: the leaves of all trees of the block stand
in one priority queue, ordered by how far the query lies beyond the splits on the way, and are
taken until they hold ``share`` of the block's rows. The rows found are ranked by their exact inner
products, and the blocks' lists are merged.

A vector of norm r gets one more component, sqrt(R*R - r*r) with R the block's largest norm, so
that a larger inner product is a smaller distance, which is what the trees divide by.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.llm.common import column
from serieslake.session import cut_lineage

NEAREST = 20
BLOCK_ROWS = 8192
QUERY_ROWS = 8192
TREES = 8
LEAF_ROWS = 64
#: The part of a block's rows that a query meets, and the least number of rows. Chosen on vectors
#: without structure, the worst case, where few rows are far nearer than the rest.
SHARE = 0.65
LEAST_ROWS = 1024


class Tree:
    """One random-projection tree in arrays: node k splits on normals[k], offsets[k]."""

    def __init__(self, vectors: np.ndarray, rng: np.random.Generator, leaf_rows: int):
        self.normals, self.offsets, self.children, self.leaves = [], [], [], []
        self.root = self._grow(vectors, np.arange(len(vectors)), rng, leaf_rows)
        width = vectors.shape[1]
        self.normals = np.array(self.normals).reshape(-1, width)
        self.offsets = np.array(self.offsets)

    def _grow(self, vectors, rows, rng, leaf_rows) -> int:
        """The number of the node; leaves count down from -1."""
        if len(rows) > leaf_rows:
            one, other = vectors[rng.choice(rows, 2, replace=False)]
            normal = one - other
            length = np.linalg.norm(normal)
            if length < 1e-12:
                normal = rng.normal(size=len(one))
                length = np.linalg.norm(normal)
            normal = normal / length
            seen = vectors[rows] @ normal
            middle = np.median(seen)
            low = seen < middle
            if 0 < low.sum() < len(rows):
                me = len(self.normals)
                self.normals.append(normal)
                self.offsets.append(middle)
                self.children.append(None)
                left = self._grow(vectors, rows[low], rng, leaf_rows)
                right = self._grow(vectors, rows[~low], rng, leaf_rows)
                self.children[me] = (left, right)
                return me
        self.leaves.append(rows)
        return -len(self.leaves)

    def priorities(self, queries: np.ndarray) -> np.ndarray:
        """For each query and leaf the largest overshoot on the way: how a queue orders leaves."""
        out = np.empty((len(queries), len(self.leaves)))
        margins = queries @ self.normals.T - self.offsets if len(self.normals) else None
        open_nodes = [(self.root, np.full(len(queries), -np.inf))]
        while open_nodes:
            node, worst = open_nodes.pop()
            if node < 0:
                out[:, -node - 1] = worst
            else:
                left, right = self.children[node]
                open_nodes.append((left, np.maximum(worst, margins[:, node])))
                open_nodes.append((right, np.maximum(worst, -margins[:, node])))
        return out


def _lift(vectors: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top * top - (vectors * vectors).sum(axis=1), 0))
    return np.column_stack([vectors, rest])


def search_block(
    ids: np.ndarray,
    vectors: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    nearest: int = NEAREST,
    share: float = SHARE,
    seed: int = 0,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and exact inner products of the nearest rows found in the block."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    rng = np.random.default_rng(seed)
    lifted = _lift(vectors, np.sqrt((vectors * vectors).sum(axis=1).max()))
    trees = [Tree(lifted, rng, LEAF_ROWS) for _ in range(TREES)]
    leaves = [leaf for tree in trees for leaf in tree.leaves]
    sizes = np.array([len(leaf) for leaf in leaves])
    wanted = max(share * len(ids), min(len(ids), LEAST_ROWS))
    found = []
    for first in range(0, len(queries), 128):
        part = queries[first : first + 128]
        lifted_part = np.column_stack([part, np.zeros(len(part))])
        rank = np.argsort(np.hstack([t.priorities(lifted_part) for t in trees]), axis=1, kind="stable")
        for k, query in enumerate(part):
            # Leaves are taken in the queue's order until they hold enough different rows.
            taken = np.zeros(len(ids), bool)
            at, step = 0, max(1, int(wanted / sizes.mean() / 4))
            while taken.sum() < wanted and at < len(leaves):
                for leaf in rank[k, at : at + step]:
                    taken[leaves[leaf]] = True
                at += step
            rows = np.flatnonzero(taken)
            close = vectors[rows] @ query
            if len(rows) > nearest + 1:
                # One more for the query itself, and all that may tie after rounding.
                edge = np.partition(close, len(close) - nearest - 1)[len(close) - nearest - 1]
                rows = rows[close >= edge - 1e-9 * max(1.0, abs(edge))]
            exact = (vectors[rows] * query).sum(axis=1)
            best = np.lexsort((ids[rows], -exact))
            rows, exact = rows[best], exact[best]
            own = (ids[rows] == query_ids[first + k]) & (vectors[rows] == query).all(axis=1)
            found.append((ids[rows][~own][:nearest], exact[~own][:nearest]))
    return found


def _usable(vector: Column) -> Column:
    doubles = vector.cast("array<double>")
    return (
        vector.isNotNull()
        & F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(doubles, lambda x: x != 0)
    )


def nearest_neighbours(
    embeddings: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    nearest: int = NEAREST,
    share: float = SHARE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of every query, by inner product in double
    precision, ties to the smaller id; all rows, if there are fewer.

    ``is_query`` is a condition on the id, named ``vec_id``. Rows with a null id and vectors that
    are null, zero or hold null or non-finite components take no part; vectors of different length
    are never compared. A row that repeats id and vector is one row; equal vectors of other ids
    are neighbours like any others. An empty table gives no rows.
    """
    rows = embeddings.select(
        column(id_column).cast("long").alias("vec_id"), column(vector_column).cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    rows = cut_lineage(
        rows.dropDuplicates(["vec_id", "vector"])
        .withColumn("width", F.size("vector"))
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    counts = rows.agg(F.count(F.lit(1)), F.sum(is_query.cast("long"))).first()
    blocks = max(1, -(-counts[0] // BLOCK_ROWS))
    chunks = max(1, -(-(counts[1] or 0) // QUERY_ROWS))
    # Every row meets every chunk of queries, every query every block: the asked-for search.
    members = rows.select(
        "vec_id",
        "vector",
        "width",
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
    )
    # Both sides come from one table: new names keep their columns apart in the cogroup.
    asked = rows.where(is_query).select(
        "row",
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query"),
        F.col("width").alias("width"),
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
        F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"),
    )

    def stacked(column_: pa.ChunkedArray, width: int) -> np.ndarray:
        flat = column_.combine_chunks()
        return flat.values.to_numpy(zero_copy_only=False)[
            flat.offset * width : (flat.offset + len(flat)) * width
        ].reshape(len(flat), width)

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["row", "query_id", "vec_id", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        if not len(left) or not len(right):
            return pa.Table.from_arrays([pa.array([], kind) for kind in kinds], names)
        width = key[2].as_py()
        asked_ids = right["query_id"].to_numpy()
        found = search_block(
            left["vec_id"].to_numpy(),
            stacked(left["vector"], width),
            asked_ids,
            stacked(right["query"], width),
            nearest,
            share,
            seed=key[0].as_py(),
        )
        sizes = [len(ids) for ids, _ in found]
        return pa.Table.from_arrays(
            [
                pa.array(np.repeat(right["row"].to_numpy(), sizes), kinds[0]),
                pa.array(np.repeat(asked_ids, sizes), kinds[1]),
                pa.array(np.concatenate([ids for ids, _ in found]), kinds[2]),
                pa.array(np.concatenate([s for _, s in found]), kinds[3]),
            ],
            names,
        )

    key = ["block", "chunk", "width"]
    best = (
        members.groupBy(*key)
        .cogroup(asked.groupBy(*key))
        .applyInArrow(search, "row long, query_id long, vec_id long, score double")
    )
    ranked = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )
