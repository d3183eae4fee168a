"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct five-word runs. Under one global order of the runs, rare
before frequent, two sets of similarity t or more share at least l runs among their first
n - ceil(t n) + l, for every l. Every document picks its own l: more runs in the prefix cost more
list entries to scan, but a partner must then share l of them before it is verified. A pair
becomes a candidate when it shares at least the smaller of its two l, so no true pair is lost.

Equal sets are one class from the start. Large families of near copies are not expanded into all
pairs: candidates with the first class of each list connect classes into clusters, and afterwards
only pairs of a list that lie in different clusters are counted. A cluster's whole sets are then
compared in blocks inside tasks (``lsh_forest.verified_links``), which write a spanning forest. So
every link is looked at or joins what is connected already, and the components are those of all links.

Runs are 64-bit hashes of words, and a class is known by a 128-bit digest of its sorted hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.llm.common import column, digest_of, select_rows, small_batches, text_of
from serieslake.llm.graph import components
from serieslake.llm.lsh_forest import Remembered, signature_of, verified_links
from serieslake.llm.textvec import shingle_sets
from serieslake.session import cut_lineage

WIDTH = 5
PERCENT = 80
MOST_MATCHES = 4
#: The frequent runs that are ordered last: a bounded table that every task gets. Which runs are
#: in it changes the cost of the join, never its result.
FREQUENT_RUNS = 100_000
LOCAL_REPEATS = 3
#: Runs that a task counts together.
HELD_RUNS = 500_000


def _texts(docs: DataFrame, text_column: str) -> DataFrame:
    return docs.select(text_of(text_column).alias("text"))


def frequent_runs(docs: DataFrame, text_column: str, width: int) -> np.ndarray:
    """The most frequent runs, most frequent last, from counts of runs that repeat in a batch."""

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = [], 0

        def counted():
            runs, counts = np.unique(np.concatenate(pending), return_counts=True)
            often = counts >= LOCAL_REPEATS
            return pa.RecordBatch.from_arrays(
                [pa.array(runs[often].view(np.int64)), pa.array(counts[often].astype(np.int64))],
                ["run", "times"],
            )

        for batch in batches:
            for runs in shingle_sets(batch.column(0), width):
                pending.append(runs)
                held += len(runs)
                if held > HELD_RUNS:
                    yield counted()
                    pending, held = [], 0
        if held:
            yield counted()

    counts = (
        _texts(docs, text_column)
        .mapInArrow(repeats, "run long, times long")
        .groupBy("run")
        .agg(F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "run")
        .limit(FREQUENT_RUNS)
        .toPandas()
    )
    return counts["run"].to_numpy()[::-1].view(np.uint64) if len(counts) else np.zeros(0, np.uint64)


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def document_prefixes(
    docs: DataFrame, id_column: str, text_column: str, width: int, percent: int, order: np.ndarray
) -> DataFrame:
    """doc_id, n, signature, row and the runs of the longest prefix (null if the task has already
    given those of an equal set)."""
    sort = np.argsort(order, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((order[sort], sort.astype(np.int64)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        seen = Remembered()
        for batch in batches:
            sizes, signatures, firsts = [], [], []
            for runs in shingle_sets(batch.column(1), width):
                n = len(runs)
                signature = signature_of(runs)
                sizes.append(n)
                signatures.append(signature)
                if not n or not seen.new(signature):
                    firsts.append(None)
                    continue
                if len(known):
                    at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
                    frequent = known[at] == runs
                    late = runs[frequent][np.argsort(rank[at[frequent]], kind="stable")]
                    runs = np.concatenate([runs[~frequent], late])
                length = min(n, _prefix_length(n, percent) + MOST_MATCHES - 1)
                firsts.append(runs[:length].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(firsts, pa.list_(pa.int64())),
                ],
                ["doc_id", "digest", "n", "signature", "prefix"],
            )

    slim = docs.select(
        column(id_column).alias("doc_id"),
        text_of(text_column).alias("text"),
        digest_of(text_column).alias("digest"),
    )
    kind = dict(slim.dtypes)["doc_id"]
    found = slim.mapInArrow(
        prefixes, f"doc_id {kind}, digest binary, n long, signature binary, prefix array<long>"
    )
    return cut_lineage(found.withColumn("row", F.monotonically_increasing_id()), "prefixes")


def _postings(prefixes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """node, n, matches, run: the adaptive prefix of each class, without runs nobody shares."""
    places = prefixes.where("prefix IS NOT NULL").select(
        F.col("row").alias("node"), "n", F.posexplode("prefix").alias("place", "run")
    )
    # One shuffle: the window only counts a run's rows, and runs alone in their list end here.
    listed = F.count(F.lit(1)).over(W.partitionBy("run"))
    places = cut_lineage(
        places.withColumn("listed", listed)
        .where("listed > 1")
        .join(classes.select(F.col("class").alias("node")), "node", "semi"),
        "places",
    )
    # Entries to scan, and sets to compare if each partner shares exactly as many as are asked.
    shortest = F.expr(f"n - CAST(ceil({percent} * n / 100) AS LONG) + 1")
    costs = []
    for matches in range(1, MOST_MATCHES + 1):
        scanned = F.sum(F.when(F.col("place") < shortest + (matches - 1), F.col("listed")))
        costs.append(
            F.struct(
                (scanned * (1 + F.max("n") / (16.0 * matches))).alias("cost"),
                F.lit(matches).alias("matches"),
            )
        )
    best = places.groupBy("node").agg(F.least(*costs)["matches"].alias("matches"))
    return cut_lineage(
        places.join(best, "node")
        .where(F.col("place") < shortest + F.col("matches") - 1)
        .select("node", F.col("n"), "matches", "run"),
        "postings",
    )


def _enough(pairs: DataFrame) -> DataFrame:
    """Candidates: pairs listed together often enough, of sizes that allow the similarity."""
    return (
        pairs.groupBy("a", "b")
        .agg(
            F.count(F.lit(1)).alias("together"),
            F.first("asked").alias("asked"),
        )
        .where("together >= asked")
        .select("a", "b")
    )


def _sized(percent: int) -> str:
    return f"least(x.n, y.n) * 100 >= {percent} * greatest(x.n, y.n)"


def _pair(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    return (
        left.alias("x")
        .join(right.alias("y"), F.expr(on))
        .select(
            F.expr("least(x.node, y.node)").alias("a"),
            F.expr("greatest(x.node, y.node)").alias("b"),
            F.expr("least(x.matches, y.matches)").alias("asked"),
        )
    )


def candidate_edges(lists: DataFrame, percent: int) -> DataFrame:
    """a, b: connects all classes that are candidates of each other, without all their pairs."""
    heads = cut_lineage(
        lists.groupBy("run").agg(F.min(F.struct("node", "n", "matches")).alias("head")).select(
            "run", "head.*"
        ),
        "heads",
    )
    near = f"x.run = y.run AND x.node != y.node AND {_sized(percent)}"
    tried = cut_lineage(_enough(_pair(lists, heads, near)), "candidates")
    parts = components(tried)
    listed = cut_lineage(
        lists.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")), "listed"
    )
    # The largest part of each list; lists within one part hold nothing to join.
    weights = listed.groupBy("run", "part").agg(F.count(F.lit(1)).alias("members"))
    mixed = cut_lineage(
        weights.groupBy("run")
        .agg(F.max(F.struct("members", "part")).alias("top"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("run", F.col("top")["part"].alias("main")),
        "mixed",
    )
    open_lists = cut_lineage(listed.join(mixed, "run").drop("component"), "open")
    others = open_lists.where("part != main")
    main = open_lists.where("part = main")
    apart = f"x.run = y.run AND {_sized(percent)}"
    rest = _pair(others, main, apart).unionByName(
        _pair(others, others, f"{apart} AND x.node < y.node AND x.part != y.part")
    )
    return tried.unionByName(cut_lineage(_enough(rest), "candidates"))


def jaccard_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, digest (of the text), component
    (a number of its own for every component, null without words).

    component_id is the smallest id reachable by links, its own included. Documents without words
    (null and empty texts) have no runs and link with nothing. Equal sets link, so repeated rows
    and copies share a component; a null id is in a component but never names it unless alone.
    An empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        return _components(docs, id_column, text_column, width, percent)


def _components(
    docs: DataFrame, id_column: str, text_column: str, width: int, percent: int
) -> DataFrame:
    order = frequent_runs(docs, text_column, width)
    prefixes = document_prefixes(docs, id_column, text_column, width, percent, order)
    classes = cut_lineage(
        prefixes.where("n > 0")
        .groupBy("signature")
        .agg(
            F.min(F.when(F.col("prefix").isNotNull(), F.col("row"))).alias("class"),
            F.min("doc_id").alias("least"),
            F.first("n").alias("n"),
        ),
        "classes",
    )
    lists = _postings(prefixes, classes, percent)
    links = verified_links(docs, text_column, width, percent, classes, candidate_edges(lists, percent))
    parts = components(links)
    named = classes.join(parts, classes["class"] == parts["node"], "left").select(
        "signature", "least", F.coalesce("component", "class").alias("part")
    )
    named = cut_lineage(named, "named")
    smallest = cut_lineage(named.groupBy("part").agg(F.min("least").alias("component_id")), "smallest")
    ids = cut_lineage(named.join(smallest, "part").drop("least"), "ids")
    return (
        prefixes.select("doc_id", "digest", "n", "signature")
        .join(ids, "signature", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            "digest",
            F.col("part").alias("component"),
        )
    )


def keep_one_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay when one document of each component stays: the smallest id
    (null last), then the least digest of the text. Documents without words all stay."""
    found = cut_lineage(jaccard_components(docs, **options), "components")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first")
    linked = found.where("component IS NOT NULL").groupBy("component").agg(first)
    empty = found.where("component IS NULL").select("doc_id", "digest").distinct()
    plan = linked.select("first.doc_id", "first.digest").unionByName(empty)
    return select_rows(docs, plan.withColumn("copies", F.lit(1)))
