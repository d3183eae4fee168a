"""Merkle manifest of a dataset, with an inclusion proof for every row.

Each row is a leaf, the digest of its columns. Leaves of one group in order of their ids form a tree
with a fixed fanout; the groups' roots form the tree of the dataset.

Upper proofs come from a butterfly exchange. A tree's leaves are dealt to aligned blocks of
``fanout ** INNER`` neighbours, and every block hashes its own subtree. Then, round by round,
fanout-sized sets of blocks swap the roots of the subtrees they have so far: in round r a block
meets the blocks that hold its place in the neighbouring subtrees of ``fanout ** r`` blocks. All of
them hash the same ancestor, so after the last round every block holds the root and the siblings of
its whole path; nothing travels downward. A last subtree that is not full sends its root to the
places its missing blocks would have met. A round moves at most ``fanout`` digests per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import column
from serieslake.operators.totals import running_totals
from serieslake.session import cut_lineage

FANOUT = 8
#: Levels that a block of leaves hashes by itself.
INNER = 3


def digest(parts: Column) -> Column:
    """The lowercase hex SHA-256 of an array of strings, joined."""
    return F.sha2(F.array_join(parts, ""), 256)


def field(value: Column) -> Column:
    """A column as its byte count, a colon and its value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def _run(nodes: Column, at: Column, fanout: int) -> Column:
    """The run of siblings that holds the node ``at`` (from 0), itself included."""
    return F.slice(nodes, (at - at % fanout + 1).cast("int"), F.lit(fanout))


def _parents(nodes: Column, fanout: int) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda k: digest(F.slice(nodes, k * fanout + 1, F.lit(fanout))))


def _sides(run: Column, at: Column, fanout: int) -> Column:
    """What stands left and right of a node in its run."""
    place = (at % fanout).cast("int")
    return F.struct(
        F.array_join(F.slice(run, F.lit(1), place), "").alias("left"),
        F.array_join(F.slice(run, place + 2, F.lit(fanout)), "").alias("right"),
    )


def _fold(steps: Column, node: Column) -> Column:
    return F.aggregate(
        steps, node, lambda held, step: F.sha2(F.concat(step["left"], held, step["right"]), 256)
    )


def butterfly(units: DataFrame, fanout: int) -> DataFrame:
    """``units`` has tree, units (how many the tree has), at (place from 0) and node. Returns tree,
    at, root (of the tree) and steps (the siblings left and right, upwards)."""
    state = units.withColumn("steps", F.expr("CAST(array() AS array<struct<left:string,right:string>>)"))
    widest = units.agg(F.max("units")).first()[0] or 1
    done, width = [], 1
    while width < widest:
        done.append(state.where(F.col("units") <= width))
        own = F.expr(f"at div {width}")
        place = F.expr(f"CAST(at % {width} AS INT)")
        members = F.least(F.lit(width), F.col("units") - F.col("sub") * width).cast("int")
        # A last subtree that is not full also serves the places of the blocks it lacks.
        lanes = F.when(
            F.col("sub") % fanout > 0, F.sequence(place, F.lit(width - 1), F.col("members"))
        ).otherwise(F.array(place))
        sent = (
            state.where(F.col("units") > width)
            .withColumn("sub", own)
            .withColumn("members", members)
            .withColumn("lane", F.explode(lanes))
        )
        # At most ``fanout`` messages meet: one from each subtree below the same ancestor.
        mine = F.when(F.col("lane") == place, F.struct("at", "units", "sub", "steps"))
        met = sent.groupBy("tree", F.expr(f"at div {width * fanout}").alias("above"), "lane").agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("sub", "node"))), lambda x: x["node"]
            ).alias("run"),
            F.collect_list(mine).alias("blocks"),
        )
        state = cut_lineage(
            met.select("tree", "run", digest(F.col("run")).alias("node"), F.explode("blocks").alias("b"))
            .select(
                "tree",
                "b.units",
                "b.at",
                "node",
                F.concat("b.steps", F.array(_sides(F.col("run"), F.col("b.sub"), fanout))).alias("steps"),
            ),
            "exchange",
        )
        width *= fanout
    for finished in done:
        state = state.unionByName(finished)
    return state.select("tree", "at", F.col("node").alias("root"), "steps")


def ranked(frame: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Adds ``at``, the place in the group from 0."""
    return running_totals(frame.withColumn("_one", F.lit(1)), group, order, "_one", "at").drop("_one")


def prove_leaves(leaves: DataFrame, fanout: int = FANOUT, inner: int = INNER) -> DataFrame:
    """``leaves`` has tree (the group's key, not null), id, node and probe (a digest that may
    differ). Returns tree, id, node, subroot, root, proof (digest of all siblings, upwards) and folded
    (the root recomputed from the probe and the siblings).

    Leaves are in ascending order of id, null first, ties by node, then by probe; trees in ascending
    order of their keys.
    """
    size = fanout**inner
    places = ranked(leaves, "tree", [F.asc_nulls_first("id"), F.asc("node"), F.asc("probe")])
    # At most fanout ** inner rows meet, whatever the size of their tree.
    packed = cut_lineage(
        places.groupBy("tree", F.expr(f"at div {size}").alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("at", "node", "id", "probe"))).alias("rows")
        ),
        "packed",
    )
    sizes = packed.groupBy("tree").agg(F.sum(F.size("rows")).alias("members"))
    blocks = packed.join(sizes, "tree")
    levels = {"level0": F.transform("rows", lambda row: row["node"])}
    for k in range(inner):
        below = F.col(f"level{k}")
        levels[f"level{k + 1}"] = F.when(F.col("members") > fanout**k, _parents(below, fanout)).otherwise(below)
    hashed = blocks
    for name, value in levels.items():
        hashed = hashed.withColumn(name, value)
    units = cut_lineage(
        hashed.select(
            "tree",
            F.expr(f"(members - 1) div {size} + 1").alias("units"),
            F.col("block").alias("at"),
            F.col(f"level{inner}")[0].alias("node"),
        ),
        "subtrees",
    )
    paths = butterfly(units, fanout).withColumnRenamed("root", "subroot")
    paths = cut_lineage(paths.select("tree", F.col("at").alias("block"), "subroot", "steps"), "paths")
    roots = paths.where("block = 0").select(F.lit(0).alias("all"), "tree", "subroot")
    tops = cut_lineage(ranked(roots, "all", [F.asc("tree")]), "tops")
    units = F.lit(tops.count()).cast("long").alias("units")
    top = butterfly(
        tops.select(F.col("all").alias("tree"), units, "at", F.col("subroot").alias("node")), fanout
    ).select("at", "root", F.col("steps").alias("top_steps"))
    upper = cut_lineage(tops.join(top, "at").select("tree", "root", "top_steps"), "upper")
    joined = (
        hashed.join(paths, ["tree", "block"])
        .join(upper, "tree")
        .withColumn("above", F.concat("steps", "top_steps"))
    )
    above = F.array_join(F.transform("above", lambda s: F.concat(s["left"], s["right"])), "")
    joined = joined.withColumn("above_text", above)

    def proved(row: Column, place: Column) -> Column:
        steps = []
        for k in range(inner):
            at = F.floor(place / fanout**k).cast("int")
            step = _sides(_run(F.col(f"level{k}"), at, fanout), at, fanout)
            steps.append(F.when(F.col("members") > fanout**k, step))
        own = F.filter(F.array(*steps), lambda s: s.isNotNull())
        text = F.array_join(F.transform(own, lambda s: F.concat(s["left"], s["right"])), "")
        return F.struct(
            row["id"].alias("id"),
            row["node"].alias("node"),
            F.sha2(F.concat(text, F.col("above_text")), 256).alias("proof"),
            _fold(F.concat(own, F.col("above")), row["probe"]).alias("folded"),
        )

    return joined.select(
        "tree", "subroot", "root", F.explode(F.transform("rows", proved)).alias("row")
    ).select("tree", "row.*", "subroot", "root")


LOWER = "abcdefghijklmnopqrstuvwxyz"


def tampered(doc_id: Column) -> Column:
    """Rows whose text is changed before it is checked: CRC-32 of the id is divisible by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def document_manifest(docs: DataFrame, fanout: int = FANOUT, inner: int = INNER) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot (of its lang), root (of the table),
    proof_sha256, folded_root and verified.

    A leaf covers doc_id, source, lang, n_chars and text, nulls told apart from empty values; other
    columns do not count. The tree is of original rows; ``folded_root`` starts from the row as
    ``tampered`` leaves it, with A-Z of its text lowered, and ``verified`` says whether it still
    leads to the root. Null langs form a tree of their own, before all others. Rows that repeat an
    id stand in the order of their leaves, null ids first. Very long texts are only hashed. An empty
    table has no rows and no root.
    """
    own = [column(name) for name in ("doc_id", "source", "lang", "n_chars")]
    text = column("text")
    lowered = F.translate(text, LOWER.upper(), LOWER)
    leaves = cut_lineage(
        docs.select(
            F.coalesce(F.concat(F.lit("1"), column("lang")), F.lit("0")).alias("tree"),
            column("doc_id").alias("id"),
            leaf(*own, text).alias("node"),
            F.when(tampered(column("doc_id")), leaf(*own, lowered)).alias("probe"),
        ).withColumn("probe", F.coalesce("probe", "node")),
        "leaves",
    )
    proved = prove_leaves(leaves, fanout, inner)
    return proved.select(
        F.col("id").alias("doc_id"),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
