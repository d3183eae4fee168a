"""Sharding by balanced label propagation.

Linked documents start in even shards, in an order that puts a document next to its smallest
neighbour. Then, round by round, documents count their neighbours' shards (a join of links and
labels) and ask to move where most of them are; each shard admits as many as its quota has room
for, small families first. Even rounds follow neighbours with smaller ids and odd rounds those
with larger ids, so two neighbours never swap places for ever. Documents without links then fill
every shard to its quota, so that row counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import column, digest_of, running_totals, text_of
from serieslake.session import cut_lineage

SHARDS = 40
ROUNDS = 4


def star_links(rows: DataFrame) -> DataFrame:
    """Links (a, b) from the first row of every group of equal texts to its other rows."""
    groups = cut_lineage(
        rows.groupBy("digest")
        .agg(F.min("row").alias("hub"), F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .drop("members"),
        "groups",
    )
    return cut_lineage(
        rows.select("row", "digest")
        .join(groups, "digest")
        .where("row != hub")
        .select(F.col("hub").alias("a"), F.col("row").alias("b")),
        "links",
    )


def quotas(count: int, shards: int) -> list[int]:
    return [count // shards + (shard < count % shards) for shard in range(shards)]


def propagate(links: DataFrame, room: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Shards of linked nodes: node, shard. ``links`` has a and b; ``room`` bounds each shard.

    Moves never fill a shard beyond its room. Stops early when no node asks or none is admitted.
    """
    shards = len(room)
    both = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        links.select(F.col("b").alias("src"), F.col("a").alias("dst"))
    )
    both = cut_lineage(both.where("src != dst").distinct(), "edges")
    nodes = cut_lineage(
        both.groupBy("dst")
        .agg(F.min("src").alias("least"), F.count(F.lit(1)).alias("degree"))
        .select(
            F.col("dst").alias("node"),
            F.least("least", "dst").alias("seed"),
            "degree",
            F.lit(0).alias("_all"),
            F.lit(1).alias("_one"),
        ),
        "nodes",
    )
    count = nodes.count()
    if count == 0:
        return nodes.select("node", F.lit(0).alias("shard")).where("false")
    first = running_totals(nodes, "_all", [F.col("seed"), F.col("node")], "_one", "at")
    size = -(-count // shards)
    # Even blocks; the shards with room for one more come first, so blocks fit their rooms.
    full = count - (size - 1) * shards
    edge = full * size
    block = F.when(F.col("at") < edge, F.col("at") / size).otherwise(
        full + (F.col("at") - edge) / max(size - 1, 1)
    )
    labels = cut_lineage(
        first.select("node", "degree", F.floor(block).cast("int").alias("shard")), "labels"
    )
    for number in range(rounds):
        direction = "src < dst" if number % 2 == 0 else "src > dst"
        votes = (
            both.where(direction)
            .join(labels.withColumnRenamed("node", "src"), "src")
            .groupBy("dst", "shard")
            .agg(F.count(F.lit(1)).alias("votes"), F.max(F.struct("degree", "src")).alias("lead"))
        )
        best = votes.groupBy("dst").agg(
            F.max(F.struct("votes", -F.col("shard"), "lead")).alias("best"),
            F.collect_list(F.struct("shard", "votes")).alias("all"),
        )
        wishes = (
            best.withColumnRenamed("dst", "node")
            .join(labels, "node")
            .select(
                "node",
                F.col("shard").alias("from"),
                (-F.col("best")["col2"]).cast("int").alias("to"),
                F.col("best")["lead"]["degree"].alias("family"),
                F.col("best")["lead"]["src"].alias("lead"),
                F.col("best")["votes"].alias("there"),
                F.expr("coalesce(get(filter(all, v -> v.shard = shard), 0).votes, 0)").alias("here"),
                F.lit(1).alias("_one"),
            )
            .where("to != from AND there > here")
        )
        wishes = cut_lineage(wishes, "wishes")
        load = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}
        free = [room[shard] - load.get(shard, 0) for shard in range(shards)]
        order = [F.col(name) for name in ("family", "lead", "node")]
        ranked = running_totals(wishes, "to", order, "_one", "ahead")
        seats = F.array(*[F.lit(seat) for seat in free])
        moves = cut_lineage(
            ranked.where(F.col("ahead") < F.element_at(seats, F.col("to") + 1)).select("node", "to"),
            "moves",
        )
        if moves.isEmpty():
            if number % 2:
                break
            continue
        labels = cut_lineage(
            labels.join(moves, "node", "left").select(
                "node", "degree", F.coalesce("to", "shard").alias("shard")
            ),
            "labels",
        )
    return labels.select("node", "shard")


def balanced_shards(
    rows: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """Adds shard and slot to ``rows`` (column row: unique numbers). Law: row counts differ by
    at most one. ``slot`` numbers the rows of a shard from 0 without gaps. Empty in, empty out.
    """
    count = rows.count()
    room = quotas(count, shards)
    labels = cut_lineage(propagate(links, room, rounds), "labels")
    load = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}
    left = [room[shard] - load.get(shard, 0) for shard in range(shards)]
    bounds = [sum(left[: shard + 1]) for shard in range(shards)]
    loose = rows.join(labels, rows["row"] == labels["node"], "left_anti").select("row")
    numbered = running_totals(
        loose.select("row", F.lit(0).alias("_all"), F.lit(1).alias("_one")),
        "_all",
        [F.xxhash64("row"), F.col("row")],
        "_one",
        "at",
    )
    # The first shard whose rows, with all shards before it, go beyond this position.
    ends = F.array(*[F.lit(bound).cast("long") for bound in bounds])
    shard = F.size(F.filter(ends, lambda end: end <= F.col("at")))
    placed = labels.select(F.col("node").alias("row"), "shard").unionByName(
        numbered.select("row", shard.alias("shard"))
    )
    slots = running_totals(
        placed.withColumn("_one", F.lit(1)), "shard", [F.col("row")], "_one", "slot"
    )
    return rows.join(slots.select("row", "shard", "slot"), "row")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Documents into shards, equal texts linked: doc_id, size, text_crc32, shard, slot, cut.

    A null text is empty: size 16. Null and repeated doc_ids are rows of their own. A family of
    equal texts stays in one shard unless its rows do not fit.
    """
    rows = cut_lineage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            column("doc_id").alias("doc_id"),
            (F.octet_length(text_of()) + 16).cast("long").alias("size"),
            F.crc32(text_of().cast("binary")).alias("text_crc32"),
            digest_of().alias("digest"),
        ),
        "rows",
    )
    return balanced_shards(rows, star_links(rows), shards, rounds).select(
        "doc_id", "size", "text_crc32", "digest", "shard", "slot"
    )
