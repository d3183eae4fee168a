"""Exact dedup by block naming.

A text is cut into blocks of a fixed number of bytes. The distinct blocks of the corpus are
sorted and numbered; the number is the block's name. Neighbouring names are then paired, the
distinct pairs sorted and numbered in turn, until each document has one name. Two documents of
the same level have the same name exactly when their texts are equal: names come from comparing
blocks and pairs themselves, never from a hash alone.

A 96-bit fingerprint of each block only routes the look-up of its name. If two different blocks
share one (checked in every run), the blocks themselves become the key of the look-up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import column, digest_of, text_of
from serieslake.session import cut_lineage

BLOCK_BYTES = 4096


def _fingerprint(block: Column) -> list[Column]:
    return [F.xxhash64(block).alias("f1"), F.crc32(block).alias("f2")]


def _named(distinct: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Sorts distinct keys within their partitions and numbers them; written, so names stay."""
    return cut_lineage(
        distinct.sortWithinPartitions(*keys).select(
            *keep, F.monotonically_increasing_id().alias("name")
        ),
        "names",
    )


def name_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    fingerprint=_fingerprint,
) -> DataFrame:
    """One row per row of docs: row (a number of its own), doc_id, digest, level, name.

    (level, name) is the document's identity: equal exactly for equal texts. A null text is the
    empty text, one empty block; a very long one has as many blocks as it needs. Null ids and rows
    that repeat id and text keep rows of their own.
    """
    # Bytes, as a substring of a long string costs its whole length each time.
    base = docs.select(
        column(id_column).alias("doc_id"),
        digest_of(text_column).alias("digest"),
        text_of(text_column).cast("binary").alias("body"),
    )
    count = F.greatest(F.ceil(F.length("body") / F.lit(block_bytes)).cast("int"), F.lit(1))
    cut = F.expr(
        f"transform(sequence(0, n - 1), i -> substring(body, i * {block_bytes} + 1, {block_bytes}))"
    )
    numbered = base.withColumn("n", count)
    blocks = numbered.select(F.explode(cut).alias("block"))
    distinct = blocks.select(*fingerprint(F.col("block")), "block").distinct()
    names = _named(distinct, ["f1", "f2", "block"], ["f1", "f2"])
    keys = ["f1", "f2"]
    if not names.groupBy(*keys).count().where("count > 1").isEmpty():
        keys = ["f1", "f2", "block"]
        names = _named(distinct, keys, keys)
    places = cut_lineage(
        numbered.withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "digest", "n", F.posexplode(cut).alias("at", "block"))
        .select("row", "doc_id", "digest", "n", "at", *fingerprint(F.col("block")), "block")
        .select("row", "doc_id", "digest", "n", "at", *keys),
        "places",
    )
    current = cut_lineage(places.join(names, keys).select("row", "n", "at", "name"), "level")
    roots = current.where("n = 1").select("row", F.lit(0).alias("level"), "name")
    longest = places.agg(F.max("n")).first()[0] or 1
    for level in range(1, math.ceil(math.log2(longest)) + 1 if longest > 1 else 1):
        half = F.col("at") % 2
        pairs = (
            current.where("n > 1")
            .groupBy("row", "n", F.expr("at div 2").cast("int").alias("at"))
            .agg(
                F.max(F.when(half == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        pairs = cut_lineage(pairs, "pairs")
        named = _named(pairs.select("left", "right").distinct(), ["left", "right"], ["left", "right"])
        current = cut_lineage(
            pairs.join(named, ["left", "right"]).select(
                "row", F.ceil(F.col("n") / 2).cast("int").alias("n"), "at", "name"
            ),
            "level",
        )
        roots = roots.unionByName(
            current.where("n = 1").select("row", F.lit(level).alias("level"), "name")
        )
    return (
        places.where("at = 0")
        .select("row", "doc_id", "digest")
        .join(roots, "row")
    )


def exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs: doc_id, digest, keep_id, group_size, kept.

    Of equal texts the row with the largest id stays, of rows that share it one; a null id stays only
    where all are null. An empty table gives no rows.
    """
    named = cut_lineage(name_documents(docs, **options), "identities")
    stays = F.max(F.struct("doc_id", (-F.col("row")).alias("turned")))
    groups = cut_lineage(
        named.groupBy("level", "name")
        .agg(stays.alias("stays"), F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .select("level", "name", "members", F.col("stays.doc_id").alias("largest"), F.col("stays.turned").alias("turned")),
        "groups",
    )
    return named.join(groups, ["level", "name"], "left").select(
        "doc_id",
        "digest",
        F.coalesce("largest", "doc_id").alias("keep_id"),
        F.coalesce("members", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == -F.col("turned"), F.lit(True)).alias("kept"),
    )
