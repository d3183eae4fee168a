"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a budget of words. Whole epochs of the source come first; what is left of the
budget is filled by a weighted sample without replacement: every document draws an exponential
key -ln(u) / quality weight, documents are sorted by key within their source, and their sizes are
summed until the budget is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import WORD, column, digest_of, running_totals, text_of
from serieslake.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2.0


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_epochs: float = MOST_EPOCHS,
) -> DataFrame:
    """One row per source: source_key, source_size, target. ``sizes`` has source_key and size.

    Sources take the weights in turn, in order of source_key. All share ``share`` times the total;
    a source stops at ``most_epochs`` times its size and its excess goes to the others by weight.
    With L the words per unit of weight, a source's target is min(cap, weight * L): L is found by
    raising it from one aggregate to the next until no further source meets its cap.
    """
    sources = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    sources = cut_lineage(sources.withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1)), "sources")
    ranked = running_totals(sources, "_all", [F.col("source_key")], "_one", "_rank")
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    weighted = cut_lineage(
        ranked.select(
            "source_key",
            "source_size",
            F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * most_epochs).alias("cap"),
        ),
        "weighted",
    )
    whole = weighted.agg(F.sum("source_size"), F.sum("weight"), F.count(F.lit(1))).first()
    budget = float(whole[0] or 0) * share
    taken, used, capped, level = 0.0, 0.0, -1, 0.0
    while whole[2]:
        if used >= whole[1]:
            level = None  # every source is at its cap
            break
        level = (budget - taken) / (whole[1] - used)
        full = weighted.where(F.col("weight") * level >= F.col("cap")).agg(
            F.coalesce(F.sum("cap"), F.lit(0.0)),
            F.coalesce(F.sum("weight"), F.lit(0.0)),
            F.count(F.lit(1)),
        ).first()
        if full[2] == capped:
            break
        taken, used, capped = full
    target = F.col("cap") if level is None else F.least(F.col("cap"), F.col("weight") * level)
    return weighted.select("source_key", "source_size", target.alias("target"))


def draw(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) from an MD5 digest: the same in every run and on every cluster."""
    joined = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)


def mix_sources(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_epochs: float = MOST_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of docs: doc_id, source, digest, size, source_size, target, copies.

    ``quality`` has doc_id and weight (above 0); documents without one weigh 2. A document is
    taken ``copies`` times as a whole, so a source misses its target by at most half of the one
    document on the border. Null sources are one source, after all others; null texts have no
    words and are never taken. Ties in the key fall to the smaller doc_id and size. Repeated rows
    share a key and are told apart by nothing: each is a row of its own.
    """
    slim = docs.select(
        column("doc_id").alias("doc_id"),
        column("source").cast("string").alias("source"),
        digest_of().alias("digest"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
    )
    if quality is None:
        slim = slim.withColumn("weight", F.lit(2.0))
    else:
        known = quality.where("doc_id IS NOT NULL AND weight > 0").groupBy("doc_id").agg(
            F.max("weight").alias("weight")
        )
        slim = slim.join(known, "doc_id", "left").withColumn(
            "weight", F.coalesce("weight", F.lit(2.0))
        )
    slim = cut_lineage(
        slim.select(
            "*",
            # Orders null after every name.
            F.concat(
                F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.lit("0")),
                F.coalesce("source", F.lit("")),
            ).alias("source_key"),
            (-F.log(draw(seed, F.col("doc_id"))) / F.col("weight")).alias("key"),
        ),
        "sizes",
    )
    targets = cut_lineage(source_targets(slim, weights, share, most_epochs), "targets")
    order = [F.col("key"), F.col("doc_id"), F.col("size")]
    summed = running_totals(slim, "source_key", order, "size", "before")
    joined = summed.join(targets, "source_key")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    epochs = F.coalesce(epochs, F.lit(0)).cast("long")
    rest = F.col("target") - epochs * F.col("source_size")
    extra = (F.col("size") > 0) & (2 * F.col("before") + F.col("size") <= 2 * rest)
    return joined.select(
        "doc_id",
        "source",
        "digest",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, epochs + extra.cast("long")).otherwise(0).alias("copies"),
    )


def label_weights(labels: DataFrame) -> DataFrame:
    """Quality weights from labels: 4 for good documents, 1 for bad ones."""
    return labels.where("quality IS NOT NULL").select(
        "doc_id", F.when(F.col("quality") == 1, 4.0).otherwise(1.0).alias("weight")
    )
