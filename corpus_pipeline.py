"""A corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read back as
the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serieslake.llm import exact_dedup, jaccard, mixing, pieces, quality
from serieslake.llm.common import keep_batches_light, keep_batches_small, select_rows, table
from serieslake.llm.queries import vocabulary
from serieslake.session import cut_lineage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects (a score below one half)."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    keep_batches_small(spark)  # the rows are computed when the caller writes them
    return docs.where(quality.score_column(docs, model) >= 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keeps the document with the largest id."""
    found = exact_dedup.exact_duplicates(docs)
    plan = found.where("kept").select("doc_id", "digest", F.lit(1).alias("copies"))
    return select_rows(docs, plan)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents keeps the one with the smallest id; of rows that share it, the one
    with the least digest."""
    return jaccard.keep_one_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    weights = mixing.label_weights(table(spark, sf_dir, "labels"))
    plan = mixing.mix_sources(docs, weights).select("doc_id", "digest", "copies")
    return select_rows(docs, plan)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row."""
    encoded = pieces.encode_documents(docs, vocabulary("piece_bpe_32k.model"))
    keep_batches_light(spark)  # the rows are computed when the caller writes them
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("encoding", encode),
]

#: Three stages (the classifier, the Jaccard components and the lattice) are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
