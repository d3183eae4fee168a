"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.operators.totals import running_totals  # noqa: F401  (used by the operators)

#: Texts in a batch.
TEXT_ROWS = 1000
#: Bytes in a batch, where many small rows follow few large ones.
BATCH_BYTES = 2 << 20
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Where ``keep_batches_small`` notes the rows that were allowed before.
ROWS_BEFORE = "serieslake.llm.maxRecordsPerBatch"
#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def unused(frame: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, whatever its case."""
    taken = {name.lower() for name in frame.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def _lower(spark: SparkSession, name: str, most: int) -> str:
    before = spark.conf.get(name)
    number = int(re.sub(r"\D", "", before)) if re.fullmatch(r"\d+b?", before, re.I) else 0
    spark.conf.set(name, str(min(most, number) if number > 0 else most))
    return before


@contextmanager
def _at_most(spark: SparkSession, name: str, most: int) -> Iterator[None]:
    before = _lower(spark, name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> AbstractContextManager[None]:
    """Hands texts to tasks a few at a time while the block runs: a batch of long texts is held by
    the executor and its Python worker alike. Only frames computed inside the block are concerned."""
    return _at_most(spark, ROWS_SETTING, rows)


def keep_batches_small(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """The like until ``keep_batches_light``, for frames that are returned and computed later."""
    before = _lower(spark, ROWS_SETTING, rows)
    if spark.conf.get(ROWS_BEFORE, None) is None:
        spark.conf.set(ROWS_BEFORE, before)


def light_batches(spark: SparkSession, size: int = BATCH_BYTES) -> AbstractContextManager[None]:
    """The like by bytes, where rows of one task differ much in size: small rows stay many."""
    return _at_most(spark, BYTES_SETTING, size)


def keep_batches_light(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """The like for the rest of the session, for frames that are returned and computed later. Rows
    that ``keep_batches_small`` held back are allowed again."""
    _lower(spark, BYTES_SETTING, size)
    before = spark.conf.get(ROWS_BEFORE, None)
    if before is not None:
        spark.conf.set(ROWS_SETTING, before)
        spark.conf.unset(ROWS_BEFORE)


def digest_of(name: str = "text") -> Column:
    """SHA-256 of a text, null read as empty: tells rows apart that share a doc_id."""
    return F.unhex(F.sha2(text_of(name).cast("binary"), 256))


def select_rows(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``plan`` names, each ``copies`` times, with the columns of docs.

    ``plan`` has doc_id, digest (of the text) and copies. Rows that repeat both doc_id and text
    count once; null doc_ids match each other. Only the plan's names are new, so any columns of
    docs pass through unharmed.
    """
    names = docs.columns
    digest, rank, copies = (unused(docs, stem) for stem in ("_digest", "_rank", "_copies"))
    known, absent = (unused(docs, stem) for stem in ("_known", "_absent"))
    chosen = (
        plan.groupBy("doc_id", "digest")
        .agg(F.sum("copies").alias("copies"))
        .where(F.col("copies") > 0)
        .select(
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_plan_known"),
            F.col("doc_id").isNull().alias("_plan_absent"),
            F.col("digest").alias("_plan_digest"),
            "copies",
        )
    )
    # Plain keys, the same for the join and the window: the texts are shuffled once.
    marked = (
        docs.withColumn(digest, digest_of())
        .withColumn(known, F.coalesce(column("doc_id").cast("string"), F.lit("")))
        .withColumn(absent, column("doc_id").isNull())
    )
    joined = marked.join(
        chosen,
        (marked[known] == chosen["_plan_known"])
        & (marked[absent] == chosen["_plan_absent"])
        & (marked[digest] == chosen["_plan_digest"]),
    ).select(
        *[marked[f"`{n}`"] for n in names],
        *[marked[key] for key in (known, absent, digest)],
        chosen["copies"].alias(copies),
    )
    first = W.partitionBy(known, absent, digest).orderBy(*[column(n) for n in names if n != "text"])
    return (
        joined.withColumn(rank, F.row_number().over(first))
        .where(F.col(rank) == 1)
        .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
        .select(*[column(n) for n in names])
    )
