"""Saving query results as plain Parquet and loading them back, with a staleness test."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parquet options for column encryption; the key client is the cluster's to configure.
ENCRYPTION_PREFIX = "parquet.encryption."
CRYPTO_FACTORY = "parquet.crypto.factory.class"


def encryption_options(
    factory: str, footer_key: str, column_keys: Mapping[str, list[str]]
) -> dict[str, str]:
    """Writer options that encrypt columns: key name to the columns it protects."""
    listed = ";".join(f"{key}:{','.join(columns)}" for key, columns in column_keys.items())
    return {
        CRYPTO_FACTORY: factory,
        f"{ENCRYPTION_PREFIX}footer.key": footer_key,
        f"{ENCRYPTION_PREFIX}column.keys": listed,
    }


class QueryCache:
    """Query results on storage shared by the cluster."""

    def __init__(self, spark: SparkSession, options: Mapping[str, str] | None = None) -> None:
        self.spark = spark
        self.options = dict(options or {})

    def frame(self, query: str | DataFrame, **frames: DataFrame) -> DataFrame:
        """A query's result; ``{name}`` in the text stands for a frame passed by keyword."""
        return self.spark.sql(query, **frames) if isinstance(query, str) else query

    def save(self, query: str | DataFrame, path: str, *, mode: str = "overwrite", **frames):
        """Write a query's result as Parquet."""
        self.frame(query, **frames).write.mode(mode).options(**self.options).parquet(path)

    def load(self, path: str, query: str | None = None) -> DataFrame | None:
        """Saved rows, or a query over them (``{saved}``); None when there is nothing."""
        try:
            saved = self.spark.read.options(**self.options).parquet(path)
        except AnalysisException:
            return None
        result = saved if query is None else self.spark.sql(query, saved=saved)
        return None if result.isEmpty() else result

    def age_seconds(self, path: str) -> float | None:
        """Seconds since the newest file of a saved result was written."""
        try:
            saved = self.spark.read.options(**self.options).parquet(path)
        except AnalysisException:
            return None
        newest = F.max("_metadata.file_modification_time").cast("double")
        now = F.current_timestamp().cast("double")
        return saved.agg(newest.alias("t")).select((now - F.col("t")).alias("age")).first()["age"]

    def is_stale(self, path: str, max_age_seconds: float) -> bool:
        age = self.age_seconds(path)
        return age is None or age > max_age_seconds
