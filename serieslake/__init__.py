"""A Spark-native engine for financial time-series lakes."""

from serieslake.api import DataAPI, MetadataResult, QuerySet
from serieslake.session import build_session

__all__ = ["DataAPI", "MetadataResult", "QuerySet", "build_session"]
