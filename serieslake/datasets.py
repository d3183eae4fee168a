"""Named catalog predicates."""

from __future__ import annotations

from typing import ClassVar

from pyspark.sql import DataFrame

from serieslake.api import DataAPI, QuerySet
from serieslake.operators import reshape
from serieslake.schema import SERIES_CODE


class Dataset:
    """A saved catalog filter with value reads. Override ``build_queryset`` for more."""

    FILTERS: ClassVar[dict[str, object]] = {}

    def __init__(
        self, api: DataAPI, *, out_of_cache: bool = False, ticker_source: str | None = None
    ) -> None:
        self.api = api
        self._out_of_cache = out_of_cache
        self._ticker_source = ticker_source
        self.query = self.build_queryset()

    def build_queryset(self) -> QuerySet:
        return self.api.query().filter(**self.FILTERS)

    @property
    def info(self) -> DataFrame:
        return self.query.metadata()

    def _query(self, out_of_cache: bool | None, ticker_source: str | None) -> QuerySet:
        live = self._out_of_cache if out_of_cache is None else out_of_cache
        source = ticker_source or self._ticker_source
        if live:
            return self.query.live(source)
        cached = self.query.cached()
        return cached.source(ticker_source) if ticker_source else cached

    def get_values(
        self, *, out_of_cache: bool | None = None, ticker_source: str | None = None
    ) -> DataFrame:
        """Wide values; live reads need a vendor, cached reads may be limited to one."""
        return self._query(out_of_cache, ticker_source).value()

    def last_values(self, *, out_of_cache: bool | None = None) -> DataFrame:
        live = self._out_of_cache if out_of_cache is None else out_of_cache
        if live:
            raise ValueError("the last value is always read from the lake")
        return self.query.last_value()


class FXSpot(Dataset):
    FILTERS = {"asset_class": "Currency", "sub_asset_class": "Forex Spot"}


class FXMajor(FXSpot):
    FILTERS = {**FXSpot.FILTERS, "market_development": ["G10", "EM"]}

    def matrix(
        self, *, out_of_cache: bool | None = None, ticker_source: str | None = None
    ) -> DataFrame:
        """Wide values with one column per currency."""
        query = self._query(out_of_cache, ticker_source)
        long = query.long()
        catalog = query.metadata().join(
            long.select(SERIES_CODE).distinct(), SERIES_CODE, "left_semi"
        )
        return reshape.matrix_by_label(long, catalog)


class FXUSDBloc(FXSpot):
    FILTERS = {**FXSpot.FILTERS, "market_segment": ["Dollar Bloc"]}


class _PairUniverse(Dataset):
    FILTERS = {"asset_class": "Currency", "sub_asset_class": "FX Spot"}


class FXDevelopedMarkets(_PairUniverse):
    FILTERS = {**_PairUniverse.FILTERS, "market_development": ["G10"]}


class FXEmergingMarkets(_PairUniverse):
    FILTERS = {**_PairUniverse.FILTERS, "market_development": ["EM"]}


class FXChina(_PairUniverse):
    FILTERS = {**_PairUniverse.FILTERS, "market_development": ["CHN"]}


DATASETS: dict[str, type[Dataset]] = {
    cls.__name__: cls
    for cls in (FXSpot, FXMajor, FXUSDBloc, FXDevelopedMarkets, FXEmergingMarkets, FXChina)
}
