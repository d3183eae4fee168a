"""Every operator as a runnable query over the shared test tables, with its SQL equivalent."""

from serieslake.registry import calendar, charts, core, fairvalue, scans, storage, writes  # noqa: F401
from serieslake.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
