"""Choosing how a small table meets a large one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows of a table that is sent to every executor.
BROADCAST_ROWS = 500_000


def small_side(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A catalog-like table, marked for broadcast when counting it shows that it is small.

    Without the mark Spark overestimates such tables (they are products of filters, joins and
    explodes) and shuffles the large side by a skewed key before it learns better. Beyond the
    limit the table is left alone: a shuffled join follows, whose hot partitions adaptive
    execution splits.
    """
    return F.broadcast(frame) if frame.count() <= limit else frame
