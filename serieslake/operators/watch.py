"""Counts that a write takes along: nothing is read twice for them."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from serieslake.functions.numeric import clean_double
from serieslake.schema import VALUE

#: Examples shown of texts that were no numbers.
EXAMPLES = 5


class LostValues:
    """Counts the values of a frame that are no numbers while it is being written.

    The count and a few examples (the least text of each hash bucket, so bounded) are aggregates of the
    write's own job, by ``DataFrame.observe``.
    """

    def __init__(self) -> None:
        self._seen = Observation()

    def watch(self, frame: DataFrame, column: str = VALUE) -> DataFrame:
        text = F.col(column).cast("string")
        lost = F.col(column).isNotNull() & clean_double(F.col(column)).isNull()
        bucket = F.pmod(F.xxhash64(text), F.lit(EXAMPLES))
        examples = [
            F.min(F.when(lost & (bucket == k), text)).alias(f"example{k}") for k in range(EXAMPLES)
        ]
        return frame.observe(self._seen, F.count_if(lost).alias("lost"), *examples)

    def report(self) -> tuple[int, list[str]]:
        """(how many, examples), after the write."""
        found = self._seen.get
        shown = [found[f"example{k}"] for k in range(EXAMPLES)]
        return found["lost"], sorted(text for text in shown if text is not None)

    def warn(self) -> tuple[int, list[str]]:
        """The report, with a warning where something was lost."""
        count, examples = self.report()
        if count:
            warnings.warn(
                f"{count} value(s) are no numbers and were stored as missing, such as {examples}",
                stacklevel=3,
            )
        return count, examples
