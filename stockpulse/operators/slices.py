"""Slices of a step's rows, so that a step's exchanges hold one slice at a time.

All rows that meet in a step share its key, so the slices of a key are worked one after
the other and their results are one table: every row is in exactly one slice.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclasses.dataclass(frozen=True)
class Slice:
    """Slice ``no`` of ``of``."""

    no: int = 0
    of: int = 1

    def rows(self, df: DataFrame, key: Column) -> DataFrame:
        """The rows whose key is the slice's.  NULL is a key like any other."""
        return df if self.of == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(self.of)) == self.no)


WHOLE = Slice()
