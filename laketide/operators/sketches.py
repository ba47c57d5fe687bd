"""Distinct counts that can be merged: sketches stored per rollup group.

``count(DISTINCT patient)`` of a month cannot be had from the counts of its
days.  A sketch can: each day's group keeps a HyperLogLog sketch of its
values, a month is the union of its days' sketches, and the facts are not
read again.  All steps are algebraic aggregates, so a hot group is combined
map-side and never gathered.

A sketch takes at most about 2^lg_k bytes.  Small sets (some hundred values
at ``lg_k`` 12) are counted exactly; beyond, :func:`relative_error` gives the
standard error of a union.  NULLs do not count, a group of NULLs alone
counts 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.functions.dates import run_date

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of the estimate from a union of sketches."""
    return 1.04 / math.sqrt(2 ** lg_k)


def _hashable(df: DataFrame, column: str) -> Column:
    """The column in a type that sketches take."""
    kind = dict(df.dtypes)[column]
    return F.col(column) if kind in ("int", "bigint", "string", "binary") else F.col(column).cast("string")


@dataclass(frozen=True)
class DistinctRollup:
    """Distinct counts of columns per date and group.

    ``distinct`` maps the name of a count to the column that is counted,
    ``grain`` names the group's columns next to ``date_col``.
    """

    grain: tuple[str, ...]
    distinct: dict[str, str]
    date_col: str = "date"
    lg_k: int = LG_K

    def daily(self, fact: DataFrame, d=None) -> DataFrame:
        """One row per date and group with a sketch for each count, to be
        stored by date; ``d`` restricts the fact to one date partition."""
        if d is not None:
            fact = fact.where(F.col(self.date_col) == F.lit(run_date(d)))
        return (fact.groupBy(self.date_col, *self.grain)
                .agg(*[F.hll_sketch_agg(_hashable(fact, c), F.lit(self.lg_k)).alias(name)
                       for name, c in self.distinct.items()]))

    def merged(self, sketches: DataFrame, period: str | None = None,
               grain: Sequence[str] | None = None) -> DataFrame:
        """Sketches of longer periods (``week``, ``month``, ``quarter``,
        ``year``, each under its first date; None: of all dates, without a
        date) and of fewer group columns; of the same form, so that they can
        be merged again."""
        keys = [F.col(c) for c in (self.grain if grain is None else grain)]
        if period is not None:
            keys.insert(0, F.trunc(self.date_col, period).alias(self.date_col))
        return sketches.groupBy(*keys).agg(*[F.hll_union_agg(name).alias(name) for name in self.distinct])

    def estimates(self, sketches: DataFrame) -> DataFrame:
        """The sketches replaced by the counts that they stand for."""
        return sketches.select(*[F.hll_sketch_estimate(c).alias(c) if c in self.distinct else F.col(c)
                                 for c in sketches.columns])
