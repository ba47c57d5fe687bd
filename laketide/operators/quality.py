"""Declarative data-quality rules (DQ1-DQ6).

Rules are data (:class:`Rule`).  Each rule compiles to one boolean Column
"this row fails", so a whole rule set is counted in a single aggregation,
or attached with ``DataFrame.observe`` to the very plan that is written:
no second pass, nothing collected but the counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from laketide.functions.dates import DATETIME_FORMAT

# Named value patterns of the original rules.
PATTERNS = {
    "guid": r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "alphabet": r"^[A-Za-z\s\-']+$",
    "date": r"^(0[1-9]|[12][0-9]|3[01])-(0[1-9]|1[0-2])-\d{4}$",
    "datetime": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "alphanumeric": r"^[A-Za-z0-9\s\-']+$",
}
# The original bound the day-first date rule to an ISO partition column;
# the ISO rule is a separate name here.
PATTERNS["date_dmy"] = PATTERNS["date"]
PATTERNS["date_iso"] = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"

POLICIES = ("report", "fail", "quarantine")


@dataclass(frozen=True)
class Rule:
    """One check on one column.

    kind: ``not_null`` | ``pattern`` (``arg`` = a name of PATTERNS or a
    regex) | ``type`` (``arg`` = 'double', 'timestamp', 'date', ...: text
    present but not convertible) | ``in_set`` (``arg`` = allowed values).
    NULL values pass every rule but ``not_null``.
    """

    column: str
    kind: str
    arg: object = None
    name: str | None = None

    @property
    def rule_name(self) -> str:
        if self.name:
            return self.name
        suffix = f"_{self.arg}" if isinstance(self.arg, str) else ""
        return f"{self.column}:{self.kind}{suffix}"

    def fails(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "pattern":
            pat = PATTERNS.get(self.arg, self.arg)
            return c.isNotNull() & ~c.cast("string").rlike(pat)
        if self.kind == "type":
            if self.arg == "timestamp":
                conv = F.try_to_timestamp(c.cast("string"), F.lit(DATETIME_FORMAT))
            else:
                conv = c.cast("string").try_cast(self.arg)
            return c.isNotNull() & conv.isNull()
        if self.kind == "in_set":
            return c.isNotNull() & ~c.isin(list(self.arg))
        raise ValueError(f"unknown rule kind {self.kind!r}")


def not_null(*cols: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in cols]


def pattern(col: str, name: str) -> Rule:
    return Rule(col, "pattern", name)


def typed(col: str, type_name: str) -> Rule:
    return Rule(col, "type", type_name)


def _fail_int(rule: Rule) -> Column:
    return F.when(rule.fails(), F.lit(1)).otherwise(F.lit(0))


def quality_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failed-row count per rule, long form (rule, column, kind,
    failed_rows, total_rows), from ONE aggregation pass over ``df``."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.sum(_fail_int(r)).cast("long").alias(f"r{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    per_rule = F.array(*[F.struct(F.lit(r.rule_name).alias("rule"), F.lit(r.column).alias("column"),
                                  F.lit(r.kind).alias("kind"),
                                  F.coalesce(F.col(f"r{i}"), F.lit(0)).alias("failed_rows"))
                         for i, r in enumerate(rules)])
    return wide.select(F.inline(per_rule), F.col("total_rows"))


def observe_quality(df: DataFrame, rules: Sequence[Rule], name: str = "dq") -> tuple[DataFrame, Observation]:
    """Attach the rule counts to ``df``'s own execution.

    The counts are filled when the returned DataFrame runs its first action
    (typically the write), so validation costs no extra read.
    """
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.sum(_fail_int(r)).alias(r.rule_name) for r in rules]
    return df.observe(obs, *aggs), obs


def failures_column(rules: Sequence[Rule]) -> Column:
    """Per row: array of the names of the rules it fails (empty = clean)."""
    return F.array_compact(F.array(*[F.when(r.fails(), F.lit(r.rule_name)) for r in rules]))


def with_failures(df: DataFrame, rules: Sequence[Rule], col: str = "dq_failures") -> DataFrame:
    return df.withColumn(col, failures_column(rules))


def quarantine(df: DataFrame, rules: Sequence[Rule], col: str = "dq_failures") -> tuple[DataFrame, DataFrame]:
    """Split into (clean rows, failing rows with their rule names).

    Both halves come from the same tagged plan; together they hold every
    input row exactly once.
    """
    return halves(with_failures(df, rules, col), col)


def halves(tagged: DataFrame, col: str = "dq_failures") -> tuple[DataFrame, DataFrame]:
    """(clean rows, failing rows) of a plan tagged by :func:`with_failures`."""
    return tagged.where(F.size(col) == 0).drop(col), tagged.where(F.size(col) > 0)


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their counts (DQ5).

    A count with map-side partial aggregation: a hot key contributes one
    partial row per task, never a whole group in one place.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def at_most_one_active(dim: DataFrame, natural_key: str, active_col: str = "is_active") -> DataFrame:
    """Natural keys with more than one active version (SCD-2 invariant)."""
    return unique_violations(dim.where(F.coalesce(F.col(active_col), F.lit(False))), [natural_key])


class QualityError(Exception):
    pass


def check(counts: dict[str, int], policy: str = "report") -> dict[str, int]:
    """Apply a failure policy to observed counts.

    ``report`` returns the non-zero counts, ``fail`` raises when any rule
    failed.  (``quarantine`` is a plan shape: see :func:`quarantine`.)
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    failed = {k: int(v) for k, v in counts.items() if k != "total_rows" and v}
    if failed and policy == "fail":
        raise QualityError(f"data-quality rules failed: {failed}")
    return failed
