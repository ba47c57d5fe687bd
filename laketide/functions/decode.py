"""Code -> label mapping (MAP1, MAP2)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from laketide.functions._util import as_col

# Labels of the original pipeline.
UNKNOWN_LABEL = "(unknown)"
MARITAL_LABELS = {"M": "MARRIED", "S": "SINGLE", "D": "DIVORCE"}
GENDER_LABELS = {"F": "FEMALE", "M": "MALE"}


def decode_map(c, mapping: Mapping[str, str], default: str | None = UNKNOWN_LABEL) -> Column:
    """CASE WHEN code = k THEN v ... ELSE default END; NULL maps to default.

    Compiles to one CASE expression, so a small code table stays inside the
    generated code (no join, no broadcast).
    """
    col = as_col(c)
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    expr = F.when(col == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def marital_status(c) -> Column:
    return decode_map(c, MARITAL_LABELS)


def gender(c) -> Column:
    return decode_map(c, GENDER_LABELS)
