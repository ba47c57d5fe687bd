"""Row hashing for change detection (NUL1, HSH1, HSH2) and surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from laketide.functions._util import as_col

# Separator of hashed fields and the SCD-2 bookkeeping
# columns that never take part in the change hash.
HASH_SEPARATOR = "::"
SCD_COLUMNS = ("start_date", "end_date", "is_active")


def null_to_empty(c) -> Column:
    """COALESCE(CAST(c AS STRING), '')."""
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


def hash_columns(columns: Iterable[str], surrogate_key: str | None = None,
                 exclude: Sequence[str] = SCD_COLUMNS) -> list[str]:
    """Columns that take part in the change hash: all but the surrogate
    key and the SCD-2 bookkeeping columns."""
    skip = set(exclude) | ({surrogate_key} if surrogate_key else set())
    return [c for c in columns if c not in skip]


def row_hash(columns: Sequence[str]) -> Column:
    """MD5 over the '::'-joined, NULL-as-empty text of the columns.

    Note NULL and '' hash alike, and a '::' inside a value can collide;
    :func:`json_row_hash` avoids both.
    """
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[null_to_empty(c) for c in columns]))


def json_row_hash(columns: Sequence[str]) -> Column:
    """Collision-safe alternative: SHA-256 of the JSON form of the row."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)


def surrogate_key(natural_key: Sequence[str] | str, start_date) -> Column:
    """Deterministic dimension key: MD5(natural key '::' start date).

    Deterministic so a retried task or a re-run produces the same key
    (``uuid()`` would not).
    """
    keys = list(natural_key) if isinstance(natural_key, (list, tuple)) else [natural_key]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[null_to_empty(k) for k in keys],
                             as_col(start_date).cast("string")))
