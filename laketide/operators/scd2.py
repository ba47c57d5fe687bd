"""Slowly changing dimension, type 2 (SCD1-SCD5).

A dimension row is one version of a natural key: the key, its attributes,
a surrogate key and the half-open validity interval ``[start_date,
end_date)``; the open version has ``end_date`` NULL and ``is_active`` true.

* :func:`scd2_changes` - snapshot rows that are new or changed (SCD1).
* :func:`scd2_close`   - close superseded versions (SCD2).
* :func:`scd2_open`    - open versions for changed rows (SCD3).
* :func:`scd2_apply`   - one daily step: unchanged + closed + new (SCD4).
* :func:`scd2_from_snapshots` - the same history from many snapshots in
  one window pass (SCD5).
* :func:`scd2_continue` - the same, continued from the stored open versions.
* :func:`scd2_splice` - a late snapshot put into its place in the history.

All are pure DataFrame functions; storing the result is the sink's job.
Only changed keys are closed, in place; keys missing from a snapshot stay
open.  A row without a natural key has no history: every function leaves it
out, and :func:`unusable_rows` gives these rows for a quarantine.  A
snapshot holds a key once; :func:`one_row_per_key` makes one that does.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.functions.hashing import row_hash, surrogate_key


@dataclass(frozen=True)
class DimSpec:
    """Column names of one SCD-2 dimension."""

    natural_key: str
    attributes: tuple[str, ...]
    surrogate_key: str = "dim_key"
    start_col: str = "start_date"
    end_col: str = "end_date"
    active_col: str = "is_active"
    hash_columns: tuple[str, ...] = field(default=())
    # "md5": deterministic MD5(natural key '::' start date) - retry-safe,
    # testable; "uuid": random key per version, as the original did (a
    # retried task draws new keys, so only for loads that are never re-run).
    key_mode: str = "md5"

    @property
    def hashed(self) -> list[str]:
        """Columns of the change hash: natural key and attributes (the
        surrogate key and the interval columns never take part)."""
        return list(self.hash_columns or (self.natural_key, *self.attributes))

    @property
    def columns(self) -> list[str]:
        return [self.surrogate_key, self.natural_key, *self.attributes,
                self.start_col, self.end_col, self.active_col]


def _version(spec: DimSpec, values: dict[str, Column], start: Column, end: Column,
             active: Column, key: Column | None = None) -> Column:
    """A dimension row as a struct, in dimension column order."""
    if key is not None:
        sk = key
    elif spec.key_mode == "uuid":
        sk = F.uuid()
    else:
        sk = surrogate_key(values[spec.natural_key], start)
    cols = [sk.alias(spec.surrogate_key)]
    cols += [values[c].alias(c) for c in (spec.natural_key, *spec.attributes)]
    cols += [start.cast("date").alias(spec.start_col), end.cast("date").alias(spec.end_col),
             active.alias(spec.active_col)]
    return F.struct(*cols)


def _is_active(spec: DimSpec) -> Column:
    return F.coalesce(F.col(spec.active_col), F.lit(False))


def empty_dimension(spark, spec: DimSpec, snapshot: DataFrame) -> DataFrame:
    """Empty dimension with the snapshot's attribute types."""
    return scd2_open(snapshot.limit(0), spec, _dt.date(1970, 1, 1))


def unusable_rows(snapshot: DataFrame, spec: DimSpec) -> DataFrame:
    """Snapshot rows that cannot form a version: those with a NULL key."""
    return snapshot.where(F.col(spec.natural_key).isNull())


def one_row_per_key(snapshot: DataFrame, spec: DimSpec, *by: str) -> DataFrame:
    """One row per natural key (and per value of the columns ``by``, such as
    a snapshot date): key, attributes and ``conflict``.

    Rows that repeat a key with the same attributes are one row.  Of rows
    that differ, the one with the smallest attributes in declared order
    (NULL first) stays and ``conflict`` is true.  Rows with a NULL key are
    left out.  Both sides of the choice are minima and maxima, so a hot key
    is combined map-side.
    """
    row = F.struct(*spec.attributes)
    keys = [*by, spec.natural_key]
    ends = (snapshot.where(F.col(spec.natural_key).isNotNull())
            .groupBy(*keys).agg(F.min(row).alias("_least"), F.max(row).alias("_most")))
    return ends.select(*keys, *[F.col("_least")[c].alias(c) for c in spec.attributes],
                       (~F.col("_least").eqNullSafe(F.col("_most"))).alias("conflict"))


def scd2_changes(dim: DataFrame | None, snapshot: DataFrame, spec: DimSpec) -> DataFrame:
    """Snapshot rows whose (natural key, row hash) has no active version.

    Adds ``row_hash`` and ``change`` ('new' when the key has no active
    version, 'changed' when its attributes differ).  One shuffle join on
    the natural key; the active side has at most one row per key.
    """
    snap = (snapshot.where(F.col(spec.natural_key).isNotNull())
            .withColumn("row_hash", row_hash(spec.hashed)))
    if dim is None:
        return snap.withColumn("change", F.lit("new"))
    active = (dim.where(_is_active(spec))
              .select(F.col(spec.natural_key).alias("_a_key"),
                      row_hash(spec.hashed).alias("_a_hash")))
    j = snap.join(active, snap[spec.natural_key] == active["_a_key"], "left")
    return (j.where(F.col("_a_key").isNull() | (F.col("_a_hash") != F.col("row_hash")))
            .withColumn("change", F.when(F.col("_a_key").isNull(), F.lit("new")).otherwise(F.lit("changed")))
            .drop("_a_key", "_a_hash"))


def scd2_close(dim: DataFrame, changed_keys: DataFrame, spec: DimSpec, d) -> DataFrame:
    """Open versions whose key is in ``changed_keys``, closed on ``d``."""
    d = run_date(d)
    keys = changed_keys.select(F.col(spec.natural_key).alias("_k"))
    open_rows = dim.where(F.col(spec.end_col).isNull() & _is_active(spec))
    closed = open_rows.join(keys, open_rows[spec.natural_key] == keys["_k"], "left_semi")
    return (closed.withColumn(spec.end_col, F.lit(d))
            .withColumn(spec.active_col, F.lit(False))
            .select(*spec.columns))


def scd2_open(changes: DataFrame, spec: DimSpec, d) -> DataFrame:
    """New open versions (start = d, end NULL, active) for snapshot rows."""
    d = run_date(d)
    values = {c: F.col(c) for c in (spec.natural_key, *spec.attributes)}
    v = _version(spec, values, F.lit(d), F.lit(None), F.lit(True))
    return changes.select(v.alias("_v")).select("_v.*")


def max_active_start(dim: DataFrame, spec: DimSpec):
    """Load watermark: latest start date among active versions (AGG5).

    One aggregate value reaches the driver; no table rows do.
    """
    return dim.where(_is_active(spec)).agg(F.max(spec.start_col).alias("m")).first()["m"]


def scd2_apply(dim: DataFrame | None, snapshot: DataFrame, spec: DimSpec, d,
               *, check_gate: bool = True) -> DataFrame:
    """One SCD-2 step for run date ``d`` (SCD4).

    Result = history versions (untouched) + active versions that stay
    (unchanged, or missing from the snapshot) + versions closed on ``d`` +
    new versions starting on ``d``.

    Plan: the active versions and the snapshot meet in ONE full outer join
    on the natural key (each side has at most one row per key, so no key
    can fan out or dominate a task); every joined row emits its 1 or 2
    output versions through ``inline`` in the same pass.  Closed history is
    not shuffled at all.

    The gate of the original pipeline is kept: when ``d`` is not after the
    latest active start date the dimension is returned unchanged (a
    back-dated run is a no-op; rebuild with :func:`scd2_from_snapshots`).
    """
    d = run_date(d)
    snap = (snapshot.where(F.col(spec.natural_key).isNotNull())
            .select(spec.natural_key, *spec.attributes))
    if dim is None:
        return scd2_open(snap, spec, d)
    dim = dim.select(*spec.columns)
    if check_gate:
        wm = max_active_start(dim, spec)
        if wm is not None and d <= wm:
            return dim

    history = dim.where(~_is_active(spec))
    active = dim.where(_is_active(spec))

    a = active.select(*[F.col(c).alias(f"_o_{c}") for c in spec.columns],
                      row_hash(spec.hashed).alias("_o_hash"))
    s = snap.select(*[F.col(c).alias(f"_n_{c}") for c in (spec.natural_key, *spec.attributes)],
                    row_hash(spec.hashed).alias("_n_hash"))
    j = a.join(s, a[f"_o_{spec.natural_key}"] == s[f"_n_{spec.natural_key}"], "full_outer")

    has_old = F.col(f"_o_{spec.natural_key}").isNotNull()
    has_new = F.col(f"_n_{spec.natural_key}").isNotNull()
    changed = has_old & has_new & (F.col("_o_hash") != F.col("_n_hash"))
    old_vals = {c: F.col(f"_o_{c}") for c in (spec.natural_key, *spec.attributes)}
    new_vals = {c: F.col(f"_n_{c}") for c in (spec.natural_key, *spec.attributes)}

    old_row = F.when(has_old, _version(
        spec, old_vals, F.col(f"_o_{spec.start_col}"),
        F.when(changed, F.lit(d)).otherwise(F.col(f"_o_{spec.end_col}")),
        F.when(changed, F.lit(False)).otherwise(F.col(f"_o_{spec.active_col}")),
        key=F.col(f"_o_{spec.surrogate_key}")))
    new_row = F.when(has_new & (~has_old | changed), _version(
        spec, new_vals, F.lit(d), F.lit(None), F.lit(True)))
    stepped = j.select(F.inline(F.filter(F.array(old_row, new_row), lambda x: x.isNotNull())))
    return history.unionByName(stepped)


def scd2_from_snapshots(snapshots: DataFrame, spec: DimSpec, date_col: str = "snapshot_date") -> DataFrame:
    """Full SCD-2 history from stacked snapshots in one pass (SCD5).

    ``snapshots`` holds one row per (natural key, snapshot date).  Per key,
    ordered by date: keep the rows whose hash differs from the previous
    present row (first appearance included); the next kept row's date closes
    a version.  Equals :func:`scd2_apply` iterated over ascending dates,
    including keys that vanish and return.

    One shuffle on the natural key and one sort; both windows share the
    partitioning, so the second adds no exchange.  A key's group holds one
    row per snapshot, so its size is bounded by the number of snapshots.
    """
    h = snapshots.where(F.col(spec.natural_key).isNotNull()).select(spec.natural_key, *spec.attributes,
                         F.col(date_col).cast("date").alias("_d"),
                         row_hash(spec.hashed).alias("_h"))
    # the hash breaks ties, so a key listed twice in one snapshot still
    # gives the same result on every run (DQ5 flags such snapshots)
    w = Window.partitionBy(spec.natural_key).orderBy("_d", "_h")
    kept = (h.withColumn("_prev", F.lag("_h").over(w))
            .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_h"))))
    ended = kept.withColumn("_end", F.lead("_d").over(w))
    values = {c: F.col(c) for c in (spec.natural_key, *spec.attributes)}
    v = _version(spec, values, F.col("_d"), F.col("_end"), F.col("_end").isNull())
    return ended.select(v.alias("_v")).select("_v.*")


def scd2_continue(open_versions: DataFrame, snapshots: DataFrame, spec: DimSpec,
                  date_col: str = "snapshot_date") -> DataFrame:
    """What many later snapshots change in a stored dimension, in one pass.

    ``open_versions`` are the stored active versions (one a key);
    ``snapshots`` hold one row per (natural key, snapshot date), all dates
    after the last load.  A stored version is row zero of its key's window:
    it has no predecessor, and the first snapshot row that differs closes it.
    The result has the stored versions that are closed now (with the keys
    and start dates they had) and all new versions; versions that stay open
    as they are do not leave, so what is returned follows the changes.
    :func:`replace_versions` puts it into a dimension; that equals
    :func:`scd2_apply` iterated over the dates.  Rows without a natural key
    are left out.

    One shuffle on the natural key; a key's window has one row per snapshot
    and one more.  The closed history is not read.
    """
    key = spec.natural_key
    attrs = [key, *spec.attributes]
    none = F.lit(None)
    new = (snapshots.where(F.col(key).isNotNull())
           .select(*attrs, F.col(date_col).cast("date").alias("_d"), row_hash(spec.hashed).alias("_h"),
                   F.lit(1).alias("_new"), none.cast("string").alias("_sk")))
    stored = (open_versions.where(_is_active(spec))
              .select(*attrs, F.col(spec.start_col).alias("_d"), row_hash(spec.hashed).alias("_h"),
                      F.lit(0).alias("_new"), F.col(spec.surrogate_key).cast("string").alias("_sk")))
    w = Window.partitionBy(key).orderBy("_new", "_d", "_h")
    kept = (stored.unionByName(new).withColumn("_prev", F.lag("_h").over(w))
            .where((F.col("_new") == 0) | F.col("_prev").isNull() | (F.col("_prev") != F.col("_h"))))
    ended = kept.withColumn("_end", F.lead("_d").over(w)).where((F.col("_new") == 1) | F.col("_end").isNotNull())
    values = {c: F.col(c) for c in attrs}
    sk = F.uuid() if spec.key_mode == "uuid" else surrogate_key(F.col(key), F.col("_d"))
    v = _version(spec, values, F.col("_d"), F.col("_end"), F.col("_end").isNull(), key=F.coalesce("_sk", sk))
    return ended.select(v.alias("_v")).select("_v.*")


def replace_versions(dim: DataFrame, changed: DataFrame, spec: DimSpec, removed: DataFrame | None = None) -> DataFrame:
    """``dim`` with the versions ``changed`` in place of those with the same
    surrogate key, and without the surrogate keys ``removed``."""
    gone = changed.select(spec.surrogate_key)
    if removed is not None:
        gone = gone.union(removed.select(spec.surrogate_key))
    return (dim.select(*spec.columns).join(gone, spec.surrogate_key, "left_anti")
            .select(*spec.columns).unionByName(changed.select(*spec.columns)))


def scd2_late_changes(dim: DataFrame, snapshot: DataFrame, later: DataFrame, spec: DimSpec, d,
                      date_col: str = "snapshot_date") -> DataFrame:
    """What a snapshot of the past date ``d`` changes in a dimension that has
    later loads: its versions with ``_removed`` true (to take out, by
    surrogate key) or false (to put in).  Arguments as in
    :func:`scd2_splice`."""
    d = run_date(d)
    key, day = spec.natural_key, F.lit(d)
    attrs = [key, *spec.attributes]
    late = snapshot.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.struct(*attrs).alias("_row"), row_hash(spec.hashed).alias("_h"))
    start, end = F.col(spec.start_col), F.col(spec.end_col)
    version = F.struct(start.alias("_s"), *[F.col(c).alias(c) for c in spec.columns], row_hash(spec.hashed).alias("_h"))
    covers = (start < day) & (end.isNull() | (end > day))
    around = (dim.where(covers | (start > day)).groupBy(F.col(key).alias("_dk"))
              .agg(F.max(F.when(covers, version)).alias("_now"), F.min(F.when(start > day, version)).alias("_next")))
    seen = (later.where(F.col(key).isNotNull() & (F.col(date_col).cast("date") > day))
            .groupBy(F.col(key).alias("_lk")).agg(F.min(F.col(date_col).cast("date")).alias("_seen")))
    j = late.join(around, F.col("_k") == F.col("_dk"), "left")
    now, nxt, h = F.col("_now"), F.col("_next"), F.col("_h")
    # most keys say what the history says: only the others meet the later snapshots
    touched = j.where(now.isNull() | (now["_h"] != h)).join(seen, F.col("_k") == F.col("_lk"), "left")

    def made(row, start, end, removed, sk=None):
        values = {c: row[c] for c in attrs}
        v = _version(spec, values, start, end, end.isNull(), key=sk)
        return F.struct(F.lit(removed).alias("_removed"), *[v[c].alias(c) for c in spec.columns])

    def old(row, removed=True):
        return made(row, row[spec.start_col], row[spec.end_col], removed, sk=row[spec.surrogate_key])
    after = nxt["_s"]                                   # null: nothing starts later
    same_next = nxt.isNotNull() & (nxt["_h"] == h)
    # the version of that day is seen again before it ends: it comes back
    back = now.isNotNull() & F.col("_seen").isNotNull() & (after.isNull() | (F.col("_seen") < after))
    joined = same_next & ~back                          # the next version starts on d already
    rows = F.array(
        F.when(now.isNotNull(), old(now)),
        F.when(now.isNotNull(), made(now, now[spec.start_col], day, False, sk=now[spec.surrogate_key])),
        F.when(joined, old(nxt)),
        F.when(joined, made(F.col("_row"), day, nxt[spec.end_col], False))
        .otherwise(made(F.col("_row"), day, F.when(back, F.col("_seen")).otherwise(after), False)),
        F.when(back, made(now, F.col("_seen"), now[spec.end_col], False)))
    return touched.select(F.inline(F.filter(rows, lambda x: x.isNotNull())))


def scd2_splice(dim: DataFrame, snapshot: DataFrame, later: DataFrame, spec: DimSpec, d,
                date_col: str = "snapshot_date") -> DataFrame:
    """The dimension after a snapshot of the past date ``d``: equal to a
    rebuild from all snapshots in order.

    ``snapshot`` holds a key once; ``later`` holds at least the key and date
    of every row of the snapshots after ``d`` (the silver table itself will
    do): the history alone does not say whether a key was seen again
    unchanged, and a value that the late snapshot interrupts comes back on
    the day it is seen again.  Keys that the late snapshot lacks, or for
    which it says what the history says, keep their versions.  For the others

    * the version valid on ``d`` ends on ``d``; it comes back as a version of
      its own when its key is seen again before its old end;
    * a next version with the late row's values starts on ``d`` instead
      (with the surrogate key of its new start), otherwise the late row is a
      version of its own until the key is seen again or the next one starts.

    A date that is loaded already raises: run that day's load again instead.
    Facts from ``d`` on that hold a changed surrogate key are to be looked up
    again.  One shuffle of the versions that end after ``d`` (earlier ones
    are not aggregated), joined to the snapshot by key; minima and maxima are
    combined map-side, and only keys that differ meet ``later``.
    """
    if not dim.where(F.col(spec.start_col) == F.lit(run_date(d))).isEmpty():
        raise ValueError(f"{run_date(d)} is loaded already")
    changes = scd2_late_changes(dim, snapshot, later, spec, d, date_col)
    # a version that is taken out and put in again stands in both
    put = changes.where(~F.col("_removed")).drop("_removed")
    return replace_versions(dim, put, spec, changes.where("_removed"))


def valid_on(dim: DataFrame, spec: DimSpec, d) -> DataFrame:
    """Versions valid on date ``d``: start <= d < end (end NULL = open).

    Matches ``start <= d AND (end > d OR is_active)`` of the original
    lookups, since a version is active exactly when its end is NULL.
    """
    d = F.lit(run_date(d))
    return dim.where((F.col(spec.start_col) <= d) &
                     (F.col(spec.end_col).isNull() | (F.col(spec.end_col) > d)))


def last_date(dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Latest of max(start) and max(end) over active versions (AGG6),
    as a one-row DataFrame.  ``greatest`` skips NULLs like MAX over a
    union does."""
    return (dim.where(_is_active(spec))
            .agg(F.greatest(F.max(spec.start_col), F.max(spec.end_col)).alias("last_date")))
