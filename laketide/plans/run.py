"""Daily run in dependency order (RUN1).

A plain driver loop over dates; every stage is a Spark job over one date
partition, written idempotently, so a failed day is simply run again and a
repeated day changes nothing.  Table rows never reach the driver: only
quality counts and the dimension load watermark do.

Order per day (the original job graph):
  bronze: patients, payers (full), encounters, procedures (run-date slice)
  silver: the four tables, cleaned, typed and validated in one pass each
  gold:   dim_patient, dim_payer (SCD-2) -> fact_encounter, fact_procedure
          -> daily_encounter
"""

from __future__ import annotations

import contextlib
import datetime as _dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.operators import quality as DQ
from laketide.operators.scd2 import one_row_per_key, unusable_rows
from laketide.plans import bronze, gold, silver
from laketide.session import stored
from laketide.sinks.dimension import DimensionTables, catalog_table
from laketide.sinks.dimension_log import DimensionLog
from laketide.sinks.keyindex import KeyIndex
from laketide.sinks.write import materialize, overwrite_partition, overwrite_range
from laketide.sources.tables import read_slice, read_table, table_exists

TABLES = ("patients", "payers", "encounters", "procedures")
DIMENSIONS = {"patients": ("dim_patient", gold.DIM_PATIENT), "payers": ("dim_payer", gold.DIM_PAYER)}


@dataclass(frozen=True)
class Layout:
    """Where each layer's tables live (a shared storage root), and whether
    the dimensions are kept as logs of changes (:class:`DimensionLog`)."""

    root: str
    dimension_log: bool = False

    def bronze(self, t: str) -> str:
        return f"{self.root.rstrip('/')}/bronze/{t}"

    def silver(self, t: str) -> str:
        return f"{self.root.rstrip('/')}/silver/{t}"

    def quarantine(self, t: str) -> str:
        return f"{self.root.rstrip('/')}/quarantine/{t}"

    def gold(self, t: str) -> str:
        return f"{self.root.rstrip('/')}/gold/{t}"

    def keys(self, t: str, keys) -> str:
        return f"{self.root.rstrip('/')}/keys/{t}/{'+'.join(keys)}"


@dataclass
class DayReport:
    day: _dt.date
    quality: dict[str, dict[str, int]] = field(default_factory=dict)
    dimensions: dict[str, str] = field(default_factory=dict)
    writes: dict[str, str] = field(default_factory=dict)


def run_bronze(spark: SparkSession, d, raw: dict[str, str], layout: Layout, report: DayReport) -> None:
    for t in TABLES:
        if t in bronze.EVENT_TABLES:
            # one scan of the file: the day's slice and the undated rows are
            # kept (recomputable if an executor is lost), then each of the
            # two partitions is replaced exactly
            sliced = bronze.ingest(spark, raw[t], t, d).persist(StorageLevel.MEMORY_AND_DISK)
            part = F.col(bronze.PART_COL)
            overwrite_partition(sliced.where(part.isNotNull()), layout.bronze(t), bronze.PART_COL, d)
            overwrite_partition(sliced.where(part.isNull()), layout.bronze(t), bronze.PART_COL, None)
            sliced.unpersist()
            report.writes[f"bronze/{t}"] = "overwrite_partition (day and undated)"
        else:
            overwrite_partition(bronze.ingest(spark, raw[t], t, d), layout.bronze(t), bronze.PART_COL, d)
            report.writes[f"bronze/{t}"] = "overwrite_partition"
        if t in bronze.EVENT_TABLES:  # rows that belong to no day (pruned read)
            undated = read_table(spark, layout.bronze(t)).where(F.col(bronze.PART_COL).isNull())
            report.quality[f"bronze_{t}"] = {"undated_rows": undated.count()}


def run_silver(spark: SparkSession, d, layout: Layout, report: DayReport, policy: str = "report") -> None:
    for t in TABLES:
        conform, typed, rules = silver.STAGES[t]
        conformed = conform(read_slice(spark, layout.bronze(t), d, bronze.PART_COL))
        if policy == "fail":  # must know before writing: one counting pass first
            counts = DQ.quality_counts(conformed, rules).collect()
            DQ.check({r["rule"]: r["failed_rows"] for r in counts}, "fail")
        observed, obs = DQ.observe_quality(conformed, rules, name=f"dq_{t}")
        # static overwrite of the day: a re-run replaces the day completely
        if policy == "quarantine":
            # the rows are read, tagged and counted once; both tables take
            # their half from the tagged copy
            with stored(DQ.with_failures(observed, rules), t) as tagged:
                clean, bad = DQ.halves(tagged)
                overwrite_partition(bad, layout.quarantine(t), silver.PART_COL, d)
                overwrite_partition(typed(clean), layout.silver(t), silver.PART_COL, d)
        else:
            overwrite_partition(typed(observed), layout.silver(t), silver.PART_COL, d)
        report.quality[t] = {k: int(v or 0) for k, v in obs.get.items()}
        report.writes[f"silver/{t}"] = "overwrite_partition"


def dimension(spark: SparkSession, layout: Layout, name: str) -> DimensionTables:
    spec = {n: s for n, s in DIMENSIONS.values()}[name]
    tables = DimensionLog if layout.dimension_log else DimensionTables
    return tables(spark, layout.gold(name), spec)


def _compact(tables: DimensionTables) -> None:
    if isinstance(tables, DimensionLog) and tables.compaction_due():
        tables.compact()


def _rule_counts(df, rules, unique=()) -> dict[str, int]:
    """Failed rows per rule, and key values that are not unique."""
    counts = {r["rule"]: int(r["failed_rows"]) for r in DQ.quality_counts(df, rules).collect()}
    for keys in unique:
        counts[f"{'+'.join(keys)}:unique"] = DQ.unique_violations(df, keys).count()
    return counts


def run_dimensions(spark: SparkSession, d, layout: Layout, report: DayReport,
                   policy: str = "report") -> None:
    """SCD-2 load of each dimension from the day's snapshot.  Only the open
    versions are read and rewritten (see :class:`DimensionTables`).

    Repeated rows are one row.  Rows without a natural key are counted and
    kept in the quarantine table ``<dimension>_rejected``.  A key with rows
    that differ is counted; under ``report`` the row that
    :func:`one_row_per_key` names is loaded, under ``quarantine`` all rows of
    the key go to the quarantine table.  The declared checks of the dimension
    (keys unique and not null, one open version a key) are counted on what
    the load will store; under ``fail`` any count raises before anything is
    written.
    """
    for t, (name, spec) in DIMENSIONS.items():
        tables = dimension(spark, layout, name)
        if tables.too_late(d):
            report.dimensions[name] = "skipped (a later day is loaded)"
            continue
        day = read_slice(spark, layout.silver(t), d, silver.PART_COL)
        key = spec.natural_key
        with stored(one_row_per_key(day, spec), name) as rows:
            clash = rows.where("conflict").select(key)
            checks = {"null_keys": unusable_rows(day, spec).count(), "duplicate_keys": clash.count()}
            DQ.check(checks, policy)
            rejected = unusable_rows(day, spec)
            if policy == "quarantine":
                rejected = rejected.unionByName(day.join(clash, key, "left_semi"))
                rows = rows.where(~F.col("conflict"))
            if any(checks.values()) or table_exists(spark, layout.quarantine(f"{name}_rejected")):
                overwrite_partition(rejected, layout.quarantine(f"{name}_rejected"), silver.PART_COL, d)
            with stored(tables.step(rows.drop("conflict"), d), name) as step:
                checks |= _rule_counts(step, gold.DIMENSION_RULES[name], [[spec.surrogate_key]])
                checks["multiple_active"] = DQ.at_most_one_active(step, key).count()
                DQ.check(checks, policy)
                tables.store(step, d)
        _compact(tables)
        report.dimensions[name] = "loaded"
        report.quality[name] = checks


def _store_gold(spark: SparkSession, df, name: str, first, last, layout: Layout, report: DayReport, policy: str,
                write) -> None:
    """One gold table's dates from ``first`` to ``last``, stored by
    ``write``, with its declared checks.

    Rules are counted on the partitions just written (a pruned read), or
    under ``fail`` on a stored copy, so that a failing load is never written.
    Declared keys are unique over the whole table: the load's keys are looked
    up in the table's key index (:class:`KeyIndex`), and the count is that of
    the load's keys that the table holds more than once, whatever the dates.
    The index is written after the table; a load that died between the two is
    indexed by the next.
    """
    rules, unique = gold.GOLD_RULES[name], gold.UNIQUE_KEYS.get(name, [])
    target = layout.gold(name)
    indexes = [KeyIndex(spark, layout.keys(name, keys), keys, "date") for keys in unique]

    def counts(rows) -> dict[str, int]:
        found = _rule_counts(rows, rules)
        for index in indexes:
            index.catch_up(target, first, last)
            found[f"{'+'.join(index.keys)}:unique"] = index.violations(rows, first, last).count()
        return found
    if policy == "fail":
        with stored(df, name) as rows:
            report.quality[name] = counts(rows)
            DQ.check(report.quality[name], policy)
            write(rows, target)
    else:
        write(df, target)
        written = read_table(spark, target).where(F.col("date").between(F.lit(first), F.lit(last)))
        report.quality[name] = counts(written)
    for index in indexes:
        written = read_table(spark, target).where(F.col("date").between(F.lit(first), F.lit(last)))
        index.store(written, first, last)


def run_facts(spark: SparkSession, d, layout: Layout, report: DayReport, policy: str = "report") -> None:
    dim_patient = dimension(spark, layout, "dim_patient").read()
    dim_payer = dimension(spark, layout, "dim_payer").read()
    enc = read_slice(spark, layout.silver("encounters"), d, silver.PART_COL)
    proc = read_slice(spark, layout.silver("procedures"), d, silver.PART_COL)
    # events still open (no stop time): not in a fact until they stop
    report.quality["open_events"] = {
        "encounters": enc.where(F.col("stop_time").isNull()).count(),
        "procedures": proc.where(F.col("stop_time").isNull()).count()}

    def store(name, df):
        def write(rows, target):
            report.writes[f"gold/{name}"] = materialize(rows, target, "date", d)
        _store_gold(spark, df, name, d, d, layout, report, policy, write)
    store("fact_encounter", gold.fact_encounter(enc, dim_patient, dim_payer, d))
    store("fact_procedure", gold.fact_procedure(proc, dim_patient, d))
    roll = gold.daily_rollup(read_table(spark, layout.gold("fact_encounter")),
                             read_table(spark, layout.gold("fact_procedure")), d)
    store("daily_encounter", roll)


def publish_gold(spark: SparkSession, layout: Layout, database: str = "gold") -> list[str]:
    """Gold in the session's catalog, for any SQL reader: external tables
    over the facts and the rollup, a view for each dimension (SNK8).  Returns
    their names; run it again after a load."""
    views = [dimension(spark, layout, n).create_views(database, n) for n, _ in DIMENSIONS.values()]
    return views + [catalog_table(spark, layout.gold(n), database, n, "date") for n in gold.GOLD_RULES]


def run_day(spark: SparkSession, d, raw: dict[str, str], layout: Layout,
            policy: str = "report") -> DayReport:
    """All stages of one run date."""
    d = run_date(d)
    report = DayReport(d)
    raw = {t: bronze.path_on(source, d) for t, source in raw.items()}
    run_bronze(spark, d, raw, layout, report)
    run_silver(spark, d, layout, report, policy)
    run_dimensions(spark, d, layout, report, policy)
    run_facts(spark, d, layout, report, policy)
    return report


def run_days(spark: SparkSession, first, last, raw: dict[str, str], layout: Layout,
             policy: str = "report") -> list[DayReport]:
    """Every date from ``first`` to ``last``, both included, in order."""
    d, end = run_date(first), run_date(last)
    reports = []
    while d <= end:
        reports.append(run_day(spark, d, raw, layout, policy))
        d += _dt.timedelta(days=1)
    return reports


def _added(counts: list, copies: list[int]) -> dict[str, int]:
    """Rule counts of parts, added up as often as each part is stored."""
    return {k: sum(int(c[k] or 0) * n for c, n in zip(counts, copies)) for k in counts[0]}


def run_range(spark: SparkSession, first, last, raw: dict, layout: Layout, policy: str = "report") -> DayReport:
    """Every date from ``first`` to ``last`` in one pass a layer; the tables
    end up as :func:`run_days` would leave them.

    * Every raw file is scanned once: events fan out to their days, a
      snapshot file (``raw`` holds a path, or {date: path}, each valid from
      its date on) to the days on which it is valid.
    * Silver and gold are one job a table over the range's partitions, with
      one dynamic overwrite; days that have no rows any more are cleared.
    * A snapshot has as many copies as days, and none of them is shuffled:
      bronze makes them day by day from a stored copy of the file.  Silver
      cleans, types and checks the file's first day, whose rows are those of
      its other days, and makes its copies from that; a count stands for all
      days.
    * The dimensions' history goes on from the stored open versions, from the
      days on which a snapshot file changes, and is stored as one load.
    * Facts are looked up by each row's date.

    The report's counts are those of the whole range.  Under ``fail`` a layer
    is counted before it is written; under ``quarantine`` failing rows go to
    the quarantine tables.  A range that ends before a dimension's last load
    leaves that dimension alone.
    """
    first, last = run_date(first), run_date(last)
    report = DayReport(last)

    def between(df, part_col, begin=first, end=last):
        return df.where(F.col(part_col).between(F.lit(begin), F.lit(end)))

    def write(df, target, part_col, **kw):
        report.writes["/".join(target.rsplit("/", 2)[1:])] = f"{overwrite_range(df, target, part_col, first, last, **kw)} rows"

    for t in TABLES:
        if t in bronze.EVENT_TABLES:
            write(bronze.ingest_event_range(spark, raw[t], t, first, last), layout.bronze(t), bronze.PART_COL, undated=True)
            undated = read_table(spark, layout.bronze(t)).where(F.col(bronze.PART_COL).isNull())
            report.quality[f"bronze_{t}"] = {"undated_rows": undated.count()}
        else:
            with contextlib.ExitStack() as files:
                def once(df, name=t):
                    return files.enter_context(stored(df, name))
                write(bronze.ingest_full_range(spark, raw[t], t, first, last, once),
                      layout.bronze(t), bronze.PART_COL, clustered=True)

    for t in TABLES:
        conform, typed, rules = silver.STAGES[t]
        once = t in bronze.SNAPSHOT_TABLES  # bronze holds the same rows on all days of a file
        spans = [(b, e) for b, e, _ in bronze.periods(raw[t], first, last)] if once else [(first, last)]
        copies = [(e - b).days + 1 if once else 1 for b, e in spans]
        parts = [conform(between(read_table(spark, layout.bronze(t)), bronze.PART_COL, b, b if once else e))
                 for b, e in spans]
        if policy == "fail":
            DQ.check(_added([{r["rule"]: r["failed_rows"] for r in DQ.quality_counts(part, rules).collect()}
                             for part in parts], copies), "fail")
        with contextlib.ExitStack() as files:
            def kept(df, name=t):
                return files.enter_context(stored(df, name))
            seen, good, bad = [], None, None
            for part, (b, e) in zip(parts, spans):
                part, obs = DQ.observe_quality(part, rules, name=f"dq_{t}")
                seen.append(obs)
                wrong = None
                if policy == "quarantine":
                    part, wrong = DQ.halves(kept(DQ.with_failures(part, rules)))
                part = typed(part)
                if once:
                    part, wrong = (x if x is None else bronze.on_each_day(kept(x).drop(silver.PART_COL), b, e)
                                   for x in (part, wrong))
                good = part if good is None else good.unionByName(part)
                bad = wrong if bad is None else bad.unionByName(wrong)
            if bad is not None:
                write(bad, layout.quarantine(t), silver.PART_COL, clustered=once)
            write(good, layout.silver(t), silver.PART_COL, clustered=once)
            report.quality[t] = _added([obs.get for obs in seen], copies)

    for t, (name, spec) in DIMENSIONS.items():
        tables = dimension(spark, layout, name)
        if tables.too_late(last):
            report.dimensions[name] = "skipped (a later day is loaded)"
            continue
        # between these days the snapshots repeat themselves
        begins = [b for b, _, _ in bronze.periods(raw[t], first, last)]
        days = read_table(spark, layout.silver(t)).where(F.col(silver.PART_COL).isin(begins))
        with stored(one_row_per_key(days, spec, silver.PART_COL), name) as rows:
            clash = rows.where("conflict").select(silver.PART_COL, spec.natural_key)
            checks = {"null_keys": unusable_rows(days, spec).count(), "duplicate_keys": clash.count()}
            DQ.check(checks, policy)
            rejected = unusable_rows(days, spec)
            if policy == "quarantine":
                rejected = rejected.unionByName(days.join(clash, [silver.PART_COL, spec.natural_key], "left_semi"))
                rows = rows.where(~F.col("conflict"))
            if any(checks.values()) or table_exists(spark, layout.quarantine(f"{name}_rejected")):
                write(rejected.select(*days.columns), layout.quarantine(f"{name}_rejected"), silver.PART_COL)
            changed, before = tables.step_range(rows.drop("conflict"), first, silver.PART_COL)
            with stored(changed, name) as step:
                checks |= _rule_counts(step, gold.DIMENSION_RULES[name], [[spec.surrogate_key]])
                checks["multiple_active"] = DQ.at_most_one_active(step, spec.natural_key).count()
                DQ.check(checks, policy)
                tables.store_range(step, before, last, first)
        _compact(tables)
        report.dimensions[name] = "loaded"
        report.quality[name] = checks

    dim_patient, dim_payer = (dimension(spark, layout, n).read() for n in ("dim_patient", "dim_payer"))
    enc, proc = (between(read_table(spark, layout.silver(t)), silver.PART_COL) for t in ("encounters", "procedures"))
    report.quality["open_events"] = {"encounters": enc.where(F.col("stop_time").isNull()).count(),
                                     "procedures": proc.where(F.col("stop_time").isNull()).count()}

    def store(name, df):
        _store_gold(spark, df, name, first, last, layout, report, policy,
                    lambda rows, target: write(rows, target, "date"))
    store("fact_encounter", gold.fact_encounter(enc, dim_patient, dim_payer))
    store("fact_procedure", gold.fact_procedure(proc, dim_patient))
    store("daily_encounter", gold.daily_rollup(*(between(read_table(spark, layout.gold(n)), "date")
                                                 for n in ("fact_encounter", "fact_procedure"))))
    return report
