"""Registered queries: one per operator group of the inventory.

Each takes ``(spark, sf_dir)``, reads whole driver tables (or what Spark
derives from them) and returns a DataFrame whose column names match the
DuckDB oracle in :mod:`laketide.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide import functions as LF
from laketide.functions.names import normalize_columns, recast_for_export
from laketide.operators import quality as DQ
from laketide.operators import scd2 as S
from laketide.operators import slicing as SL
from laketide.operators.asof import lookup_asof, lookup_asof_merge
from laketide.operators.rollup import daily_rollup, daily_rollup_joined
from laketide.operators.sketches import DistinctRollup, relative_error
from laketide.plans import bronze, gold, silver
from laketide.session import cut_lineage, scratch_path, stored
from laketide.sinks import write as W
from laketide.sinks.bucketed import write_bucketed
from laketide.sinks.dimension import DimensionTables
from laketide.sinks.dimension_log import DimensionLog
from laketide.sinks.keyindex import KeyIndex
from laketide.sinks.published import PublishedTable
from laketide.sources.files import read_csv
from laketide.sources.tables import read_table
from laketide.plans import standins as si

AMOUNTS = ["total_claim_amount", "total_coverage_amount", "total_patient_pay_amount"]


def _round(df: DataFrame, cols, digits: int = 2) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ SCD-2
def q_scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim1 = S.scd2_apply(None, si.patients_snapshot(spark, sf_dir, 1), si.PATIENT, si.D1)
    ch = S.scd2_changes(dim1, si.patients_snapshot(spark, sf_dir, 2), si.PATIENT)
    return ch.select("patient_id", "segment", "row_hash", "change")


def q_scd2_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.dim_patient(spark, sf_dir)


def q_scd2_close_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD2 + SCD3 as separate steps: closed versions plus new versions."""
    dim1 = S.scd2_apply(None, si.patients_snapshot(spark, sf_dir, 1), si.PATIENT, si.D1)
    ch = S.scd2_changes(dim1, si.patients_snapshot(spark, sf_dir, 2), si.PATIENT)
    closed = S.scd2_close(dim1, ch.where(F.col("change") == "changed"), si.PATIENT, si.D2)
    opened = S.scd2_open(ch, si.PATIENT, si.D2)
    return closed.unionByName(opened)


def q_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scd2_from_snapshots(si.patient_snapshots(spark, sf_dir), si.PATIENT, "snapshot_date")


def q_scd2_iterated(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = si.dim_patient(spark, sf_dir)
    return S.scd2_apply(dim, si.patients_snapshot(spark, sf_dir, 3), si.PATIENT, si.D3, check_gate=False)


def q_last_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.last_date(si.dim_patient(spark, sf_dir), si.PATIENT)


# ---------------------------------------------------------- point in time
ASOF_DAY = "1999-06-30"


def q_asof_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = si.encounters(spark, sf_dir).select("encounter_id", "patient_id")
    return lookup_asof(enc, si.dim_patient(spark, sf_dir), si.PATIENT, "patient_id", ASOF_DAY)


def q_asof_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = si.encounters(spark, sf_dir).select("encounter_id", "patient_id",
                                              F.to_date("start_time").alias("event_date"))
    return lookup_asof(enc, si.dim_patient(spark, sf_dir), si.PATIENT, "patient_id", "event_date")


def q_asof_event_date_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same lookup with hot patients salted over 8 tasks (5 patients, each a
    fifth of all rows)."""
    enc = si.encounters(spark, sf_dir, coarse=True, hot=True).select(
        "encounter_id", "patient_id", F.to_date("start_time").alias("event_date"))
    return lookup_asof(enc, si.dim_patient(spark, sf_dir), si.PATIENT, "patient_id", "event_date",
                       salt_buckets=8)


# ------------------------------------------------------------------ facts
def _fact_encounter(spark, sf_dir, coarse=False, hot=False):
    return gold.fact_encounter(si.encounters(spark, sf_dir, coarse, hot), si.dim_patient(spark, sf_dir),
                               si.dim_payer(spark, sf_dir), patient=si.PATIENT, payer=si.PAYER)


def _fact_procedure(spark, sf_dir):
    return gold.fact_procedure(si.procedures(spark, sf_dir), si.dim_patient(spark, sf_dir), patient=si.PATIENT)


def q_fact_encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_encounter(spark, sf_dir)


def q_fact_procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_procedure(spark, sf_dir)


def _procedure_days(spark, sf_dir, hot=False) -> DataFrame:
    """What a rollup needs of the procedure fact; its patient key is not."""
    return (si.procedures(spark, sf_dir, True, hot)
            .select("encounter_id", F.to_date("stop_time").alias("date"), "code").where(F.col("date").isNotNull()))


def q_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = daily_rollup(_fact_encounter(spark, sf_dir, True), _procedure_days(spark, sf_dir))
    return _round(r, AMOUNTS)


def q_daily_rollup_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = daily_rollup_joined(_fact_encounter(spark, sf_dir, True), _procedure_days(spark, sf_dir))
    return _round(r, AMOUNTS)


BUCKETS = 16


def q_daily_rollup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN5 on facts stored in buckets of the join key: they meet without an
    exchange.  Few patients and payers, so that groups hold several
    encounters; every 50th encounter and its procedures have lost the id."""
    def lost(df):
        return df.withColumn("encounter_id", F.when(F.col("encounter_id") % 50 != 0, F.col("encounter_id")))
    name = "bucketed_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    fe, fp = (write_bucketed(lost(df), f"{name}_{part}", ["encounter_id", "date"], BUCKETS, path=scratch_path(spark, part))
              for part, df in (("encounters", _fact_encounter(spark, sf_dir, True, True)),
                               ("procedures", _procedure_days(spark, sf_dir, True))))
    return _round(daily_rollup(fe, fp, spread_nulls=False), AMOUNTS)


DISTINCT = DistinctRollup(("encounter_class", "description"), {"n_patients": "patient_id"})


def q_distinct_reroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2 by stored sketches: patients a day and group, re-rolled to months
    (groups so small that the counts are exact) and to years and classes,
    where the estimate must lie within four standard errors of the count."""
    enc = si.encounters(spark, sf_dir).withColumn("date", F.to_date("start_time"))
    sketches = cut_lineage(DISTINCT.daily(enc), "sketches")
    months = DISTINCT.estimates(DISTINCT.merged(sketches, "month")).select(
        F.lit("month").alias("level"), "date", "encounter_class", "description", "n_patients",
        F.lit(True).alias("within_error"))
    years = DISTINCT.estimates(DISTINCT.merged(sketches, "year", ["encounter_class"]))
    exact = (enc.groupBy(F.trunc("date", "year").alias("date"), "encounter_class")
             .agg(F.count_distinct("patient_id").alias("exact")))
    error = 4 * relative_error(DISTINCT.lg_k)
    return months.unionByName(years.join(exact, ["date", "encounter_class"], "full").select(
        F.lit("year").alias("level"), "date", "encounter_class", F.lit(None).cast("string").alias("description"),
        F.col("exact").alias("n_patients"),
        (F.abs(F.col("n_patients") - F.col("exact")) <= F.col("exact") * error).alias("within_error")))


# ------------------------------------------------------- scalar functions
def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = si.table(spark, sf_dir, "documents")
    return d.select("doc_id", LF.clean_string("text").alias("clean_text"))


def q_clean_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = si.table(spark, sf_dir, "part")
    return p.select("p_partkey", LF.clean_string("p_name").alias("clean_name"),
                    LF.title_case("p_name").alias("title_name"))


def q_title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = si.table(spark, sf_dir, "documents")
    return d.select("doc_id", LF.title_case("text").alias("title_text"))


def q_upper_lower_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = si.table(spark, sf_dir, "customer")
    maybe_last = F.when(F.col("c_nationkey") > 10, F.col("c_mktsegment"))
    maybe_first = F.when(F.col("c_nationkey") % 5 != 0, F.col("c_name"))
    return c.select("c_custkey",
                    LF.upper_case("c_mktsegment").alias("segment_upper"),
                    LF.lower_case("c_name").alias("name_lower"),
                    LF.full_name(maybe_first, maybe_last).alias("full_name"))


def q_decode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = si.table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    LF.gender("o_orderstatus").alias("status_label"),
                    LF.marital_status(F.substring("o_orderpriority", 3, 1)).alias("priority_label"))


def q_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = si.table(spark, sf_dir, "customer")
    cols = LF.hash_columns(c.columns)
    return c.select("c_custkey", LF.row_hash(cols).alias("row_hash"))


# ------------------------------------------------------- slices and dates
def q_event_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = si.encounters(spark, sf_dir).select("encounter_id", "start_time", "stop_time")
    return SL.event_slices(e).select("slice_date", "encounter_id")


def q_day_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SL.day_counts(si.table(spark, sf_dir, "events"), "ts")


def q_date_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = si.encounters(spark, sf_dir)
    return e.select(
        "encounter_id",
        LF.to_day("stop_time").alias("date"),
        LF.day_text("start_time").alias("start_day_text"),
        LF.days_between("stop_time", "start_time").alias("length_of_stay_num"),
        LF.minutes_between("stop_time", "start_time").alias("duration_minute_num"),
        LF.epoch_seconds("start_time").alias("start_epoch"),
        (F.col("claim_amount") - F.col("coverage_amount")).alias("patient_pay_amount"))


def q_rename_recast(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = si.table(spark, sf_dir, "lineitem")
    raw = li.select(F.col("l_orderkey").alias("L-OrderKey"),
                    F.col("l_linenumber").alias("L Line-Number"),
                    F.col("l_shipdate").alias("Ship Date"),
                    F.to_date("l_shipdate").alias("Ship Day"),
                    F.col("l_extendedprice").cast("decimal(12,2)").alias("Extended Price"),
                    LF.parse_double(F.col("l_quantity").cast("string")).alias("Qty"),
                    LF.parse_double("l_returnflag").alias("Flag Number"))
    return recast_for_export(normalize_columns(raw))


# ---------------------------------------------------------------- quality
CUSTOMER_RULES = [
    *DQ.not_null("c_custkey", "c_name", "c_mktsegment"),
    DQ.pattern("c_name", "alphanumeric"),
    DQ.pattern("c_mktsegment", "alphabet"),
    DQ.typed("c_acctbal", "double"),
    DQ.Rule("c_mktsegment", "in_set", ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"),
            name="c_mktsegment:known"),
    DQ.Rule("c_acctbal", "pattern", r"^-?\d{1,4}\.\d{1,2}$", name="c_acctbal:money"),
]


def q_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.quality_counts(si.table(spark, sf_dir, "customer"), CUSTOMER_RULES)


def q_quality_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = DQ.with_failures(si.table(spark, sf_dir, "customer"), CUSTOMER_RULES)
    return tagged.select("c_custkey", (F.size("dq_failures") == 0).alias("is_clean"),
                         F.array_join("dq_failures", ",").alias("failed_rules"))


def q_unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.unique_violations(si.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [*DQ.not_null("quality", "toxic"), DQ.Rule("quality", "in_set", (0, 1), name="quality:binary"),
             DQ.Rule("toxic", "in_set", (0, 1), name="toxic:binary")]
    return DQ.quality_counts(si.table(spark, sf_dir, "labels"), rules)


def q_dim_key_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD-2 invariants as quality checks: surrogate key unique over all
    versions, at most one active version per natural key; on a dimension
    where the versions of every 10th key were appended twice."""
    dim = q_scd2_iterated(spark, sf_dir)
    dim = dim.unionByName(dim.where(F.col("patient_id") % 10 == 0))
    a = DQ.unique_violations(dim, ["dim_patient_key"]).select(
        F.lit("dim_patient_key").alias("check"), F.col("dim_patient_key").alias("key"), "n_rows")
    b = DQ.at_most_one_active(dim, "patient_id").select(
        F.lit("active_per_patient").alias("check"), F.col("patient_id").cast("string").alias("key"), "n_rows")
    return a.unionByName(b)



# ----------------------------------------------------- sources and sinks
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LOAD_DAY = "2024-01-01"


def q_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> raw CSV (all text) -> ING1 read with an all-text schema,
    stamped with the run date -> typed again in silver style."""
    path = scratch_path(spark, "orders_csv")
    o = si.table(spark, sf_dir, "orders")
    o.select(*[F.col(c).cast("string").alias(c) for c in ORDER_COLS]).write.option("header", True).csv(path)
    b = bronze.stamp(read_csv(spark, path, ORDER_COLS), LOAD_DAY)
    return b.select(F.col("o_orderkey").try_cast("long").alias("o_orderkey"),
                    F.col("o_orderstatus"),
                    LF.parse_double("o_totalprice").alias("o_totalprice"),
                    LF.parse_timestamp("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
                    F.col("partition_date"))


def q_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1: all event days written, then the first day rewritten with its
    clicks only; every other day must be intact."""
    path = scratch_path(spark, "events_by_day")
    ev = si.table(spark, sf_dir, "events").withColumn("partition_date", F.to_date("ts"))
    W.overwrite_partitions(ev, path, "partition_date")
    day = F.lit(LOAD_DAY).cast("date")
    redo = ev.where((F.col("partition_date") == day) & (F.col("event_type") == "click"))
    W.overwrite_partitions(redo, path, "partition_date")
    return read_table(spark, path).select("event_id", "ts", "user_id", "event_type", "value",
                                          "partition_date")


def q_materialize_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAT1: create a table partitioned by order date from all orders,
    then overwrite one partition with a re-computed query result (doubled
    prices); all other partitions stay as created."""
    path = scratch_path(spark, "orders_by_day")
    o = si.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    first = W.materialize(o, path, "day")
    day = "1996-06-01"
    redo = (o.where(F.col("day") == F.lit(day).cast("date"))
            .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    second = W.materialize(redo, path, "day", day)
    assert (first, second) == ("create", "overwrite_partition"), (first, second)
    return read_table(spark, path).select("o_orderkey", "o_totalprice", "day")


def q_materialize_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAT1 on an unpartitioned table: create, then append (SNK4)."""
    path = scratch_path(spark, "supplier_appends")
    s = si.table(spark, sf_dir, "supplier")
    first = W.materialize(s.withColumn("load", F.lit(1)), path)
    second = W.materialize(s.withColumn("load", F.lit(2)), path)
    assert (first, second) == ("create", "append"), (first, second)
    return read_table(spark, path)


def q_dimension_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD-2 state in two ordinary tables, read as the catalog view that
    any SQL reader gets (SNK8).  The second load is run twice, the first
    time from the wrong snapshot."""
    tables = DimensionTables(spark, scratch_path(spark, "dim_patient"), si.PATIENT)
    for n, d in ((1, si.D1), (3, si.D2), (2, si.D2)):
        with stored(tables.step(si.patients_snapshot(spark, sf_dir, n), d)) as step:
            tables.store(step, d)
    return spark.table(tables.create_views("laketide_gold", "dim_patient"))


def q_dimension_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD-2 state kept as a log of changes: four loads, the second run twice
    (first from the wrong snapshot), a compaction behind the second and the
    third run again upon it; read as the catalog view."""
    tables = DimensionLog(spark, scratch_path(spark, "dim_patient_log"), si.PATIENT)
    for n, d in ((1, si.D1), (3, si.D2), (2, si.D2), (4, si.D3), (3, si.D3), (4, si.D4)):
        with stored(tables.step(si.patients_snapshot(spark, sf_dir, n), d)) as step:
            tables.store(step, d)
        if n == 2:
            tables.compact()
    return spark.table(tables.create_views("laketide_gold", "dim_patient_log"))


def q_scd2_null_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD4 and SCD5 on snapshots with NULL keys, repeated rows and rows
    that differ for one key: two loads by steps, whose versions must be
    those of the one-pass history (a version of only one side would show as
    a row with ``sides`` 1)."""
    one, two = (si.untidy_snapshot(spark, sf_dir, n) for n in (1, 2))
    tidy1, tidy2 = (S.one_row_per_key(s, si.PATIENT) for s in (one, two))
    steps = S.scd2_apply(S.scd2_apply(None, tidy1, si.PATIENT, si.D1), tidy2, si.PATIENT, si.D2, check_gate=False)
    stacked = one.withColumn("d", F.lit(si.D1)).unionByName(two.withColumn("d", F.lit(si.D2)))
    history = S.scd2_from_snapshots(S.one_row_per_key(stacked, si.PATIENT, "d"), si.PATIENT, "d")
    return (steps.unionByName(history).groupBy(*si.PATIENT.columns)
            .agg(F.count(F.lit(1)).alias("sides")))



def q_scd2_continued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD5 continued from stored state: the first load's open versions and
    three later snapshots in one pass, put into the stored dimension."""
    dim = cut_lineage(S.scd2_apply(None, si.patients_snapshot(spark, sf_dir, 1), si.PATIENT, si.D1), "dim")
    later = si.patient_snapshots(spark, sf_dir, ((2, si.D2), (3, si.D3), (4, si.D4)))
    return S.replace_versions(dim, S.scd2_continue(dim, later, si.PATIENT), si.PATIENT)


def q_scd2_late_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of four snapshots arrives last and is put into its place."""
    stacked = si.patient_snapshots(spark, sf_dir, ((1, si.D1), (3, si.D3), (4, si.D4)))
    dim = cut_lineage(S.scd2_from_snapshots(stacked, si.PATIENT), "dim")
    return S.scd2_splice(dim, si.patients_snapshot(spark, sf_dir, 2), stacked, si.PATIENT, si.D2)


def q_asof_event_date_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN4 by merging: line items, up to 30 days after their ship date,
    against three keys with thousands of versions each."""
    li = si.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"),
        F.date_add(F.to_date("l_shipdate"), (F.col("l_orderkey") % 30).cast("int")).alias("day"))
    return lookup_asof_merge(li, si.tariffs(spark, sf_dir), si.TARIFF, "flag", "day", salt_buckets=16)


# ----------------------------------------------------------------- silver
def q_conform_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLN2 + typing on a raw patients extract derived from customer."""
    return silver.typed_patients(silver.conform_patients(si.raw_patients(spark, sf_dir)))


def q_conform_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLN1 + typing on a raw encounters extract derived from orders."""
    return silver.typed_encounters(silver.conform_encounters(si.raw_encounters(spark, sf_dir)))


def q_silver_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounter rule set (DQ6) counted on the conformed extract."""
    return DQ.quality_counts(silver.conform_encounters(si.raw_encounters(spark, sf_dir)),
                             silver.ENCOUNTER_RULES)


def q_patient_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The patient rule set (DQ6) counted on the conformed extract."""
    return DQ.quality_counts(silver.conform_patients(si.raw_patients(spark, sf_dir)),
                             silver.PATIENT_RULES)



def _day_one(df: DataFrame) -> DataFrame:
    return df.withColumn("partition_date", F.lit(si.D1))


def q_conform_payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLN3 on a raw payers extract derived from supplier."""
    return silver.typed_payers(silver.conform_payers(_day_one(si.raw_payers(spark, sf_dir))))


def q_conform_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLN4 + typing on a raw procedures extract derived from lineitem."""
    return silver.typed_procedures(silver.conform_procedures(_day_one(si.raw_procedures(spark, sf_dir))))


def q_payer_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payer rule set (DQ6) counted on the conformed extract."""
    return DQ.quality_counts(silver.conform_payers(_day_one(si.raw_payers(spark, sf_dir))), silver.PAYER_RULES)


def q_procedure_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The procedure rule set (DQ6) counted on the conformed extract."""
    return DQ.quality_counts(silver.conform_procedures(_day_one(si.raw_procedures(spark, sf_dir))),
                             silver.PROCEDURE_RULES)


def q_gold_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounter fact's declared checks, counted on all dates."""
    return DQ.quality_counts(q_fact_encounter(spark, sf_dir), gold.FACT_ENCOUNTER_RULES)


def _procedure_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by the month in which they were shipped."""
    return si.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("encounter_id"), F.col("l_extendedprice").alias("base_cost_amount"),
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("date"))


# loads of whole months: first and last month
INDEX_LOADS = (("1992-01-01", "1996-12-01"), ("1998-01-01", "2099-12-01"), ("1997-01-01", "1997-12-01"))


def q_gold_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ5 over the whole table on incremental loads: line items loaded in
    three loads of months, the last one late; every load names its orders
    that the table then holds more than once, found in the key index."""
    rows = _procedure_months(spark, sf_dir)
    index = KeyIndex(spark, scratch_path(spark, "key_index"), ["encounter_id"])
    out = None
    for i, (first, last) in enumerate(INDEX_LOADS, 1):
        load = rows.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        found = cut_lineage(index.violations(load, first, last).select(F.lit(i).alias("load"), "*"), "violations")
        index.store(load, first, last)
        out = found if out is None else out.unionByName(found)
    return out


PUBLISHED = ("1992-01-01", "2099-12-01")
REPUBLISHED = ("1995-03-01", "1995-06-01")


def q_publish_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1, SNK3 and DQ4 as write, audit, publish: all orders published by
    month; four months are sent again, first with an order without a price,
    which the audit refuses, then with other prices and an empty month, which
    readers see; a last load is staged and never published."""
    orders = si.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("date"))
    base = scratch_path(spark, "published")
    table = PublishedTable(spark, "published_" + base.rsplit("-", 1)[-1], base)
    rules = DQ.not_null("o_orderkey", "o_totalprice")
    table.load(orders, *PUBLISHED, rules, [["o_orderkey"]])
    again = orders.where(F.col("date").between(*[F.lit(d).cast("date") for d in REPUBLISHED]))
    bad = again.withColumn("o_totalprice", F.when(F.col("o_orderkey") != again.agg(
        F.min("o_orderkey")).first()[0], F.lit(1.0)))
    try:
        table.load(bad, *REPUBLISHED, rules)
    except DQ.QualityError:
        pass
    else:
        raise AssertionError("a failing load was published")
    sent = again.where(F.month("date") != 5).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    table.load(sent, *REPUBLISHED, rules, [["o_orderkey"]])
    table.stage(again.withColumn("o_totalprice", F.lit(0.0)), *REPUBLISHED)
    return table.read().select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), "date")


# ---------------------------------------------------------- whole pipeline
RUN_DAYS = ("1998-03-01", "1998-03-02")


def q_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUN1 end to end on the driver tables: raw CSV extracts of customer,
    supplier, orders and lineitem -> bronze -> silver (cleaned, typed,
    validated) -> SCD-2 dimensions -> point-in-time facts -> daily rollup,
    for two run dates; returns the daily_encounter table."""
    from laketide.plans.run import Layout, run_days
    base = scratch_path(spark, "daily_run")
    raw = si.write_raw_extracts(spark, sf_dir, f"{base}/raw")
    layout = Layout(f"{base}/lake")
    run_days(spark, RUN_DAYS[0], RUN_DAYS[1], raw, layout)
    out = read_table(spark, layout.gold("daily_encounter")).select(
        "date", "dim_patient_key", "dim_payer_key", "encounter_class", "purpose", "total_encounter_num",
        "total_procedure_num", "total_diagnosis_num", *AMOUNTS)
    return _round(out, AMOUNTS)


RANGE = ("1998-03-01", "1998-04-30")
MOVED = "1998-03-21"


def q_daily_run_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUN1 over 61 days in one pass a layer: each raw file read once, the
    patients' second extract valid from the 21st day on, facts looked up in
    the history; returns the daily_encounter table."""
    from laketide.plans.run import Layout, run_range
    base = scratch_path(spark, "daily_run_range")
    raw = si.write_raw_extracts(spark, sf_dir, f"{base}/raw")
    raw["patients"] = {RANGE[0]: raw["patients"], MOVED: raw.pop("patients_later")}
    layout = Layout(f"{base}/lake")
    run_range(spark, *RANGE, raw, layout)
    out = read_table(spark, layout.gold("daily_encounter")).select(
        "date", "dim_patient_key", "dim_payer_key", "encounter_class", "purpose", "total_encounter_num",
        "total_procedure_num", "total_diagnosis_num", *AMOUNTS)
    return _round(out, AMOUNTS)


QUERIES = {
    "scd2_changes": q_scd2_changes,
    "scd2_step": q_scd2_step,
    "scd2_close_open": q_scd2_close_open,
    "scd2_history": q_scd2_history,
    "scd2_iterated": q_scd2_iterated,
    "scd2_continued": q_scd2_continued,
    "scd2_late_snapshot": q_scd2_late_snapshot,
    "last_date": q_last_date,
    "asof_run_date": q_asof_run_date,
    "asof_event_date": q_asof_event_date,
    "asof_event_date_salted": q_asof_event_date_salted,
    "asof_event_date_merge": q_asof_event_date_merge,
    "fact_encounter": q_fact_encounter,
    "fact_procedure": q_fact_procedure,
    "daily_rollup": q_daily_rollup,
    "daily_rollup_joined": q_daily_rollup_joined,
    "daily_rollup_bucketed": q_daily_rollup_bucketed,
    "distinct_reroll": q_distinct_reroll,
    "clean_text": q_clean_text,
    "clean_part_names": q_clean_part_names,
    "title_case": q_title_case,
    "upper_lower_concat": q_upper_lower_concat,
    "decode_labels": q_decode_labels,
    "row_hash": q_row_hash,
    "event_slice": q_event_slice,
    "day_count": q_day_count,
    "date_math": q_date_math,
    "rename_recast": q_rename_recast,
    "quality_counts": q_quality_counts,
    "quality_quarantine": q_quality_quarantine,
    "unique_violations": q_unique_violations,
    "label_quality": q_label_quality,
    "dim_key_unique": q_dim_key_unique,
    "ingest_roundtrip": q_ingest_roundtrip,
    "partition_overwrite": q_partition_overwrite,
    "materialize_modes": q_materialize_modes,
    "materialize_append": q_materialize_append,
    "dimension_versions": q_dimension_versions,
    "dimension_log": q_dimension_log,
    "scd2_null_duplicate_keys": q_scd2_null_duplicate_keys,
    "conform_patients": q_conform_patients,
    "conform_encounters": q_conform_encounters,
    "silver_quality": q_silver_quality,
    "patient_quality": q_patient_quality,
    "conform_payers": q_conform_payers,
    "conform_procedures": q_conform_procedures,
    "payer_quality": q_payer_quality,
    "procedure_quality": q_procedure_quality,
    "gold_uniqueness": q_gold_uniqueness,
    "publish_audited": q_publish_audited,
    "gold_quality": q_gold_quality,
    "daily_run": q_daily_run,
    "daily_run_range": q_daily_run_range,
}
