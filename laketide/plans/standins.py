"""The driver's tables standing in for the pipeline's tables.

The original raw files are not shipped, so the TPC-H-style tables play
their parts (mapping in FIXTURES.md): customer = patients, supplier =
payers, orders = encounters, lineitem = procedures.  Every stand-in is a
plain projection or join of whole driver tables, so its work grows with
them.  The modulo expressions only derive attribute values (payer of an
encounter, length of stay, a changed segment); no row is filtered away to
make a check cheaper, except the snapshot that deliberately misses some
keys.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laketide.functions.hashing import surrogate_key
from laketide.operators.scd2 import DimSpec, scd2_apply
from laketide.session import cut_lineage

# Fixed values of the stand-in scenario: snapshot dates.
D1 = _dt.date(1996, 1, 1)
D2 = _dt.date(1998, 1, 1)
D3 = _dt.date(2000, 1, 1)
D4 = _dt.date(2000, 6, 1)

PATIENT = DimSpec("patient_id", ("patient_fullname", "nation_key", "balance", "segment"),
                  surrogate_key="dim_patient_key")
PAYER = DimSpec("payer_id", ("payer_name", "nation_key", "balance"), surrogate_key="dim_payer_key")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- patients
def _patients_base(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("patient_fullname"),
                    F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"),
                    F.col("c_mktsegment").alias("segment"))


def patients_snapshot(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Snapshot 1: customers as they are.  Snapshot 2: every 10th key moves
    to MACHINERY, every 97th key is missing, every 50th key gets a new twin
    key (-k - 1, so that no twin is a customer).  Snapshot 3: the missing keys return, every 20th key moves back
    (A -> B -> A), every 7th key changes nation, the twins of every 100th
    key are gone.  Snapshot 4: customers as they are, but every 6th key in
    HOUSEHOLD; every 89th key is missing."""
    base = _patients_base(spark, sf_dir)
    k = F.col("patient_id")
    if n == 1:
        return base
    if n == 2:
        moved = base.withColumn("segment", F.when(k % 10 == 0, F.lit("MACHINERY")).otherwise(F.col("segment")))
        kept = moved.where(k % 97 != 0)
        twins = base.where(k % 50 == 0).withColumn("patient_id", -k - 1)
        return kept.unionByName(twins)
    if n == 3:
        seg = F.when((k % 10 == 0) & (k % 20 != 0), F.lit("MACHINERY")).otherwise(F.col("segment"))
        nat = F.when(k % 7 == 0, F.col("nation_key") + 1).otherwise(F.col("nation_key"))
        main = base.withColumn("segment", seg).withColumn("nation_key", nat)
        twins = (base.where((k % 50 == 0) & (k % 100 != 0))
                 .withColumn("patient_id", -k - 1))
        return main.unionByName(twins)
    if n == 4:
        return (base.where(k % 89 != 0)
                .withColumn("segment", F.when(k % 6 == 0, F.lit("HOUSEHOLD")).otherwise(F.col("segment"))))
    raise ValueError("snapshot number must be 1 to 4")


def untidy_snapshot(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Snapshot ``n`` with every 13th key NULL, every 17th row twice, and for
    every 11th key a second row with another segment and balance."""
    s = patients_snapshot(spark, sf_dir, n)
    k = F.col("patient_id")
    other = s.where(k % 11 == 0).withColumn("segment", F.lit("ANY")).withColumn("balance", F.col("balance") - n + 1)
    return (s.unionByName(s.where(k % 17 == 0)).unionByName(other)
            .withColumn("patient_id", F.when(k % 13 != 0, k)))


def patient_snapshots(spark: SparkSession, sf_dir: str, which=((1, D1), (2, D2), (3, D3))) -> DataFrame:
    """Snapshots stacked, with their dates (input of SCD5)."""
    parts = [patients_snapshot(spark, sf_dir, i).withColumn("snapshot_date", F.lit(d)) for i, d in which]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dim_patient(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    """Patient dimension after the loads of D1 and D2 (SCD4 twice).

    In the pipeline a dimension is read from storage; here it is derived
    from the driver tables, so it is written once to the shared checkpoint
    folder and every consumer reads that copy instead of re-deriving it.
    """
    dim = scd2_apply(None, patients_snapshot(spark, sf_dir, 1), PATIENT, D1)
    dim = scd2_apply(dim, patients_snapshot(spark, sf_dir, 2), PATIENT, D2, check_gate=False)
    return cut_lineage(dim, "dim_patient") if materialized else dim


TARIFF = DimSpec("flag", ("quantity",), surrogate_key="tariff_key")


def tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension of few keys and thousands of versions: a version of every
    return flag for each ship date, valid until the next but gone every
    eleventh day."""
    li = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    own = li.groupBy(F.col("l_returnflag").alias("flag"), day.alias("start_date")).agg(F.sum("l_quantity").alias("quantity"))
    w = Window.partitionBy("flag").orderBy("start_date")
    end = F.lead("start_date").over(w)
    gone = F.dayofyear("start_date") % 11 == 0
    return (own.withColumn("end_date", F.when(gone, F.col("start_date")).otherwise(end))
            .select(surrogate_key(F.col("flag"), F.col("start_date")).alias("tariff_key"), "flag", "quantity",
                    "start_date", "end_date", F.col("end_date").isNull().alias("is_active")))


def payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("payer_id"), F.col("s_name").alias("payer_name"),
                    F.col("s_nationkey").alias("nation_key"), F.col("s_acctbal").alias("balance"))


def dim_payer(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    dim = scd2_apply(None, payers(spark, sf_dir), PAYER, D1)
    return cut_lineage(dim, "dim_payer") if materialized else dim


# -------------------------------------------------------------- encounters
def _minutes_after(ts, minutes):
    return F.timestamp_add("MINUTE", minutes, ts)


def encounters(spark: SparkSession, sf_dir: str, coarse: bool = False, hot: bool = False) -> DataFrame:
    """Orders as encounters (silver shape).

    coarse=True is the rollup variant: start at the quarter of the order
    date; hot=True the skewed one: 5 patients and 2 payers hold all
    encounters, so rollup groups hold several of them.
    """
    o = table(spark, sf_dir, "orders")
    n_payers = 2 if hot else table(spark, sf_dir, "supplier").count()  # one value to the driver
    key = F.col("o_orderkey")
    start = F.date_trunc("quarter", F.col("o_orderdate")) if coarse else F.col("o_orderdate")
    patient = (F.col("o_custkey") % 5) if hot else F.col("o_custkey")
    stop = _minutes_after(start, (key % 4) * 1440 + key % 1440)
    no_reason = key % 3 == 0
    return o.select(
        key.alias("encounter_id"),
        patient.alias("patient_id"),
        (key % F.lit(n_payers)).alias("payer_id"),
        start.alias("start_time"),
        stop.alias("stop_time"),
        F.col("o_orderstatus").alias("encounter_class"),
        F.concat(F.lit("C"), (key % 50).cast("string")).alias("code"),
        F.col("o_orderpriority").alias("description"),
        (F.col("o_totalprice") / 2).alias("base_cost_amount"),
        F.col("o_totalprice").alias("claim_amount"),
        # k/10 of the claim, in whole cents (an exact two-decimal amount)
        (F.floor(F.round(F.col("o_totalprice") * 100).cast("long") * (key % 10) / 10) / 100)
        .alias("coverage_amount"),
        F.when(~no_reason, F.concat(F.lit("R"), (key % 7).cast("string"))).alias("reason_code"),
        F.when(~no_reason, F.concat(F.lit("reason "), (key % 7).cast("string"))).alias("reason_description"),
    )


def procedures(spark: SparkSession, sf_dir: str, coarse: bool = False, hot: bool = False) -> DataFrame:
    """Line items as procedures of their order's encounter.

    The procedure starts when its encounter stops and lasts l_quantity
    minutes (a day more for line 7, so its date differs from the
    encounter's); returned lines ('R') have no code.
    """
    li = table(spark, sf_dir, "lineitem")
    enc = encounters(spark, sf_dir, coarse, hot).select("encounter_id", "patient_id",
                                                   F.col("stop_time").alias("_enc_stop"),
                                                   "reason_code", "reason_description")
    j = li.join(enc, li["l_orderkey"] == enc["encounter_id"], "inner")
    mins = F.floor("l_quantity").cast("int") + F.when(F.col("l_linenumber") == 7, F.lit(1440)).otherwise(F.lit(0))
    return j.select(
        F.col("_enc_stop").alias("start_time"),
        _minutes_after(F.col("_enc_stop"), mins).alias("stop_time"),
        "patient_id", "encounter_id",
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string")).alias("code"),
        F.concat(F.lit("procedure "), F.col("l_linenumber").cast("string")).alias("description"),
        F.col("l_extendedprice").alias("base_cost_amount"),
        "reason_code", "reason_description",
    )


# ------------------------------------------------- raw (bronze) stand-ins
def guid(c) -> "F.Column":
    """A GUID-shaped id derived from a key: MD5 hex split 8-4-4-4-12."""
    h = F.md5(c.cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def raw_patients(spark: SparkSession, sf_dir: str, d=D1) -> DataFrame:
    """customer as a raw patients extract: all text, with the quirks the
    silver stage must handle (upper/lower case names, day-first dates,
    unknown codes, non-ASCII text, blank padding)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    k = F.col("c_custkey")
    birth = F.date_add(F.lit("1940-01-01").cast("date"), (k % 20000).cast("int"))
    return j.select(
        F.upper(guid(k)).alias("Id"),
        F.date_format(birth, "dd-MM-yyyy").alias("BIRTHDATE"),
        F.when(k % 10 == 0, F.date_format(F.date_add(birth, 25000), "dd-MM-yyyy")).alias("DEATHDATE"),
        F.lower(F.col("c_mktsegment")).alias("FIRST"),
        F.col("c_name").alias("LAST"),
        F.substring(F.lit("MSDX"), (k % 4 + 1).cast("int"), 1).alias("MARITAL"),
        F.concat(F.lit("race "), F.col("c_nationkey").cast("string")).alias("RACE"),
        F.when(k % 2 == 0, F.lit("nonhispanic")).otherwise(F.lit("hispanic")).alias("ETHNICITY"),
        F.substring(F.lit("FMx"), (k % 3 + 1).cast("int"), 1).alias("GENDER"),
        F.concat(F.lit("  Zürich-"), F.col("n_name")).alias("BIRTHPLACE"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St. #"), (k % 7).cast("string")).alias("ADDRESS"),
        F.lower(F.col("n_name")).alias("CITY"),
        F.lit("ST").alias("STATE"),
        F.lit("County (€)").alias("COUNTY"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("ZIP"),
        F.lit(d).alias("partition_date"),
    )


def raw_patients_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later raw patients extract: every 10th patient has moved, every 97th
    is missing."""
    k = F.regexp_extract("ADDRESS", r"^\d+", 0).cast("long")
    moved = F.when(k % 10 == 0, F.concat("ADDRESS", F.lit(" rear"))).otherwise(F.col("ADDRESS"))
    return raw_patients(spark, sf_dir).where(k % 97 != 0).withColumn("ADDRESS", moved)


def odd_code(k) -> "F.Column":
    """The code, for some keys with a sign that codes may hold (a hyphen) or
    may not hold (a slash, a star)."""
    return (F.when(k % 17 == 0, F.concat("code", F.lit("/*")))
            .when(k % 19 == 0, F.concat("code", F.lit("-2"))).otherwise(F.col("code")))


def raw_encounters(spark: SparkSession, sf_dir: str, d=D1) -> DataFrame:
    """orders as a raw encounters extract (text times and amounts; every
    13th coverage is not a number)."""
    e = encounters(spark, sf_dir)
    k = F.col("encounter_id")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return e.select(
        guid(k).alias("Id"),
        F.date_format("start_time", fmt).alias("START"),
        F.date_format("stop_time", fmt).alias("STOP"),
        guid(F.col("patient_id")).alias("PATIENT"),
        guid(F.col("payer_id")).alias("PAYER"),
        F.lower(F.col("encounter_class")).alias("ENCOUNTERCLASS"),
        odd_code(k).alias("CODE"),
        F.col("description").alias("DESCRIPTION"),
        F.col("base_cost_amount").cast("string").alias("BASE_ENCOUNTER_COST"),
        F.col("claim_amount").cast("string").alias("TOTAL_CLAIM_COST"),
        F.when(k % 13 == 0, F.lit("n/a")).otherwise(F.col("coverage_amount").cast("string")).alias("PAYER_COVERAGE"),
        F.col("reason_code").alias("REASONCODE"),
        F.col("reason_description").alias("REASONDESCRIPTION"),
        F.lit(d).alias("partition_date"),
    )


def raw_payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(guid(F.col("s_suppkey")).alias("Id"), F.col("s_name").alias("NAME"),
                    F.concat(F.col("s_suppkey").cast("string"), F.lit(" Payer Road")).alias("ADDRESS"),
                    F.lit("Baltimore").alias("CITY"),
                    F.lpad((F.col("s_suppkey") % 100000).cast("string"), 5, "0").alias("ZIP"))


def raw_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = procedures(spark, sf_dir)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return p.select(
        F.date_format("start_time", fmt).alias("START"),
        F.date_format("stop_time", fmt).alias("STOP"),
        guid(F.col("patient_id")).alias("PATIENT"),
        guid(F.col("encounter_id")).alias("ENCOUNTER"),
        odd_code(F.col("encounter_id")).alias("CODE"),
        F.col("description").alias("DESCRIPTION"),
        F.when(F.col("encounter_id") % 29 != 0, F.col("base_cost_amount").cast("string")).alias("BASE_COST"),
        F.col("reason_code").alias("REASONCODE"),
        F.col("reason_description").alias("REASONDESCRIPTION"),
    )


def write_raw_extracts(spark: SparkSession, sf_dir: str, base: str) -> dict[str, str]:
    """Write the four raw source files (CSV with header, the source
    column layout, all text, gzip: a file a task) derived from the driver
    tables."""
    from laketide.sources.schemas import RAW
    frames = {"patients": raw_patients(spark, sf_dir).drop("partition_date"),
              "patients_later": raw_patients_later(spark, sf_dir).drop("partition_date"),
              "payers": raw_payers(spark, sf_dir),
              "encounters": raw_encounters(spark, sf_dir).drop("partition_date"),
              "procedures": raw_procedures(spark, sf_dir)}
    paths = {}
    for name, df in frames.items():
        cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in RAW[name.split("_")[0]]]
        paths[name] = f"{base.rstrip('/')}/{name}"
        df.select(*cols).write.option("header", True).option("compression", "gzip").csv(paths[name])
    return paths
