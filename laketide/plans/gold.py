"""Gold layer: SCD-2 dimensions, point-in-time facts, daily rollup
(FCT1, FCT2, RLP1, RLP2 over SCD4 / PIT1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.functions.dates import days_between, minutes_between, run_date, to_day
from laketide.operators.asof import lookup_asof
from laketide.operators.rollup import daily_rollup, daily_rollup_joined  # noqa: F401
from laketide.operators.quality import not_null
from laketide.operators.scd2 import DimSpec

PATIENT_ATTRIBUTES = ("patient_fullname", "birth_date", "death_date", "marital_status", "race",
                      "ethnicity", "gender", "birth_place", "address", "city", "state", "county", "zip")
PAYER_ATTRIBUTES = ("payer_name", "address", "city", "zip")

DIM_PATIENT = DimSpec("patient_id", PATIENT_ATTRIBUTES, surrogate_key="dim_patient_key")
DIM_PAYER = DimSpec("payer_id", PAYER_ATTRIBUTES, surrogate_key="dim_payer_key")

FACT_ENCOUNTER_COLUMNS = [
    "date", "encounter_id", "dim_patient_key", "dim_payer_key", "encounter_class", "code",
    "description", "reason_code", "reason_description", "start_time", "stop_time",
    "base_cost_amount", "claim_amount", "coverage_amount", "patient_pay_amount",
    "length_of_stay_num"]
FACT_PROCEDURE_COLUMNS = [
    "date", "encounter_id", "code", "dim_patient_key", "description", "reason_code",
    "reason_description", "start_time", "stop_time", "base_cost_amount", "duration_minute_num"]


def _fact_slice(events: DataFrame, d, part_col: str = "partition_date") -> DataFrame:
    """Rows that belong to the fact: an event belongs to its stop date.

    Daily (``d`` given): stop date = d, read from the d partition when the
    input is a date-partitioned silver table.  All dates (``d`` None):
    every event with a stop time, once (on a silver table, the copy in its
    stop-date partition).
    """
    day = to_day("stop_time")
    if d is not None:
        lit = F.lit(run_date(d))
        cond = day == lit
        if part_col in events.columns:
            cond = cond & (F.col(part_col) == lit)
        return events.where(cond).withColumn("date", lit)
    cond = day.isNotNull()
    if part_col in events.columns:
        cond = cond & (F.col(part_col) == day)
    return events.where(cond).withColumn("date", day)


def fact_encounter(encounters: DataFrame, dim_patient: DataFrame, dim_payer: DataFrame, d=None,
                   *, patient: DimSpec = DIM_PATIENT, payer: DimSpec = DIM_PAYER,
                   salt_buckets: int | None = None) -> DataFrame:
    """Encounter fact: one row per encounter on its stop date, with the
    patient and payer versions valid on that date (FCT1).

    ``d`` given: the daily load (lookup at the run date).  ``d`` None: all
    dates in one plan (lookup at each row's date), equal to the union of
    the daily loads.
    """
    fe = _fact_slice(encounters, d)
    as_of = "date" if d is None else d
    fe = lookup_asof(fe, dim_patient, patient, "patient_id", as_of,
                     salt_buckets=salt_buckets)
    fe = lookup_asof(fe, dim_payer, payer, "payer_id", as_of,
                     salt_buckets=salt_buckets)
    return fe.select(
        "date", "encounter_id", "dim_patient_key", "dim_payer_key", "encounter_class", "code",
        "description", "reason_code", "reason_description", "start_time", "stop_time",
        "base_cost_amount", "claim_amount", "coverage_amount",
        (F.col("claim_amount") - F.col("coverage_amount")).alias("patient_pay_amount"),
        days_between("stop_time", "start_time").alias("length_of_stay_num"))


def fact_procedure(procedures: DataFrame, dim_patient: DataFrame, d=None,
                   *, patient: DimSpec = DIM_PATIENT,
                   salt_buckets: int | None = None) -> DataFrame:
    """Procedure fact: one row per procedure on its stop date, with the
    patient version valid on that date (FCT2)."""
    fp = _fact_slice(procedures, d)
    as_of = "date" if d is None else d
    fp = lookup_asof(fp, dim_patient, patient, "patient_id", as_of,
                     salt_buckets=salt_buckets)
    return fp.select(
        "date", "encounter_id", "code", "dim_patient_key", "description", "reason_code",
        "reason_description", "start_time", "stop_time", "base_cost_amount",
        minutes_between("stop_time", "start_time").alias("duration_minute_num"))


# Table checks the original declared for the gold tables (run here, on the
# partition each load writes).
FACT_ENCOUNTER_RULES = not_null("date", "encounter_id", "dim_patient_key", "dim_payer_key",
                                "encounter_class", "start_time", "base_cost_amount",
                                "length_of_stay_num")
FACT_PROCEDURE_RULES = not_null("date", "encounter_id", "code", "dim_patient_key", "start_time",
                                "base_cost_amount", "duration_minute_num")
DAILY_ENCOUNTER_RULES = not_null("date", "dim_patient_key", "dim_payer_key")
GOLD_RULES = {"fact_encounter": FACT_ENCOUNTER_RULES, "fact_procedure": FACT_PROCEDURE_RULES,
              "daily_encounter": DAILY_ENCOUNTER_RULES}
UNIQUE_KEYS = {"fact_encounter": [["encounter_id"]]}
DIMENSION_RULES = {
    "dim_patient": not_null("dim_patient_key", "patient_id", "patient_fullname", "birth_date", "start_date"),
    "dim_payer": not_null("dim_payer_key", "payer_id", "payer_name", "start_date")}
