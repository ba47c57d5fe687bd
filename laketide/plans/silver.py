"""Silver layer: clean, rename, type and validate (CLN1-CLN4, DQ6).

Each ``conform_*`` is a single projection of the bronze slice: text
columns cleaned and renamed (the form the rules check), ids trimmed and
lower-cased (never stripped of their dashes).  ``typed_*`` then parses
times, dates and amounts with ``try_*`` forms, so malformed input becomes
NULL and is counted by the rules instead of failing the job.  Rules,
conform and typing run in one pass over the slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.functions.dates import (
    DATE_DMY_FORMAT, DATE_ISO_FORMAT, parse_date, parse_double, parse_timestamp,
)
from laketide.functions.decode import gender, marital_status
from laketide.functions.text import clean_string, full_name, title_case, upper_case
from laketide.operators.quality import Rule, not_null, pattern, typed

PART_COL = "partition_date"


def clean_id(c) -> Column:
    """Ids: trimmed and lower-cased; the GUID rule checks them."""
    return F.lower(F.trim(F.col(c)))


def conform_encounters(b: DataFrame) -> DataFrame:
    """CLN1."""
    return b.select(
        clean_id("Id").alias("encounter_id"),
        F.trim("START").alias("start_time"),
        F.trim("STOP").alias("stop_time"),
        clean_id("PATIENT").alias("patient_id"),
        clean_id("PAYER").alias("payer_id"),
        upper_case("ENCOUNTERCLASS").alias("encounter_class"),
        F.col("CODE").alias("code"),
        clean_string("DESCRIPTION").alias("description"),
        F.trim("BASE_ENCOUNTER_COST").alias("base_cost_amount"),
        F.trim("TOTAL_CLAIM_COST").alias("claim_amount"),
        F.trim("PAYER_COVERAGE").alias("coverage_amount"),
        F.col("REASONCODE").alias("reason_code"),
        clean_string("REASONDESCRIPTION").alias("reason_description"),
        PART_COL)


def conform_patients(b: DataFrame) -> DataFrame:
    """CLN2.  Full name = title-cased first and last name, blank-joined."""
    return b.select(
        clean_id("Id").alias("patient_id"),
        full_name(title_case("FIRST"), title_case("LAST")).alias("patient_fullname"),
        F.trim("BIRTHDATE").alias("birth_date"),
        F.trim("DEATHDATE").alias("death_date"),
        marital_status("MARITAL").alias("marital_status"),
        clean_string("RACE").alias("race"),
        clean_string("ETHNICITY").alias("ethnicity"),
        gender("GENDER").alias("gender"),
        clean_string("BIRTHPLACE").alias("birth_place"),
        clean_string("ADDRESS").alias("address"),
        clean_string("CITY").alias("city"),
        clean_string("STATE").alias("state"),
        clean_string("COUNTY").alias("county"),
        clean_string("ZIP").alias("zip"),
        PART_COL)


def conform_payers(b: DataFrame) -> DataFrame:
    """CLN3 (the payer name is kept as given)."""
    return b.select(
        clean_id("Id").alias("payer_id"),
        F.col("NAME").alias("payer_name"),
        clean_string("ADDRESS").alias("address"),
        clean_string("CITY").alias("city"),
        clean_string("ZIP").alias("zip"),
        PART_COL)


def conform_procedures(b: DataFrame) -> DataFrame:
    """CLN4."""
    return b.select(
        F.trim("START").alias("start_time"),
        F.trim("STOP").alias("stop_time"),
        clean_id("PATIENT").alias("patient_id"),
        clean_id("ENCOUNTER").alias("encounter_id"),
        F.col("CODE").alias("code"),
        clean_string("DESCRIPTION").alias("description"),
        F.trim("BASE_COST").alias("base_cost_amount"),
        F.col("REASONCODE").alias("reason_code"),
        clean_string("REASONDESCRIPTION").alias("reason_description"),
        PART_COL)


def _ts(c):
    return parse_timestamp(c).cast("timestamp").alias(c)


def typed_encounters(s: DataFrame) -> DataFrame:
    return s.select("encounter_id", _ts("start_time"), _ts("stop_time"), "patient_id", "payer_id",
                    "encounter_class", "code", "description",
                    parse_double("base_cost_amount").alias("base_cost_amount"),
                    parse_double("claim_amount").alias("claim_amount"),
                    parse_double("coverage_amount").alias("coverage_amount"),
                    "reason_code", "reason_description", PART_COL)


def typed_patients(s: DataFrame) -> DataFrame:
    def dmy(c):
        return F.coalesce(parse_date(c, DATE_DMY_FORMAT), parse_date(c, DATE_ISO_FORMAT)).alias(c)
    cols = [dmy(c) if c in ("birth_date", "death_date") else F.col(c) for c in s.columns]
    return s.select(*cols)


def typed_payers(s: DataFrame) -> DataFrame:
    return s


def typed_procedures(s: DataFrame) -> DataFrame:
    return s.select(_ts("start_time"), _ts("stop_time"), "patient_id", "encounter_id", "code",
                    "description", parse_double("base_cost_amount").alias("base_cost_amount"),
                    "reason_code", "reason_description", PART_COL)


# Rule sets (DQ6): what the original declared, with the value rules really
# applied and the date rules bound to the right formats.
ENCOUNTER_RULES: list[Rule] = [
    *not_null("encounter_id", "patient_id", "payer_id", "start_time", "stop_time",
              "base_cost_amount", "claim_amount", "coverage_amount"),
    pattern("encounter_id", "guid"), pattern("patient_id", "guid"), pattern("payer_id", "guid"),
    typed("start_time", "timestamp"), typed("stop_time", "timestamp"),
    pattern("encounter_class", "alphabet"),
    pattern("code", "alphanumeric"), pattern("reason_code", "alphanumeric"),
    typed("base_cost_amount", "double"), typed("claim_amount", "double"),
    typed("coverage_amount", "double"),
]
PATIENT_RULES: list[Rule] = [
    *not_null("patient_id", "patient_fullname", "birth_date", "city", "state", "county", PART_COL),
    pattern("patient_id", "guid"), pattern("patient_fullname", "alphabet"),
    pattern("birth_date", "date_dmy"), pattern("death_date", "date_dmy"),
    pattern("ethnicity", "alphabet"), pattern("gender", "alphabet"), pattern("birth_place", "alphabet"),
    pattern(PART_COL, "date_iso"),
]
PAYER_RULES: list[Rule] = [
    *not_null("payer_id", "payer_name"),
    pattern("payer_id", "guid"), pattern("payer_name", "alphabet"),
]
PROCEDURE_RULES: list[Rule] = [
    *not_null("start_time", "stop_time", "patient_id", "encounter_id", "base_cost_amount"),
    typed("start_time", "timestamp"), typed("stop_time", "timestamp"),
    pattern("patient_id", "guid"), pattern("encounter_id", "guid"),
    pattern("code", "alphanumeric"), pattern("reason_code", "alphanumeric"),
    typed("base_cost_amount", "double"),
]

STAGES = {
    "encounters": (conform_encounters, typed_encounters, ENCOUNTER_RULES),
    "patients": (conform_patients, typed_patients, PATIENT_RULES),
    "payers": (conform_payers, typed_payers, PAYER_RULES),
    "procedures": (conform_procedures, typed_procedures, PROCEDURE_RULES),
}
