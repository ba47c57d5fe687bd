"""Raw and silver schemas of the pipeline's four source tables."""

from __future__ import annotations

from laketide.sources.files import string_schema

# Raw CSV columns of the source files (header names).
PATIENTS_RAW = ["Id", "BIRTHDATE", "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "LAST",
                "SUFFIX", "MAIDEN", "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS",
                "CITY", "STATE", "COUNTY", "ZIP"]
PAYERS_RAW = ["Id", "NAME", "ADDRESS", "CITY", "STATE_HEADQUARTERED", "ZIP", "PHONE"]
ENCOUNTERS_RAW = ["Id", "START", "STOP", "PATIENT", "ORGANIZATION", "PAYER", "ENCOUNTERCLASS", "CODE",
                  "DESCRIPTION", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "PAYER_COVERAGE",
                  "REASONCODE", "REASONDESCRIPTION"]
PROCEDURES_RAW = ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST",
                  "REASONCODE", "REASONDESCRIPTION"]

RAW = {
    "patients": PATIENTS_RAW,
    "payers": PAYERS_RAW,
    "encounters": ENCOUNTERS_RAW,
    "procedures": PROCEDURES_RAW,
}


def raw_schema(table: str):
    return string_schema(RAW[table])
