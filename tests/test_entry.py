"""Driver contract: entry() smoke, every query against its DuckDB oracle
on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["date", "dim_patient_key", "dim_payer_key", "encounter_class", "purpose",
                          "total_encounter_num", "total_procedure_num", "total_diagnosis_num",
                          "total_claim_amount", "total_coverage_amount", "total_patient_pay_amount"]


def test_every_query_has_an_oracle():
    # the optional training-data queries have SQL where SQL can express them
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle(spark):
    res = compare(spark, SF, verbose=True)
    bad = {k: v for k, v in res.items() if v != "OK"}
    assert not bad, bad
