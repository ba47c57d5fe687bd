import pytest
from pyspark.sql import functions as F

from laketide.operators import quality as DQ

RULES = [
    *DQ.not_null("id", "start"),
    DQ.pattern("id", "guid"),
    DQ.typed("start", "timestamp"),
    DQ.typed("cost", "double"),
    DQ.pattern("name", "alphabet"),
    DQ.pattern("born", "date_dmy"),
    DQ.pattern("day", "date_iso"),
]
GUID = "0b5e7a1c-93f2-4d1a-8c3e-1f2a3b4c5d6e"


def data(spark):
    return spark.createDataFrame([
        (GUID, "2022-01-05 23:50:00", "12.5", "Mary-Ann O'Brien", "05-01-1990", "2022-01-05"),
        ("not-a-guid", "2022-01-05T23:50:00Z", "abc", "R2D2", "1990-01-05", "05-01-2022"),
        (None, None, None, None, None, None),
    ], "id string, start string, cost string, name string, born string, day string")


def test_counts_one_pass(spark):
    got = {r.rule: r.failed_rows for r in DQ.quality_counts(data(spark), RULES).collect()}
    assert got == {"id:not_null": 1, "start:not_null": 1, "id:pattern_guid": 1, "start:type_timestamp": 1,
                   "cost:type_double": 1, "name:pattern_alphabet": 1, "born:pattern_date_dmy": 1,
                   "day:pattern_date_iso": 1}


def test_observe_matches_counts(spark):
    df, obs = DQ.observe_quality(data(spark), RULES)
    assert df.count() == 3  # the action that fills the observation
    got = obs.get
    assert got["total_rows"] == 3 and got["id:pattern_guid"] == 1 and got["cost:type_double"] == 1


def test_quarantine_loses_no_rows(spark):
    clean, bad = DQ.quarantine(data(spark), RULES)
    assert clean.count() == 1 and bad.count() == 2
    failures = {r.id: set(r.dq_failures) for r in bad.collect()}
    assert failures[None] == {"id:not_null", "start:not_null"}
    assert "id:pattern_guid" in failures["not-a-guid"]


def test_unique_and_policy(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert [(r.k, r.n_rows) for r in DQ.unique_violations(df, ["k"]).collect()] == [(1, 2)]
    assert DQ.check({"total_rows": 3, "r": 0}, "fail") == {}
    with pytest.raises(DQ.QualityError):
        DQ.check({"r": 2}, "fail")
    assert DQ.check({"r": 2}, "report") == {"r": 2}


def test_in_set(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    r = DQ.quality_counts(df, [DQ.Rule("c", "in_set", ("a", "b"))]).first()
    assert (r.failed_rows, r.total_rows) == (1, 3)
    assert df.select(F.lit(1)).count() == 3
