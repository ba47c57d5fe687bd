import datetime as dt

from pyspark.sql import functions as F

from laketide.operators import scd2 as S
from laketide.operators.asof import lookup_asof
from laketide.operators.rollup import daily_rollup, daily_rollup_joined
from laketide.plans import gold

PSPEC = S.DimSpec("patient_id", ("name",), surrogate_key="dim_patient_key")
YSPEC = S.DimSpec("payer_id", ("pname",), surrogate_key="dim_payer_key")
D1, D2 = dt.date(2022, 1, 2), dt.date(2022, 1, 4)

ENC_SCHEMA = ("encounter_id string, patient_id string, payer_id string, start_time timestamp, "
              "stop_time timestamp, encounter_class string, code string, description string, "
              "base_cost_amount double, claim_amount double, coverage_amount double, "
              "reason_code string, reason_description string")
PROC_SCHEMA = ("start_time timestamp, stop_time timestamp, patient_id string, encounter_id string, "
               "code string, description string, base_cost_amount double, reason_code string, "
               "reason_description string")


def ts(s):
    return dt.datetime.fromisoformat(s)


def dims(spark):
    p1 = spark.createDataFrame([("p1", "Ann"), ("p2", "Bob")], "patient_id string, name string")
    p2 = spark.createDataFrame([("p1", "Anne"), ("p2", "Bob")], "patient_id string, name string")
    dp = S.scd2_apply(S.scd2_apply(None, p1, PSPEC, D1), p2, PSPEC, D2)
    dy = S.scd2_apply(None, spark.createDataFrame([("y1", "Pay")], "payer_id string, pname string"), YSPEC, D1)
    return dp, dy


def encounters(spark):
    return spark.createDataFrame([
        # before the first dimension version -> NULL keys
        ("e0", "p1", "y1", ts("2022-01-01 10:00"), ts("2022-01-01 11:00"), "A", "c", "d0", 1.0, 10.0, 4.0, None, None),
        ("e1", "p1", "y1", ts("2022-01-03 10:00"), ts("2022-01-03 11:00"), "A", "c", "d1", 1.0, 10.0, 4.0, "r", "why"),
        ("e2", "p1", "y1", ts("2022-01-03 12:00"), ts("2022-01-03 13:00"), "A", "c", "d1", 1.0, 5.0, 1.0, "r", "why"),
        # spans midnight into D2 (new patient version valid)
        ("e3", "p1", "y1", ts("2022-01-03 23:50"), ts("2022-01-04 00:10"), "A", "c", "d3", 1.0, 7.0, 0.0, None, None),
        # unknown patient
        ("e4", "px", "y1", ts("2022-01-04 09:00"), ts("2022-01-04 09:30"), "B", "c", "d4", 1.0, 3.0, 3.0, None, None),
        # still open: no stop time -> not in the fact yet
        ("e5", "p2", "y1", ts("2022-01-04 09:00"), None, "B", "c", "d5", 1.0, 3.0, 3.0, None, None),
    ], ENC_SCHEMA)


def procedures(spark):
    return spark.createDataFrame([
        (ts("2022-01-03 10:10"), ts("2022-01-03 10:40"), "p1", "e1", "x1", "pr", 1.0, None, None),
        (ts("2022-01-03 10:20"), ts("2022-01-03 10:50"), "p1", "e1", None, "pr", 1.0, None, None),
        (ts("2022-01-03 10:30"), ts("2022-01-03 10:45"), "p1", "e1", "x3", "pr", 1.0, None, None),
        (ts("2022-01-03 12:10"), ts("2022-01-03 12:40"), "p1", "e2", "x1", "pr", 1.0, None, None),
        # procedure of e2 stopping on another date: not joined to e2's date
        (ts("2022-01-03 23:30"), ts("2022-01-04 00:30"), "p1", "e2", "x1", "pr", 1.0, None, None),
    ], PROC_SCHEMA)


def keyed(dp, dy):
    pk = {(r.patient_id, r.start_date): r.dim_patient_key for r in dp.collect()}
    yk = {r.payer_id: r.dim_payer_key for r in dy.collect()}
    return pk, yk


def test_fact_encounter_point_in_time(spark):
    dp, dy = dims(spark)
    pk, yk = keyed(dp, dy)
    fe = gold.fact_encounter(encounters(spark), dp, dy, patient=PSPEC, payer=YSPEC)
    got = {r.encounter_id: (r.date, r.dim_patient_key, r.dim_payer_key, r.length_of_stay_num,
                            r.patient_pay_amount) for r in fe.collect()}
    assert got == {
        "e0": (dt.date(2022, 1, 1), None, None, 0, 6.0),
        "e1": (dt.date(2022, 1, 3), pk[("p1", D1)], yk["y1"], 0, 6.0),
        "e2": (dt.date(2022, 1, 3), pk[("p1", D1)], yk["y1"], 0, 4.0),
        "e3": (dt.date(2022, 1, 4), pk[("p1", D2)], yk["y1"], 1, 7.0),
        "e4": (dt.date(2022, 1, 4), None, yk["y1"], 0, 0.0),
    }
    assert fe.columns == gold.FACT_ENCOUNTER_COLUMNS


def test_daily_fact_equals_slice_of_all_dates(spark):
    dp, dy = dims(spark)
    allf = gold.fact_encounter(encounters(spark), dp, dy, patient=PSPEC, payer=YSPEC)
    for d in (dt.date(2022, 1, 3), dt.date(2022, 1, 4)):
        day = gold.fact_encounter(encounters(spark), dp, dy, d, patient=PSPEC, payer=YSPEC)
        assert sorted(map(tuple, day.collect())) == sorted(map(tuple, allf.where(F.col("date") == d).collect()))


def test_salted_lookup_equals_plain(spark):
    dp, _ = dims(spark)
    enc = encounters(spark).select("encounter_id", "patient_id", F.to_date("start_time").alias("d"))
    plain = lookup_asof(enc, dp, PSPEC, "patient_id", "d")
    salted = lookup_asof(enc, dp, PSPEC, "patient_id", "d", salt_buckets=4)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, salted.collect()), key=repr)
    assert plain.count() == enc.count()


def test_fact_procedure_duration(spark):
    dp, _ = dims(spark)
    fp = gold.fact_procedure(procedures(spark), dp, patient=PSPEC)
    assert fp.count() == 5
    assert sorted(r.duration_minute_num for r in fp.collect()) == [15.0, 30.0, 30.0, 30.0, 60.0]
    assert fp.columns == gold.FACT_PROCEDURE_COLUMNS


def test_rollup_pre_aggregated_vs_joined(spark):
    dp, dy = dims(spark)
    fe = gold.fact_encounter(encounters(spark), dp, dy, patient=PSPEC, payer=YSPEC)
    fp = gold.fact_procedure(procedures(spark), dp, patient=PSPEC)
    day = dt.date(2022, 1, 3)
    r1 = daily_rollup(fe, fp, day).collect()
    r2 = daily_rollup_joined(fe, fp, day).collect()
    assert len(r1) == len(r2) == 1
    a, b = r1[0], r2[0]
    assert (a.purpose, a.total_encounter_num, a.total_procedure_num, a.total_diagnosis_num) == ("why", 2, 4, 3)
    assert a.total_claim_amount == 15.0          # each encounter once
    assert b.total_claim_amount == 10.0 * 3 + 5.0  # repeated per procedure
    assert (b.total_procedure_num, b.total_diagnosis_num) == (4, 3)
    # rollup sums equal fact sums
    tot = fe.where(F.col("date") == day).agg(F.sum("claim_amount")).first()[0]
    assert a.total_claim_amount == tot


def test_rollup_zero_procedures_and_purpose_fallback(spark):
    dp, dy = dims(spark)
    fe = gold.fact_encounter(encounters(spark), dp, dy, patient=PSPEC, payer=YSPEC)
    fp = gold.fact_procedure(procedures(spark), dp, patient=PSPEC)
    r = {(x.purpose, x.encounter_class): x for x in daily_rollup(fe, fp, dt.date(2022, 1, 4)).collect()}
    assert set(r) == {("d3", "A"), ("d4", "B")}
    assert r[("d3", "A")].total_procedure_num == 0 and r[("d3", "A")].total_encounter_num == 1
