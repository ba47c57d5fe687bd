"""End-to-end daily runs from hand-made raw CSV files."""

import csv
import datetime as dt

from pyspark.sql import functions as F

import pytest

from laketide.operators.quality import QualityError, at_most_one_active
from laketide.plans.run import DayReport, Layout, dimension, publish_gold, run_bronze, run_day, run_dimensions, run_facts, run_silver
from laketide.sources.schemas import RAW
from laketide.sources.tables import read_table, table_exists

P1, P2 = "11111111-1111-4111-8111-111111111111", "22222222-2222-4222-8222-222222222222"
Y1 = "aaaaaaaa-aaaa-4aaa-8aaa-aaaaaaaaaaaa"
E = [f"{i}eeeeeee-eeee-4eee-8eee-eeeeeeeeeeee" for i in range(5)]
D1, D2, D3 = dt.date(2022, 1, 1), dt.date(2022, 1, 2), dt.date(2022, 1, 3)


def write_csv(path, table, rows):
    cols = RAW[table]
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, fieldnames=cols)
        w.writeheader()
        for r in rows:
            w.writerow({c: r.get(c, "") for c in cols})
    return path


def raw_files(tmp, city_p1):
    patients = [
        dict(Id=P1, FIRST="o'brien", LAST="mary-ann", BIRTHDATE="05-01-1990", MARITAL="M", GENDER="F",
             RACE="white", ETHNICITY="nonhispanic", BIRTHPLACE="Boston", ADDRESS="1 Main St",
             CITY=city_p1, STATE="MA", COUNTY="Suffolk", ZIP="02110"),
        dict(Id=P2, FIRST="lee", LAST="", BIRTHDATE="1990-01-05", MARITAL="X", GENDER="M",
             CITY="Salem", STATE="MA", COUNTY="Essex", ZIP="01970"),
    ]
    payers = [dict(Id=Y1, NAME="Medicare", ADDRESS="7500 Security Blvd", CITY="Baltimore", ZIP="21244")]
    enc = [
        dict(Id=E[0], START="2022-01-01 10:00:00", STOP="2022-01-01 11:00:00", PATIENT=P1, PAYER=Y1,
             ENCOUNTERCLASS="wellness", CODE="185349003", DESCRIPTION="Check up", BASE_ENCOUNTER_COST="100.5",
             TOTAL_CLAIM_COST="200", PAYER_COVERAGE="150", REASONCODE="", REASONDESCRIPTION=""),
        dict(Id=E[1], START="2022-01-01 23:50:00", STOP="2022-01-02 00:10:00", PATIENT=P1, PAYER=Y1,
             ENCOUNTERCLASS="emergency", CODE="50849002", DESCRIPTION="Emergency", BASE_ENCOUNTER_COST="1e3",
             TOTAL_CLAIM_COST="300", PAYER_COVERAGE="100", REASONCODE="123", REASONDESCRIPTION="Fall"),
        dict(Id=E[2], START="2022-01-02 09:00:00", STOP="2022-01-02 09:30:00", PATIENT=P2, PAYER=Y1,
             ENCOUNTERCLASS="ambulatory", CODE="1", DESCRIPTION="Visit", BASE_ENCOUNTER_COST="abc",
             TOTAL_CLAIM_COST="50", PAYER_COVERAGE="50"),
        dict(Id=E[3], START="2022-01-03T08:00:00Z", STOP="2022-01-03T08:45:00Z", PATIENT=P1, PAYER=Y1,
             ENCOUNTERCLASS="ambulatory", CODE="2", DESCRIPTION="Visit", BASE_ENCOUNTER_COST="10",
             TOTAL_CLAIM_COST="20", PAYER_COVERAGE="5"),
        # no usable time at all: kept in bronze's undated partition
        dict(Id=E[4], START="someday", STOP="", PATIENT=P2, PAYER=Y1, TOTAL_CLAIM_COST="1"),
        # still open (no stop yet)
        dict(Id="99999999-9999-4999-8999-999999999999", START="2022-01-03 07:00:00", STOP="",
             PATIENT=P2, PAYER=Y1, TOTAL_CLAIM_COST="1"),
    ]
    proc = [
        dict(START="2022-01-01 10:10:00", STOP="2022-01-01 10:40:00", PATIENT=P1, ENCOUNTER=E[0], CODE="A1",
             DESCRIPTION="Test", BASE_COST="10"),
        dict(START="2022-01-01 10:20:00", STOP="2022-01-01 10:50:00", PATIENT=P1, ENCOUNTER=E[0], CODE="",
             DESCRIPTION="Test", BASE_COST="10"),
        dict(START="2022-01-02 00:00:00", STOP="2022-01-02 00:05:00", PATIENT=P1, ENCOUNTER=E[1], CODE="B2",
             DESCRIPTION="Xray", BASE_COST="50"),
    ]
    return {
        "patients": write_csv(f"{tmp}/patients_{city_p1}.csv", "patients", patients),
        "payers": write_csv(f"{tmp}/payers.csv", "payers", payers),
        "encounters": write_csv(f"{tmp}/encounters.csv", "encounters", enc),
        "procedures": write_csv(f"{tmp}/procedures.csv", "procedures", proc),
    }


def snapshot(spark, layout):
    out = {}
    for t in ("fact_encounter", "fact_procedure", "daily_encounter"):
        out[t] = sorted(map(repr, read_table(spark, layout.gold(t)).collect()))
    out["dim_patient"] = sorted(map(repr, dimension(spark, layout, "dim_patient").read().collect()))
    return out


def test_three_days_then_rerun(spark, scratch):
    layout = Layout(f"{scratch}/lake")
    r1 = run_day(spark, D1, raw_files(scratch, "Boston"), layout)
    raw2 = raw_files(scratch, "Cambridge")  # P1 moves on day 2
    run_day(spark, D2, raw2, layout)
    run_day(spark, D3, raw2, layout)

    # silver: cleaned and typed, quality counted in the write pass
    sp = read_table(spark, layout.silver("patients")).where(F.col("partition_date") == D1)
    names = {r.patient_id: (r.patient_fullname, r.marital_status, r.gender, r.birth_date) for r in sp.collect()}
    assert names[P1] == ("O'Brien Mary-Ann", "MARRIED", "FEMALE", dt.date(1990, 1, 5))
    assert names[P2] == ("Lee", "(unknown)", "MALE", dt.date(1990, 1, 5))
    assert r1.quality["patients"]["birth_date:pattern_date_dmy"] == 1
    assert r1.quality["encounters"]["total_rows"] == 2  # events starting or stopping on D1

    store = dimension(spark, layout, "dim_patient")
    assert store.history().count() == 1 and store.active().count() == 2
    dim = store.read()
    assert at_most_one_active(dim, "patient_id").count() == 0
    p1 = sorted((r.city, r.start_date, r.end_date, r.is_active) for r in dim.where(F.col("patient_id") == P1).collect())
    assert p1 == [("Boston", D1, D2, False), ("Cambridge", D2, None, True)]

    fe = read_table(spark, layout.gold("fact_encounter"))
    assert sorted(r.encounter_id for r in fe.collect()) == sorted(E[:4])  # each event once, no fan-out
    by_id = {r.encounter_id: r for r in fe.collect()}
    assert by_id[E[1]].date == D2 and by_id[E[1]].length_of_stay_num == 1
    assert by_id[E[2]].base_cost_amount is None  # 'abc' -> NULL, counted by the type rule
    keys = {(r.patient_id, r.start_date): r.dim_patient_key for r in dim.collect()}
    assert by_id[E[0]].dim_patient_key == keys[(P1, D1)]
    assert by_id[E[3]].dim_patient_key == keys[(P1, D2)]

    daily = read_table(spark, layout.gold("daily_encounter"))
    d1 = daily.where(F.col("date") == D1).collect()
    assert [(r.total_encounter_num, r.total_procedure_num, r.total_diagnosis_num, r.total_claim_amount)
            for r in d1] == [(1, 2, 1, 200.0)]

    # declared table checks ran in the load
    r3 = run_day(spark, D3, raw2, layout)
    assert r3.quality["bronze_encounters"] == {"undated_rows": 1}
    assert r3.quality["open_events"]["encounters"] == 1
    assert r3.quality["fact_encounter"]["encounter_id:unique"] == 0
    for rep in (r1, r3):
        assert len(rep.quality["dim_patient"]) == 9 and not any(rep.quality["dim_patient"].values())
    assert r3.dimensions["dim_patient"] == "loaded"     # the last day again
    names = publish_gold(spark, layout, "laketide_run")
    assert spark.table("laketide_run.dim_patient").count() == 3
    assert {n: spark.table(n).count() for n in names}["`laketide_run`.`fact_encounter`"] == 4
    spark.sql("DROP DATABASE laketide_run CASCADE")
    assert r1.quality["fact_encounter"]["dim_patient_key:not_null"] == 0

    before = snapshot(spark, layout)
    rep = run_day(spark, D2, raw2, layout)  # re-run a day: nothing changes
    assert rep.dimensions["dim_patient"].startswith("skipped")
    assert snapshot(spark, layout) == before


def test_quarantine_policy(spark, scratch):
    layout = Layout(f"{scratch}/lake_q")
    run_day(spark, D2, raw_files(scratch, "Boston"), layout, policy="quarantine")
    bad = read_table(spark, layout.quarantine("encounters"))
    assert [r.encounter_id for r in bad.collect()] == [E[2]]  # base cost 'abc'
    good = read_table(spark, layout.silver("encounters"))
    assert E[2] not in {r.encounter_id for r in good.collect()}


def test_duplicate_and_null_snapshot_keys(spark, scratch):
    layout = Layout(f"{scratch}/lake_dup")
    raw = raw_files(scratch, "Boston")
    with open(raw["patients"], "a") as f:
        # the same patient twice in the snapshot, and one without an id
        f.write(P2 + ",01-02-1991,,,,,,ann,other,,,S,,,F,,,Lynn,MA,Essex,01901\n")
        f.write(",01-02-1991,,,,,,no,id,,,S,,,F,,,Lynn,MA,Essex,01901\n")
    report = DayReport(D1)
    run_bronze(spark, D1, raw, layout, report)
    run_silver(spark, D1, layout, report)
    with pytest.raises(QualityError):
        run_dimensions(spark, D1, layout, report, "fail")
    assert dimension(spark, layout, "dim_patient").read() is None

    run_dimensions(spark, D1, layout, report)       # report: the patient stays, once
    assert report.quality["dim_patient"]["duplicate_keys"] == 1
    assert report.quality["dim_patient"]["null_keys"] == 1
    dim = dimension(spark, layout, "dim_patient").read()
    assert sorted((r.patient_id, r.patient_fullname) for r in dim.collect()) == [(P1, "O'Brien Mary-Ann"), (P2, "Ann Other")]
    assert read_table(spark, layout.quarantine("dim_patient_rejected")).count() == 1

    run_dimensions(spark, D1, layout, report, "quarantine")
    dim = dimension(spark, layout, "dim_patient").read()
    assert [r.patient_id for r in dim.collect()] == [P1]
    assert read_table(spark, layout.quarantine("dim_patient_rejected")).count() == 3


def test_fail_reaches_gold(spark, scratch):
    layout = Layout(f"{scratch}/lake_fail")
    raw = raw_files(scratch, "Boston")
    report = DayReport(D2)
    run_bronze(spark, D2, raw, layout, report)
    run_silver(spark, D2, layout, report)           # base cost 'abc' becomes NULL
    run_dimensions(spark, D2, layout, report)
    with pytest.raises(QualityError, match="base_cost_amount"):
        run_facts(spark, D2, layout, report, "fail")
    assert not table_exists(spark, layout.gold("fact_encounter"))


def test_bronze_rerun_after_source_lost_the_day(spark, scratch):
    layout = Layout(f"{scratch}/lake_b")
    raw = raw_files(scratch, "Boston")
    run_bronze(spark, D1, raw, layout, DayReport(D1))
    enc = read_table(spark, layout.bronze("encounters"))
    assert enc.where(F.col("partition_date") == D1).count() == 2
    # the source is corrected: no encounter touches D1 any more
    write_csv(raw["encounters"], "encounters", [
        dict(Id=E[2], START="2022-01-02 09:00:00", STOP="2022-01-02 09:30:00", PATIENT=P2, PAYER=Y1)])
    run_bronze(spark, D1, raw, layout, DayReport(D1))
    enc = read_table(spark, layout.bronze("encounters"))
    assert enc.where(F.col("partition_date") == D1).count() == 0   # the day was replaced, not kept
    assert enc.where(F.col("partition_date").isNull()).count() == 0  # so was the undated partition
