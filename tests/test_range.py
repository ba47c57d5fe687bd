"""Many days in one pass leave what the day loop leaves."""

import datetime

import pytest
from pyspark.sql import functions as F

import laketide.sinks.dimension as dimension_module
import laketide.sinks.write as write_module
from laketide.operators.quality import QualityError
from laketide.plans import bronze, silver
from laketide.plans.run import TABLES, Layout, dimension, run_day, run_days, run_range
from laketide.sources.tables import read_table
from tests.test_run import D1, D2, D3, raw_files, snapshot, write_csv


@pytest.fixture
def raw(scratch):
    """P1 moves on the second day."""
    first, later = raw_files(scratch, "Boston"), raw_files(scratch, "Cambridge")
    return first | {"patients": {D1: first["patients"], D2.isoformat(): later["patients"]}}


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def lake(spark, layout, quarantine=False):
    out = snapshot(spark, layout)
    for t in TABLES:
        out[f"bronze_{t}"] = rows(read_table(spark, layout.bronze(t)))
        out[f"silver_{t}"] = rows(read_table(spark, layout.silver(t)))
        if quarantine:
            out[f"quarantine_{t}"] = rows(read_table(spark, layout.quarantine(t)))
    return out


def test_range_equals_day_loop(spark, scratch, raw):
    policy = "quarantine"
    loop, whole = Layout(f"{scratch}/loop"), Layout(f"{scratch}/range")
    days = run_days(spark, D1, D3, raw, loop, policy)
    report = run_range(spark, D1, D3, raw, whole, policy)
    want = lake(spark, loop, quarantine=True)
    assert lake(spark, whole, quarantine=True) == want
    assert len(want["dim_patient"]) == 2        # versions of P1; P2's birth date fails
    # the counts of the days, added up
    for t in TABLES:
        sums = {k: sum(d.quality[t][k] for d in days) for k in days[0].quality[t]}
        assert report.quality[t] == sums, t
    assert report.quality["bronze_encounters"] == {"undated_rows": 1}


def test_a_snapshot_file_is_conformed_once(spark, scratch, raw, monkeypatch):
    """Silver cleans one day of a file, and the other days are copies."""
    conform, typed, rules = silver.STAGES["patients"]
    days = []

    def counted(rows):
        days.append(sorted(r[0] for r in rows.select("partition_date").distinct().collect()))
        return conform(rows)
    monkeypatch.setitem(silver.STAGES, "patients", (counted, typed, rules))
    layout = Layout(f"{scratch}/lake")
    report = run_range(spark, D1, D3, raw, layout)
    assert days == [[D1], [D2]]
    table = read_table(spark, layout.silver("patients"))
    each = {r[0]: r[1] for r in table.groupBy("partition_date").count().collect()}
    assert sorted(each) == [D1, D2, D3] and len(set(each.values())) == 1
    assert report.quality["patients"]["total_rows"] == sum(each.values())


def test_range_goes_on_from_stored_days(spark, scratch, raw):
    loop, mixed = Layout(f"{scratch}/loop"), Layout(f"{scratch}/mixed")
    run_days(spark, D1, D3, raw, loop)
    run_day(spark, D1, raw, mixed)
    run_range(spark, D2, D3, raw, mixed)
    want = lake(spark, loop)
    assert lake(spark, mixed) == want
    assert len(want["dim_patient"]) == 3
    # the first day again: the dimensions know later days, the rest is the same
    assert run_range(spark, D1, D1, raw, mixed).dimensions["dim_patient"].startswith("skipped")
    assert lake(spark, mixed) == want


def test_days_that_lost_their_rows_are_cleared(spark, scratch, raw):
    layout = Layout(f"{scratch}/lake")
    run_range(spark, D1, D3, raw, layout)
    write_csv(raw["encounters"], "encounters", [
        dict(Id="x", START="2022-01-03 08:00:00", STOP="2022-01-03 08:45:00", PATIENT="p", PAYER="y", TOTAL_CLAIM_COST="1")])
    spark.catalog.clearCache()
    run_range(spark, D1, D3, raw, layout)
    for table in (layout.bronze("encounters"), layout.silver("encounters")):
        assert [r[0] for r in read_table(spark, table).select("partition_date").collect()] == [D3]
    assert read_table(spark, layout.gold("fact_encounter")).count() == 1
    assert read_table(spark, layout.gold("daily_encounter")).count() == 1


def test_a_load_that_dies_half_way_has_no_effect(spark, scratch, raw, monkeypatch):
    layout = Layout(f"{scratch}/lake")
    run_day(spark, D1, raw, layout)
    before = rows(dimension(spark, layout, "dim_patient").read())

    def dies(df, target, part_col, d, **kw):
        if target.endswith("/open"):
            raise OSError("lost")
        return real(df, target, part_col, d, **kw)
    real = dimension_module.overwrite_partition
    monkeypatch.setattr(dimension_module, "overwrite_partition", dies)
    with pytest.raises(OSError, match="lost"):
        run_range(spark, D2, D3, raw, layout)
    assert rows(dimension(spark, layout, "dim_patient").read()) == before
    monkeypatch.undo()
    run_range(spark, D2, D3, raw, layout)
    versions = dimension(spark, layout, "dim_patient").read()
    assert sorted((r.city, r.start_date, r.end_date) for r in versions.where("end_date is not null or city = 'Cambridge'").collect()) \
        == [("Boston", D1, D2), ("Cambridge", D2, None)]


def test_fail_raises_before_writing(spark, scratch, raw):
    layout = Layout(f"{scratch}/lake")
    with pytest.raises(QualityError):
        run_range(spark, D1, D3, raw, layout, "fail")


def test_each_file_is_scanned_once(spark, raw):
    plan = bronze.ingest_event_range(spark, raw["encounters"], "encounters", D1, D3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan csv") == 1 and "Exchange" not in text
    plan = bronze.ingest_full_range(spark, raw["patients"], "patients", D1, D3)
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2      # two files
    assert {tuple(r) for r in plan.groupBy("partition_date").agg(F.count(F.lit(1))).collect()} == {(D1, 2), (D2, 2), (D3, 2)}


def test_copies_of_a_snapshot_are_not_shuffled(spark, scratch, raw, monkeypatch):
    part = bronze.on_each_day(spark.range(40).repartition(4), D1, D3)
    assert part.groupBy("id").count().where("count = 3").count() == 40
    days = part.groupBy(F.spark_partition_id()).agg(F.countDistinct(bronze.PART_COL).alias("n"))
    assert {r["n"] for r in days.collect()} == {1}
    moved, store = {}, write_module.overwrite_partitions

    def record(df, target, *args, **kw):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        moved["/".join(target.rsplit("/", 2)[1:])] = "RebalancePartitions" in plan
        store(df, target, *args, **kw)
    monkeypatch.setattr(write_module, "overwrite_partitions", record)
    layout = Layout(f"{scratch}/lake")
    run_range(spark, D1, D3, raw, layout)
    assert not any(moved[f"{layer}/{t}"] for layer in ("bronze", "silver") for t in bronze.SNAPSHOT_TABLES)
    assert moved["bronze/encounters"]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_range_written_where_it_is(spark, scratch):
    """Days that a task holds in any order and number; a day that is gone."""
    target, n = f"{scratch}/t", write_module.OPEN_PARTITIONS + 8
    df = spark.range(400, numPartitions=2).withColumn("d", F.date_add(F.lit(D1), (F.col("id") % n).cast("int")))
    end = D1 + datetime.timedelta(days=n)
    for kept in (df, df.where(F.col("id") % n != 3)):
        assert write_module.overwrite_range(kept, target, "d", D1, end, clustered=True) == kept.count()
        assert rows(read_table(spark, target)) == rows(kept)


def test_files_of_a_day(raw):
    first, later = raw["patients"].values()
    assert [bronze.path_on(raw["patients"], d) for d in (D1, D2, D3)] == [first, later, later]
    assert bronze.periods(raw["patients"], D1, D3) == [(D1, D1, first), (D2, D3, later)]
    assert bronze.periods(raw["patients"], D2, D3) == [(D2, D3, later)]
    assert bronze.periods("x", D1, D3) == [(D1, D3, "x")]
    with pytest.raises(ValueError, match="no file"):
        bronze.path_on({D2: "x"}, D1)
