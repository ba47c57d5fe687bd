"""The dimension kept as a log of changes, against the stepped dimension."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from laketide.operators.scd2 import DimSpec, scd2_apply, scd2_from_snapshots
from laketide.session import stored
from laketide.sinks import DimensionLog, dimension_log
from laketide.sources import tables as T

SPEC = DimSpec("id", ("city",), surrogate_key="sk")
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(8)]
SNAPSHOTS = [
    [(i, "a") for i in range(40)],
    [(i, "b" if i < 3 else "a") for i in range(40)],
    [(i, "a") for i in range(1, 42)],           # 0 is missing and stays open, 40 and 41 are new
    [(i, "a") for i in range(1, 42)],           # no change
    [(i, "c" if i in (0, 41) else "a") for i in range(42)],
]


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "id long, city string")


def load(spark, tables, i, rows=None):
    with stored(tables.step(snapshot(spark, rows or SNAPSHOTS[i]), DAYS[i])) as step:
        tables.store(step, DAYS[i])


def rows_of(df):
    return sorted([tuple(r) for r in df.select(*SPEC.columns).collect()], key=repr)


def stepped(spark, loads):
    dim = None
    for i in loads:
        dim = scd2_apply(dim, snapshot(spark, SNAPSHOTS[i]), SPEC, DAYS[i])
    return rows_of(dim)


def test_loads_write_only_their_changes(spark, scratch):
    tables = DimensionLog(spark, f"{scratch}/dim", SPEC)
    assert tables.read() is None and tables.compact() is None and not tables.compaction_due()
    for i in range(5):
        load(spark, tables, i)
    assert rows_of(tables.read()) == stepped(spark, range(5))
    assert tables.loads() == dict(zip(DAYS, [40, 3, 4, 0, 2]))
    assert [rows_of(tables.active(before=DAYS[i + 1])) for i in range(4)] == \
        [[r for r in stepped(spark, range(i + 1)) if r[-1]] for i in range(4)]
    # a compaction changes nothing and drops what it replaces
    assert tables.compaction_due() and tables.compact(keep_previous=False) == DAYS[4]
    assert rows_of(tables.read()) == stepped(spark, range(5)) and tables.bases() == {DAYS[4]: 42}
    assert T.partition_values(spark, tables.opened_table, "load_date") == set()
    assert not tables.compaction_due()
    with pytest.raises(ValueError):
        tables.active(before=DAYS[2])           # not an older state, nor an empty one
    with pytest.raises(ValueError):
        load(spark, tables, 4)
    # few changes: the base is not shuffled
    load(spark, tables, 5, SNAPSHOTS[0])
    plan = tables.active()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_repeated_and_dying_loads(spark, scratch, monkeypatch):
    tables = DimensionLog(spark, f"{scratch}/dim", SPEC)
    load(spark, tables, 0)
    tables.compact()
    load(spark, tables, 1, [(1, "wrong"), (2, "wrong"), (99, "wrong")])
    tables.compact()
    load(spark, tables, 1)                      # again, upon the base before; its own base goes
    assert rows_of(tables.read()) == stepped(spark, [0, 1]) and set(tables.bases()) == {DAYS[0]}
    real = DimensionLog._register

    def dies(self, table, d, n):
        raise RuntimeError("lost before the load is registered")
    monkeypatch.setattr(DimensionLog, "_register", dies)
    with pytest.raises(RuntimeError):
        load(spark, tables, 2, [(1, "half"), (2, "half"), (77, "half")])
    assert rows_of(tables.read()) == stepped(spark, [0, 1])     # no effect
    with pytest.raises(RuntimeError):
        tables.compact()                        # nor has a compaction that dies
    assert rows_of(tables.read()) == stepped(spark, [0, 1])
    monkeypatch.setattr(DimensionLog, "_register", real)
    load(spark, tables, 3)                      # the next date, without the lost one
    assert rows_of(tables.read()) == stepped(spark, [0, 1, 3])
    tables.compact()
    assert rows_of(tables.read()) == stepped(spark, [0, 1, 3])


def test_a_dying_undo_leaves_an_earlier_state(spark, scratch, monkeypatch):
    tables = DimensionLog(spark, f"{scratch}/dim", SPEC)
    for i in range(3):
        load(spark, tables, i)
    real, calls = dimension_log.delete_path, []

    def dies(spark, path):
        if calls:
            raise RuntimeError("lost while loads are undone")
        calls.append(path)
        real(spark, path)
    monkeypatch.setattr(dimension_log, "delete_path", dies)
    with pytest.raises(RuntimeError):
        tables._undo(DAYS[1])
    assert rows_of(tables.read()) == stepped(spark, [0, 1])
    monkeypatch.setattr(dimension_log, "delete_path", real)
    load(spark, tables, 1)
    load(spark, tables, 2)
    assert rows_of(tables.read()) == stepped(spark, [0, 1, 2])


def test_range_loads_equal_history(spark, scratch):
    rnd = random.Random(1)
    rows = [(k, rnd.choice("xy"), d) for d in DAYS for k in range(30) if rnd.random() < 0.7]
    df = spark.createDataFrame(rows, "id long, city string, day date")
    day = F.col("day")
    tables = DimensionLog(spark, f"{scratch}/dim", SPEC)

    def store(snapshots, first, last):
        changed, before = tables.step_range(snapshots, DAYS[first], "day")
        with stored(changed) as step:
            tables.store_range(step, before, DAYS[last], DAYS[first])
    store(df.where(day <= F.lit(DAYS[3])), 0, 3)
    # other values first, by days and by a range; then the right ones
    other = df.where(day > F.lit(DAYS[3])).withColumn("city", F.lit("other"))
    for i in (4, 5):
        with stored(tables.step(other.where(day == F.lit(DAYS[i])).drop("day"), DAYS[i])) as step:
            tables.store(step, DAYS[i])
    store(other, 4, 7)
    store(df.where(day > F.lit(DAYS[3])), 4, 7)
    want = rows_of(scd2_from_snapshots(df, SPEC, "day"))
    assert rows_of(tables.read()) == want
    assert set(tables.loads()) == {DAYS[3], DAYS[7]}
    tables.compact()
    assert rows_of(tables.read()) == want


def test_view(spark, scratch):
    tables = DimensionLog(spark, f"{scratch}/dim", SPEC)
    load(spark, tables, 0)
    assert rows_of(spark.table(tables.create_views("laketide_log_test", "dim"))) == stepped(spark, [0])
    load(spark, tables, 1)
    load(spark, tables, 2)
    assert rows_of(spark.table(tables.create_views("laketide_log_test", "dim"))) == stepped(spark, [0, 1, 2])
    spark.sql("DROP DATABASE laketide_log_test CASCADE")
