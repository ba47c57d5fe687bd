import datetime as dt

import pytest
from pyspark.sql import functions as F

from laketide.operators.scd2 import DimSpec, scd2_apply
from laketide.session import stored
from laketide.sinks import DimensionTables, dimension
from laketide.sinks import write as W
from laketide.sources import tables as T


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, d date")


D1, D2 = dt.date(2022, 1, 1), dt.date(2022, 1, 2)


def content(spark, path):
    return sorted((r.k, r.v, r.d) for r in T.read_table(spark, path).collect())


def test_partition_overwrite_keeps_other_dates(spark, scratch):
    path = f"{scratch}/t"
    assert not T.table_exists(spark, path)
    W.overwrite_partitions(frame(spark, [(1, "a", D1), (2, "b", D2)]), path, "d")
    W.overwrite_partitions(frame(spark, [(3, "c", D2)]), path, "d")   # rewrite D2 only
    assert content(spark, path) == [(1, "a", D1), (3, "c", D2)]
    W.overwrite_partitions(frame(spark, [(3, "c", D2)]), path, "d")   # repeat: no change
    assert content(spark, path) == [(1, "a", D1), (3, "c", D2)]
    assert T.read_slice(spark, path, D1, "d").count() == 1


def test_materialize_modes(spark, scratch):
    path = f"{scratch}/m"
    df = frame(spark, [(1, "a", D1)])
    assert W.materialize(df, path, "d", D1) == "create"
    # static partition overwrite: rows stamped with the run date
    assert W.materialize(frame(spark, [(2, "b", D1)]), path, "d", D2) == "overwrite_partition"
    assert content(spark, path) == [(1, "a", D1), (2, "b", D2)]
    assert W.materialize(frame(spark, [(9, "z", D1)]), path, "d") == "overwrite_partitions"
    assert content(spark, path) == [(2, "b", D2), (9, "z", D1)]
    flat = f"{scratch}/flat"
    calls = []
    assert W.materialize(df, flat, before=lambda: calls.append("b"), after=lambda: calls.append("a")) == "create"
    assert W.materialize(df, flat) == "append"
    assert T.read_table(spark, flat).count() == 2 and calls == ["b", "a"]


def test_catalog_table_paths(spark, scratch):
    name = "laketide_test_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    W.overwrite_partitions(frame(spark, [(1, "a", D1), (2, "b", D2)]), name, "d")
    W.overwrite_partitions(frame(spark, [(3, "c", D2)]), name, "d")
    got = sorted((r.k, r.v, r.d) for r in spark.table(name).collect())
    assert got == [(1, "a", D1), (3, "c", D2)]
    assert T.columns_except(spark, name, ["d"]) == ["k", "v"]
    W.materialize(frame(spark, [(1, "a", D1)]).where("k < 0"), name, "d", D2)  # static, no rows
    got = sorted((r.k, r.v, r.d) for r in spark.table(name).collect())
    assert got == [(1, "a", D1)]
    spark.sql(f"DROP TABLE IF EXISTS {name}")


SPEC = DimSpec("id", ("city",), surrogate_key="dim_key")
DAYS = [dt.date(2022, 1, d) for d in (1, 2, 3, 4)]
SNAPSHOTS = [[(1, "a"), (2, "b")], [(1, "A"), (2, "b"), (3, "c")], [(1, "A"), (3, "C")], [(1, "a"), (2, "B")]]


def load(spark, tables, i, rows=None):
    snap = spark.createDataFrame(rows or SNAPSHOTS[i], "id long, city string")
    with stored(tables.step(snap, DAYS[i])) as step:
        tables.store(step, DAYS[i])


def dim_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def clean(spark, loads):
    dim = None
    for i in loads:
        dim = scd2_apply(dim, spark.createDataFrame(SNAPSHOTS[i], "id long, city string"), SPEC, DAYS[i])
    return dim_rows(dim)


def test_dimension_loads_can_be_repeated_and_die(spark, scratch, monkeypatch):
    tables = DimensionTables(spark, f"{scratch}/dim", SPEC)
    assert tables.read() is None and tables.last_load() is None
    load(spark, tables, 0)
    load(spark, tables, 1, [(1, "wrong"), (2, "wrong")])
    load(spark, tables, 1)                          # the day again, source corrected
    assert dim_rows(tables.read()) == clean(spark, [0, 1])
    assert tables.too_late(DAYS[0]) and not tables.too_late(DAYS[1])

    real = dimension.overwrite_partition

    def dies(df, target, *args):
        if target == tables.open_table and df.count():
            raise RuntimeError("lost between the two writes")
        return real(df, target, *args)
    monkeypatch.setattr(dimension, "overwrite_partition", dies)
    with pytest.raises(RuntimeError):
        load(spark, tables, 2, [(1, "half"), (2, "half")])
    assert dim_rows(tables.read()) == clean(spark, [0, 1])      # no effect
    monkeypatch.setattr(dimension, "overwrite_partition", real)
    again = DimensionTables(spark, f"{scratch}/dim", SPEC)
    load(spark, again, 3)                           # the next date, without the lost one
    assert dim_rows(again.read()) == clean(spark, [0, 1, 3])

    monkeypatch.setattr(dimension, "overwrite_partition", dies)
    with pytest.raises(RuntimeError):
        load(spark, again, 3, [(1, "half")])        # a repeated load dies
    monkeypatch.setattr(dimension, "overwrite_partition", real)
    assert dim_rows(again.read()) == clean(spark, [0, 1])
    load(spark, again, 3)
    assert dim_rows(again.read()) == clean(spark, [0, 1, 3])


def test_dimension_view(spark, scratch):
    tables = DimensionTables(spark, f"{scratch}/dim_view", SPEC)
    load(spark, tables, 0)                          # nothing closed yet
    assert dim_rows(spark.table(tables.create_views("laketide_test", "dim"))) == clean(spark, [0])
    load(spark, tables, 1)
    tables.create_views("laketide_test", "dim")
    assert dim_rows(spark.sql("select * from laketide_test.dim")) == clean(spark, [0, 1])
    spark.sql("DROP DATABASE laketide_test CASCADE")


def test_columns_are_matched_by_name(spark, scratch):
    path = f"{scratch}/names"
    W.append(frame(spark, [(1, "a", D1)]), path)
    W.append(frame(spark, [(2, "b", D1)]).select("d", "v", "k"), path)
    assert content(spark, path) == [(1, "a", D1), (2, "b", D1)]
    for changed in (frame(spark, [(3, "c", D1)]).withColumn("new", F.lit(1)), frame(spark, [(3, "c", D1)]).drop("v")):
        with pytest.raises(ValueError, match="columns differ"):
            W.append(changed, path)
        with pytest.raises(ValueError, match="columns differ"):
            W.overwrite_partition(changed, path, "d", D1)


def test_schema_helpers():
    s = T.schema_from_dict({"a": "bigint", "b": "string", "c": "date"}, exclude_keys=["b"])
    assert [f.name for f in s.fields] == ["a", "c"]
    conf = T.object_store_conf("http://minio:9000", access_key_env="NOPE_A", secret_key_env="NOPE_B")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert "spark.sql.catalog.lake" in T.catalog_conf("lake", "s3a://bucket/wh")


def test_empty_partitioned_table_reads_back(spark, scratch):
    path = f"{scratch}/empty"
    empty = frame(spark, [(1, "a", D1)]).where("k < 0")
    W.materialize(empty, path, "d", D1)
    back = T.read_table(spark, path)
    assert back.count() == 0 and back.columns == ["k", "v", "d"]
    assert W.materialize(frame(spark, [(2, "b", D2)]), path, "d", D2) == "overwrite_partition"
    assert content(spark, path) == [(2, "b", D2)]


def test_static_overwrite_with_no_rows_clears_the_day(spark, scratch):
    path = f"{scratch}/s"
    W.materialize(frame(spark, [(1, "a", D1), (2, "b", D2)]), path, "d")
    W.materialize(frame(spark, [(9, "z", D1)]).where("k < 0"), path, "d", D2)  # day 2 re-run, no rows
    assert content(spark, path) == [(1, "a", D1)]
    W.materialize(frame(spark, [(3, "c", D1)]), path, "d", D2)                 # stamped with D2
    assert content(spark, path) == [(1, "a", D1), (3, "c", D2)]
