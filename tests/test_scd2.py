import datetime as dt
import random

from pyspark.sql import functions as F

from laketide.operators import scd2 as S
from laketide.operators.quality import at_most_one_active, unique_violations

SPEC = S.DimSpec("id", ("name", "city"), surrogate_key="dim_key")
SCHEMA = "id long, name string, city string"
D1, D2, D3, D4 = (dt.date(2022, 1, d) for d in (1, 2, 3, 4))


def snap(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(((r.id, r.name, r.city, r.start_date, r.end_date, r.is_active) for r in df.collect()),
                  key=repr)


def test_first_load_opens_everything(spark):
    dim = S.scd2_apply(None, snap(spark, [(1, "a", "x"), (2, "b", "y")]), SPEC, D1)
    assert rows(dim) == [(1, "a", "x", D1, None, True), (2, "b", "y", D1, None, True)]
    assert dim.columns == SPEC.columns


def test_step_new_changed_unchanged_missing(spark):
    dim = S.scd2_apply(None, snap(spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]), SPEC, D1)
    # 1 unchanged, 2 changed, 3 missing, 4 new
    dim2 = S.scd2_apply(dim, snap(spark, [(1, "a", "x"), (2, "b", "Y"), (4, "d", "w")]), SPEC, D2)
    assert rows(dim2) == sorted([
        (1, "a", "x", D1, None, True),
        (2, "b", "y", D1, D2, False),
        (2, "b", "Y", D2, None, True),
        (3, "c", "z", D1, None, True),
        (4, "d", "w", D2, None, True),
    ], key=repr)
    # the unchanged row keeps its surrogate key
    k1 = {r.id: r.dim_key for r in dim.collect()}[1]
    assert k1 in {r.dim_key for r in dim2.collect()}


def test_changes_and_close_open(spark):
    dim = S.scd2_apply(None, snap(spark, [(1, "a", "x"), (2, "b", "y")]), SPEC, D1)
    ch = S.scd2_changes(dim, snap(spark, [(1, "a", "x"), (2, "b", None), (3, "c", "z")]), SPEC)
    assert sorted((r.id, r.change) for r in ch.collect()) == [(2, "changed"), (3, "new")]
    closed = S.scd2_close(dim, ch.where(F.col("change") == "changed"), SPEC, D2)
    assert rows(closed) == [(2, "b", "y", D1, D2, False)]
    opened = S.scd2_open(ch, SPEC, D2)
    assert rows(opened) == [(2, "b", None, D2, None, True), (3, "c", "z", D2, None, True)]


def test_null_attribute_hashes_like_empty_text(spark):
    dim = S.scd2_apply(None, snap(spark, [(1, "a", None)]), SPEC, D1)
    dim2 = S.scd2_apply(dim, snap(spark, [(1, "a", "")]), SPEC, D2)
    assert dim2.count() == 1  # NULL and '' hash alike (documented)


def test_idempotent_and_unchanged_snapshot(spark):
    s1 = snap(spark, [(1, "a", "x"), (2, "b", "y")])
    dim = S.scd2_apply(None, s1, SPEC, D1)
    again = S.scd2_apply(dim, s1, SPEC, D2)
    assert rows(again) == rows(dim)
    # the same snapshot applied twice on the same date is a no-op (gate)
    s2 = snap(spark, [(1, "a", "X")])
    dim2 = S.scd2_apply(dim, s2, SPEC, D2)
    assert rows(S.scd2_apply(dim2, s2, SPEC, D2)) == rows(dim2)


def test_back_dated_run_is_noop(spark):
    dim = S.scd2_apply(None, snap(spark, [(1, "a", "x")]), SPEC, D2)
    assert rows(S.scd2_apply(dim, snap(spark, [(1, "a", "CHANGED")]), SPEC, D1)) == rows(dim)


def test_null_and_repeated_keys(spark):
    raw = snap(spark, [(1, "a", "x"), (None, "n", "n"), (None, "n", "n"), (2, "b", "z"), (2, "b", "y"), (3, "c", "q"),
                       (3, "c", "q"), (4, "d", None), (4, "d", "")])
    one = S.one_row_per_key(raw, SPEC)
    assert sorted(map(tuple, one.collect())) == [
        (1, "a", "x", False), (2, "b", "y", True), (3, "c", "q", False), (4, "d", None, True)]
    assert S.unusable_rows(raw, SPEC).count() == 2
    # no function makes a version without a key
    null = snap(spark, [(None, "n", "n"), (1, "a", "x")])
    dim = S.scd2_apply(None, null, SPEC, D1)
    assert [r.id for r in dim.collect()] == [1]
    assert rows(S.scd2_apply(dim, null, SPEC, D2)) == rows(dim)
    assert S.scd2_changes(dim, null, SPEC).count() == 0 and S.scd2_changes(None, null, SPEC).count() == 1
    assert rows(S.scd2_from_snapshots(null.withColumn("snapshot_date", F.lit(D1)), SPEC)) == rows(dim)


def _random_history(seed, n_keys=25, n_days=5):
    rnd = random.Random(seed)
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(n_days)]
    snaps = []
    for d in days:
        rows_ = []
        for k in range(n_keys):
            if rnd.random() < 0.15:
                continue  # key missing from this snapshot
            if rnd.random() < 0.1:
                rows_.append((None, "n", rnd.choice("xy")))
            rows_.append((k, rnd.choice("ab"), rnd.choice(["x", "y", None])))
        snaps.append((d, rows_))
    return snaps


def test_history_equals_iterated_steps(spark):
    for seed in range(3):
        snaps = _random_history(seed)
        dim = None
        for d, rs in snaps:
            dim = S.scd2_apply(dim, snap(spark, rs), SPEC, d)
        stacked = spark.createDataFrame([(k, n, c, d) for d, rs in snaps for (k, n, c) in rs],
                                        SCHEMA + ", snapshot_date date")
        hist = S.scd2_from_snapshots(stacked, SPEC)
        assert rows(hist) == rows(dim), seed
        assert sorted(r.dim_key for r in hist.collect()) == sorted(r.dim_key for r in dim.collect())
        # invariants: one active version per key, keys unique, intervals do not overlap
        assert at_most_one_active(dim, "id").count() == 0
        assert unique_violations(dim, ["dim_key"]).count() == 0
        by_key = {}
        for r in dim.collect():
            by_key.setdefault(r.id, []).append((r.start_date, r.end_date))
        for ivs in by_key.values():
            ivs.sort()
            for (s1, e1), (s2, _) in zip(ivs, ivs[1:]):
                assert e1 is not None and e1 <= s2


def test_valid_on_and_last_date(spark):
    dim = S.scd2_apply(None, snap(spark, [(1, "a", "x")]), SPEC, D1)
    dim = S.scd2_apply(dim, snap(spark, [(1, "a", "y")]), SPEC, D3)
    assert [r.city for r in S.valid_on(dim, SPEC, D2).collect()] == ["x"]
    assert [r.city for r in S.valid_on(dim, SPEC, D3).collect()] == ["y"]
    assert S.valid_on(dim, SPEC, dt.date(2021, 12, 31)).count() == 0
    assert S.last_date(dim, SPEC).first()[0] == D3
