"""Key index and write-audit-publish on literal rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from laketide.operators.quality import QualityError, not_null
from laketide.sinks import KeyIndex, PublishedTable, overwrite_partition
from laketide.sinks.write import overwrite_range
from laketide.sources.tables import partition_values

D = [dt.date(2022, 1, i) for i in range(1, 8)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, date date")


def found(df):
    return sorted((r.k, r.n_rows, r.n_dates, r.first_date, r.last_date) for r in df.collect())


def test_key_found_across_dates_without_old_facts(spark, scratch):
    index = KeyIndex(spark, f"{scratch}/keys", ["k"])
    day1 = frame(spark, [("a", 1, D[0]), ("b", 1, D[0]), (None, 1, D[0]), (None, 2, D[0])])
    assert found(index.violations(day1, D[0])) == []          # NULL is no key
    index.store(day1, D[0])
    day2 = frame(spark, [("b", 2, D[1]), ("c", 2, D[1]), ("c", 3, D[1])])
    expected = [("b", 2, 2, D[0], D[1]), ("c", 2, 1, D[1], D[1])]
    assert found(index.violations(day2, D[1])) == expected
    index.store(day2, D[1])
    assert found(index.violations(day2, D[1])) == expected    # a repeated day does not meet itself
    assert found(index.violations(frame(spark, []), D[2])) == []
    # the day is sent again without its duplicates
    fixed = frame(spark, [("c", 2, D[1])])
    index.store(fixed, D[1])
    assert found(index.violations(day1, D[0])) == []


def test_random_loads_equal_one_count(spark, scratch):
    rng = random.Random(5)
    index, table = KeyIndex(spark, f"{scratch}/keys", ["k"]), {}
    for first, last in [(0, 2), (4, 6), (3, 3), (1, 4), (0, 0), (2, 6)]:
        rows = [(f"k{rng.randrange(12)}", i, D[rng.randint(first, last)]) for i in range(rng.choice([0, 3, 9]))]
        load = frame(spark, rows)
        table = {d: r for d, r in table.items() if not D[first] <= d <= D[last]}
        for r in rows:
            table.setdefault(r[2], []).append(r)
        touched, every = {r[0] for r in rows}, {}
        for r in (r for day in table.values() for r in day):
            every.setdefault(r[0], []).append(r[2])
        expected = sorted((k, len(ds), len(set(ds)), min(ds), max(ds))
                          for k, ds in every.items() if k in touched and len(ds) > 1)
        assert found(index.violations(load, D[first], D[last])) == expected
        index.store(load, D[first], D[last])


def test_catch_up_after_a_dead_load(spark, scratch):
    fact, index = f"{scratch}/fact", KeyIndex(spark, f"{scratch}/keys", ["k"])
    overwrite_range(frame(spark, [("a", 1, D[0]), ("b", 1, D[1])]), fact, "date", D[0], D[1])
    overwrite_partition(frame(spark, []), fact, "date", D[2])      # a day without rows
    index.store(frame(spark, [("a", 1, D[0])]), D[0])
    # the loads of D[1] and D[2] died before their index was written
    assert index.catch_up(fact, D[3]) == [D[1].isoformat(), D[2].isoformat()]
    assert index.catch_up(fact, D[3]) == []
    assert found(index.violations(frame(spark, [("b", 9, D[3])]), D[3])) == [("b", 2, 2, D[1], D[3])]
    assert partition_values(spark, f"{scratch}/none", "date") == set()


@pytest.fixture
def published(spark, scratch):
    name = f"published_{abs(hash(scratch))}"
    yield PublishedTable(spark, name, f"{scratch}/p")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def content(table):
    return sorted((r.k, r.v, r.date) for r in table.read().collect())


def test_publish_moves_whole_days(spark, published):
    old = [("a", 1, D[0]), ("b", 1, D[1]), ("c", 1, D[2])]
    assert published.load(frame(spark, old), D[0], D[2], not_null("k"), [["k"]]) == {"k:not_null": 0, "k:unique": 0}
    assert content(published) == old
    # staged only, as when a load dies before it is published
    staged = published.stage(frame(spark, [("x", 2, D[1])]), D[1], D[2])
    assert content(published) == old
    assert [(r.k, r.v, r.date) for r in published.staged_rows(staged).collect()] == [("x", 2, D[1])]
    before = published.unpublished()
    assert before == [staged.folder]
    published.publish(staged)                                   # D[2] has no rows any more
    assert content(published) == [("a", 1, D[0]), ("x", 2, D[1])]
    published.publish(staged)                                   # again: the same state
    assert content(published) == [("a", 1, D[0]), ("x", 2, D[1])]
    assert published.unpublished() == []                        # the first load still holds D[0]


def test_a_failing_load_is_never_seen(spark, published):
    published.load(frame(spark, [("a", 1, D[0])]), D[0], rules=not_null("k"))
    with pytest.raises(QualityError):
        published.load(frame(spark, [("b", 2, D[0]), (None, 3, D[0])]), D[0], rules=not_null("k"))
    with pytest.raises(QualityError):
        published.load(frame(spark, [("b", 2, D[0]), ("b", 3, D[0])]), D[0], unique=[["k"]])
    assert content(published) == [("a", 1, D[0])] and published.unpublished() == []
    with pytest.raises(ValueError):
        published.stage(frame(spark, [("b", 2, D[3])]), D[0])   # another date
    with pytest.raises(ValueError):
        published.stage(frame(spark, [("b", 2, None)]), D[0])
    with pytest.raises(ValueError):
        published.stage(frame(spark, []).withColumn("w", F.lit(1)), D[0])
    published.load(frame(spark, []), D[0])                      # an empty day clears the day
    assert content(published) == []


def test_a_publish_that_dies_half_way_is_run_again(spark, published, monkeypatch):
    published.load(frame(spark, [("a", 1, D[0]), ("b", 1, D[1])]), D[0], D[1])
    staged = published.stage(frame(spark, [("a", 2, D[0]), ("b", 2, D[1])]), D[0], D[1])
    spec = published._spec
    monkeypatch.setattr(published, "_spec", lambda d: spec(d) if d == D[0].isoformat() else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        published.publish(staged)
    monkeypatch.undo()
    # every day is wholly old or wholly new
    assert content(published)[1][1] == 1
    published.publish(staged)
    assert content(published) == [("a", 2, D[0]), ("b", 2, D[1])]


def test_gold_keys_are_unique_over_the_whole_table(spark, scratch):
    """A daily load counts a key that an older date holds; under ``fail`` the
    day is not written."""
    from laketide.plans import gold
    from laketide.plans.run import DayReport, Layout, _store_gold
    from laketide.sinks.write import materialize
    from laketide.sources.tables import read_table
    layout = Layout(scratch)

    def day(d, ids):
        cols = {r.column: F.lit("x") for r in gold.FACT_ENCOUNTER_RULES} | {"date": F.lit(d), "encounter_id": F.col("id")}
        return spark.createDataFrame([(i,) for i in ids], "id string").select(*[c.alias(n) for n, c in cols.items()])

    def load(d, ids, policy="report"):
        report = DayReport(d)
        _store_gold(spark, day(d, ids), "fact_encounter", d, d, layout, report, policy,
                    lambda rows, target: materialize(rows, target, "date", d))
        return report.quality["fact_encounter"]["encounter_id:unique"]
    assert load(D[0], ["a", "b"]) == 0
    assert load(D[1], ["b", "c", "c"]) == 2
    assert load(D[1], ["c"]) == 0                       # sent again
    with pytest.raises(QualityError):
        load(D[2], ["a"], "fail")
    assert load(D[2], ["d"], "fail") == 0
    rows = read_table(spark, layout.gold("fact_encounter")).select("encounter_id", "date").collect()
    assert sorted(map(tuple, rows)) == [("a", D[0]), ("b", D[0]), ("c", D[1]), ("d", D[2])]
