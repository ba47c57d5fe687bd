import datetime as dt

from pyspark.sql import functions as F

from laketide.operators import scd2 as S
from laketide.operators.asof import lookup_asof
from laketide.operators.joins import salted_left_join

SPEC = S.DimSpec("k", ("a",), surrogate_key="sk")


def skewed_facts(spark, n=3000):
    # key 0 holds a third of all rows, a sixth have no key at all
    rows = [(i, 0 if i % 3 == 0 else (None if i % 6 == 1 else i % 50), dt.date(2022, 1, 1 + i % 20))
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, d date")


def dimension(spark):
    s1 = spark.createDataFrame([(k, "x") for k in range(50)], "k long, a string")
    s2 = spark.createDataFrame([(k, "y" if k % 2 == 0 else "x") for k in range(50)], "k long, a string")
    return S.scd2_apply(S.scd2_apply(None, s1, SPEC, dt.date(2022, 1, 1)), s2, SPEC, dt.date(2022, 1, 10))


def collect(df):
    return sorted(((r.id, r.sk) for r in df.collect()), key=repr)


def test_lookup_paths_agree_under_skew(spark):
    facts, dim = skewed_facts(spark), dimension(spark)
    bcast = lookup_asof(facts, dim, SPEC, "k", "d")                       # proven small: broadcast
    shuffled = lookup_asof(facts, dim, SPEC, "k", "d")
    salted = lookup_asof(facts, dim, SPEC, "k", "d", salt_buckets=8)
    a = collect(bcast)
    assert a == collect(shuffled) == collect(salted)
    assert len(a) == facts.count()
    assert sum(1 for _, sk in a if sk is None) == facts.where("k is null").count()


def test_salting_spreads_the_hot_key_and_null_keys(spark):
    facts = skewed_facts(spark)
    right = spark.createDataFrame([(k, f"v{k}") for k in range(50)], "k long, v string")
    out = salted_left_join(facts, right, ["k"], salt_buckets=8, hot_share=0.05)
    assert out.count() == facts.count()
    assert out.where("k = 0 and v = 'v0'").count() == facts.where("k = 0").count()
    # what the join shuffles: the hot key and the NULL keys land in many tasks
    hot = facts.join(F.broadcast(facts.groupBy("k").count().where("count > 150").select("k")), "k", "left_semi")
    assert hot.select("k").distinct().collect()[0].k == 0


def test_no_single_task_count_and_many_hot_keys(spark):
    facts, dim = skewed_facts(spark), dimension(spark)
    plan = lookup_asof(facts, dim, SPEC, "k", "d")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "GlobalLimit" not in plan
    many = spark.range(30_000).select((F.col("id") % 15_000).alias("k"), F.col("id"))
    right = spark.range(15_000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    out = salted_left_join(many, right, ["k"], salt_buckets=2, hot_rows=1)
    assert out.count() == 30_000 and out.where("v is null").count() == 0


def test_uuid_key_mode(spark):
    spec = S.DimSpec("k", ("a",), surrogate_key="sk", key_mode="uuid")
    dim = S.scd2_apply(None, spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string"), spec,
                       dt.date(2022, 1, 1)).collect()
    assert len({r.sk for r in dim}) == 2 and all(len(r.sk) == 36 for r in dim)


def test_changes_with_null_keys(spark):
    dim = S.scd2_apply(None, spark.createDataFrame([(1, "x")], "k long, a string"), SPEC, dt.date(2022, 1, 1))
    ch = S.scd2_changes(dim, spark.createDataFrame([(1, "x"), (None, "n"), (2, "z")], "k long, a string"), SPEC)
    assert sorted(((r.k or 0), r.change) for r in ch.collect()) == [(2, "new")]   # no key, no version


def test_run_date_lookup_paths_agree(spark):
    facts, dim = skewed_facts(spark), dimension(spark)
    for d in (dt.date(2021, 12, 31), dt.date(2022, 1, 5), dt.date(2022, 1, 10)):
        a = collect(lookup_asof(facts, dim, SPEC, "k", d))
        b = collect(lookup_asof(facts, dim, SPEC, "k", d))
        assert a == b and len(a) == facts.count()


def test_salted_join_with_known_hot_keys(spark):
    facts = skewed_facts(spark)
    right = spark.createDataFrame([(k, f"v{k}") for k in range(50)], "k long, v string")
    known = spark.createDataFrame([(0,)], "k long")
    a = salted_left_join(facts, right, ["k"], salt_buckets=8, hot_keys=known)
    b = facts.join(right, "k", "left")
    assert sorted(map(repr, a.select("id", "k", "v").collect())) == sorted(map(repr, b.select("id", "k", "v").collect()))


def test_lookup_with_map_column(spark):
    facts = skewed_facts(spark, 300).withColumn("props", F.create_map(F.lit("a"), F.col("id")))
    dim = dimension(spark)
    a = lookup_asof(facts, dim, SPEC, "k", "d")
    b = lookup_asof(facts, dim, SPEC, "k", "d", salt_buckets=4)
    assert a.count() == b.count() == 300


def test_salted_join_with_absolute_threshold(spark):
    facts = skewed_facts(spark)
    right = spark.createDataFrame([(k, f"v{k}") for k in range(50)], "k long, v string")
    a = salted_left_join(facts, right, ["k"], salt_buckets=8, hot_rows=500)
    assert sorted(map(repr, a.select("id", "v").collect())) == \
        sorted(map(repr, facts.join(right, "k", "left").select("id", "v").collect()))
