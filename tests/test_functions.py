import datetime as dt

from pyspark.sql import functions as F

from laketide import functions as LF
from laketide.functions.names import normalize_columns, recast_for_export


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_clean_string(spark):
    got = one_col(spark, ['Café — "ok" (50%)!', "", "—©™", "  lee", None, "o'brien", "tab\there"],
                  LF.clean_string)
    assert got == ['Caf  "ok" (50%)!', "", "", "lee", None, "o'brien", "tab\there"]


def test_title_case(spark):
    got = one_col(spark, ["o'brien", "mary-ann", "  lee", "SYLVIA", None, "3rd street", "josé o'neil"],
                  LF.title_case)
    assert got == ["O'Brien", "Mary-Ann", "  Lee", "Sylvia", None, "3rd Street", "José O'Neil"]


def test_full_name(spark):
    df = spark.createDataFrame([("mary", "lee"), (None, "lee"), ("mary", None), (None, None)], "f string, l string")
    got = [r[0] for r in df.select(LF.full_name("f", "l")).collect()]
    assert got == ["mary lee", "lee", "mary", None]


def test_decode(spark):
    assert one_col(spark, ["M", "S", "D", "X", None], LF.marital_status) == \
        ["MARRIED", "SINGLE", "DIVORCE", "(unknown)", "(unknown)"]
    assert one_col(spark, ["F", "M", "x", None], LF.gender) == ["FEMALE", "MALE", "(unknown)", "(unknown)"]


def test_parse_double(spark):
    assert one_col(spark, ["12.5", "1e3", "abc", "", None], LF.parse_double) == [12.5, 1000.0, None, None, None]


def test_parse_timestamp(spark):
    got = one_col(spark, ["2022-01-05 23:50:00", "2022-01-05T23:50:00Z", "bad"],
                  lambda c: LF.parse_timestamp(c).cast("timestamp_ntz"))
    assert got == [dt.datetime(2022, 1, 5, 23, 50), dt.datetime(2022, 1, 5, 23, 50), None]


def test_stay_across_midnight(spark):
    df = spark.createDataFrame([("2022-01-05 23:50:00", "2022-01-06 00:10:00")], "a string, b string")
    df = df.select(LF.parse_timestamp("a").alias("a"), LF.parse_timestamp("b").alias("b"))
    r = df.select(LF.days_between("b", "a").alias("d"), LF.minutes_between("b", "a").alias("m"),
                  LF.to_day("b").alias("day"), LF.day_text("a").alias("t")).first()
    assert (r.d, r.m, r.day, r.t) == (1, 20.0, dt.date(2022, 1, 6), "2022-01-05")


def test_row_hash_null_and_empty(spark):
    df = spark.createDataFrame([(1, None, 2.5), (1, "", 2.5), (1, "a", 2.5)], "k long, s string, v double")
    h = [r[0] for r in df.select(LF.row_hash(["k", "s", "v"])).collect()]
    assert h[0] == h[1] != h[2]
    import hashlib
    assert h[2] == hashlib.md5(b"1::a::2.5").hexdigest()


def test_surrogate_key_deterministic(spark):
    df = spark.createDataFrame([(7,)], "k long")
    k = df.select(LF.surrogate_key("k", F.lit(dt.date(2022, 1, 1)))).first()[0]
    import hashlib
    assert k == hashlib.md5(b"7::2022-01-01").hexdigest()


def test_hash_columns_excludes_scd_columns():
    cols = ["dim_key", "id", "a", "start_date", "end_date", "is_active"]
    assert LF.hash_columns(cols, surrogate_key="dim_key") == ["id", "a"]


def test_normalize_and_recast(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 1, 0, 0, 10), dt.date(2022, 1, 2), 1)],
                               "`Start Time` timestamp, `Birth-Day` date, `N` int")
    df = df.withColumn("Amount", F.lit("12.34").cast("decimal(10,2)"))
    out = recast_for_export(normalize_columns(df))
    assert out.columns == ["start_time", "birth_day", "n", "amount"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "string", "int", "double"]
    r = out.first()
    assert (r.start_time, r.birth_day, r.amount) == (1640995210, "2022-01-02", 12.34)


def test_title_case_knows_accents_and_run_dates_are_strict(spark):
    import datetime as dt

    import pytest

    from laketide.functions import text as LT
    from laketide.functions.dates import run_date
    df = spark.createDataFrame([("renée o'brien FRANÇOIS müller-élan ßx",)], "s string")
    assert df.select(LT.title_case("s").alias("t")).first().t == "Renée O'Brien François Müller-Élan ßx"
    assert run_date("2022-01-01") == dt.date(2022, 1, 1) and run_date("2022-01-01 10:00:00") == dt.date(2022, 1, 1)
    with pytest.raises(ValueError):
        run_date("2022-01-01garbage")


def test_csv_columns_are_found_by_name(spark, scratch):
    import pytest

    from laketide.sources.files import read_csv
    with open(f"{scratch}/a.csv", "w") as f:
        f.write("extra,b,a\n9,2,1\n")
    df = read_csv(spark, f"{scratch}/a.csv", ["a", "b"])
    assert df.columns == ["a", "b", "extra"] and tuple(df.first()) == ("1", "2", "9")
    with pytest.raises(ValueError, match="lacks c"):
        read_csv(spark, f"{scratch}/a.csv", ["a", "c"])
