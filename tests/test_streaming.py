import datetime as dt
import os

from pyspark.sql import functions as F

from laketide.streaming import start_event_ingest
from tests.test_run import E, P1, Y1, write_csv


def test_stream_ingest_is_incremental_and_exactly_once(spark, scratch):
    src = f"{scratch}/incoming"
    os.makedirs(src)
    target, ckpt = f"{scratch}/bronze_enc", f"{scratch}/ckpt"
    write_csv(f"{src}/day1.csv", "encounters", [
        dict(Id=E[0], START="2022-01-01 10:00:00", STOP="2022-01-01 11:00:00", PATIENT=P1, PAYER=Y1),
        dict(Id=E[1], START="2022-01-01 23:50:00", STOP="2022-01-02 00:10:00", PATIENT=P1, PAYER=Y1),
    ])
    q = start_event_ingest(spark, src, "encounters", target, ckpt)
    q.awaitTermination(120)
    got = sorted((r.Id, r.partition_date) for r in spark.read.parquet(target).collect())
    assert got == [(E[0], dt.date(2022, 1, 1)), (E[1], dt.date(2022, 1, 1)), (E[1], dt.date(2022, 1, 2))]

    write_csv(f"{src}/day2.csv", "encounters", [
        dict(Id=E[2], START="2022-01-02 09:00:00", STOP="2022-01-02 09:30:00", PATIENT=P1, PAYER=Y1),
        dict(Id=E[3], START="bad", STOP="", PATIENT=P1, PAYER=Y1),
    ])
    q = start_event_ingest(spark, src, "encounters", target, ckpt)  # next "day": only the new file
    q.awaitTermination(120)
    df = spark.read.parquet(target)
    assert df.count() == 5
    assert [r.Id for r in df.where(F.col("partition_date").isNull()).collect()] == [E[3]]
    assert df.where(F.col("partition_date") == dt.date(2022, 1, 2)).count() == 2
