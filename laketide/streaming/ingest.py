from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from laketide.functions.dates import parse_timestamp
from laketide.plans.bronze import EVENT_TABLES, PART_COL
from laketide.sources.schemas import raw_schema


def event_days(df, start_col: str, stop_col: str, out_col: str = PART_COL):
    """Each event once per distinct day among its start and stop days; an
    event with no usable time is kept once, in the undated (NULL)
    partition."""
    days = F.array_distinct(F.array(F.to_date(parse_timestamp(start_col)),
                                    F.to_date(parse_timestamp(stop_col))))
    return df.select("*", F.explode_outer(F.filter(days, lambda d: d.isNotNull())).alias(out_col))


def start_event_ingest(spark: SparkSession, source_dir: str, table: str, target: str,
                       checkpoint: str, *, available_now: bool = True,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the streaming ingest of raw ``table`` files (CSV with header)
    from ``source_dir`` into the date-partitioned Parquet table ``target``.

    ``checkpoint`` must be on shared storage (it records which files were
    processed); the file sink's own log makes the output exactly-once, so a
    restarted query neither loses nor duplicates rows.
    """
    start, stop = EVENT_TABLES[table]
    reader = spark.readStream.schema(raw_schema(table)).option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(source_dir)
    out = event_days(raw, start, stop)
    writer = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .partitionBy(PART_COL).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target)
