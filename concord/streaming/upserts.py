"""An upsert sink: a log of revisions written by micro-batches, and the latest row of each key.

Every micro-batch overwrites its own folder of the log, so a batch that runs again
after a failure changes nothing. Reading folds the log by key and revision; older
revisions that come late never replace newer ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.relational import latest
from concord.plans.registry import query
from concord.session import fresh_path, table


def upsert(spark: SparkSession, source: str, schema, log: str, checkpoint: str, keys: list[str], revision: list[str]) -> DataFrame:
    """Take what has landed in ``source`` since the last run into ``log``; returns the latest row of each key."""

    def write(batch: DataFrame, number: int) -> None:
        latest(batch, keys, revision).write.mode("overwrite").parquet(f"{log}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return latest(spark.read.schema(schema).option("basePath", log).parquet(f"{log}/batch=*"), keys, revision)


@query("select user_id, max_by(event_type, (ts, event_id)) as status, max_by(event_id, (ts, event_id)) as event_id, 1::bigint as rows from events group by user_id")
def upsert_log(spark, sf_dir):
    """Later days land first; the second run's older revisions change nothing for keys that have newer ones."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    landed, log, checkpoint = (fresh_path(spark, x) for x in ("landed", "log", "progress"))
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (F.col("ts") >= split, F.col("ts") < split):
        events.where(part).write.mode("append").parquet(landed)
        rows = upsert(spark, landed, events.schema, log, checkpoint, ["user_id"], ["ts", "event_id"])
    return rows.groupBy("user_id").agg(F.max("event_type").alias("status"), F.max("event_id").alias("event_id"), F.count("*").alias("rows"))
