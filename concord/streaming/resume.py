"""Resumable ingestion and task state with Structured Streaming.

Landed files are read as a stream with an explicit schema; a checkpoint folder
makes a run continue where the last one ended, and the natural key keeps a page
that lands twice from counting twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from concord.plans.registry import query
from concord.session import fresh_path, table

PARTS = 64


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, key: list[str]) -> DataFrame:
    """Append what has landed in ``source`` since the last run to ``target``, once per key; returns the target.

    Every micro-batch takes only keys that the target does not hold, however late
    they come; a batch that is run again after a failure finds its rows there. The
    target is laid out by a hash of the key, and a batch reads the parts it touches.
    """
    parted = StructType([*schema.fields, StructField("key_part", IntegerType())])
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{target}/key_part=0")

    def append(batch: DataFrame, _: int) -> None:
        rows = batch.dropDuplicates(key).withColumn("key_part", F.pmod(F.hash(*key), F.lit(PARTS)))
        touched = [r.key_part for r in rows.select("key_part").distinct().collect()]
        held = spark.read.schema(parted).parquet(target).where(F.col("key_part").isin(touched)).select(*key)
        rows.join(held, key, "left_anti").select(*parted.names).repartition("key_part").write.mode("append").partitionBy("key_part").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(parted).parquet(target).select(*schema.names)


@query("select event_type, count(*)::bigint as n, count(distinct user_id)::bigint as users from events group by event_type")
def stream_resume(spark, sf_dir):
    """Events land in two parts that overlap, late ones in the second; two runs of the stream give each event once."""
    events = table(spark, sf_dir, "events")
    landed, target, checkpoint = (fresh_path(spark, x) for x in ("landed", "ingested", "progress"))
    for part in ("event_id % 3 < 2", "event_id % 3 > 0"):
        events.where(part).write.mode("append").parquet(landed)
        rows = ingest(spark, landed, events.schema, target, checkpoint, ["event_id"])
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
