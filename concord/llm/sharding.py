"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters the records by seeded hashes into buckets that fit a task's
memory: the shard of a record is the one with the largest seeded hash of (id,
shard number), its bucket within the shard a second seeded hash of id, text and
place in the input, among as many buckets as the shard's measured bytes ask for;
so neither an id that many records share nor rows that are equal in every column
gather in one bucket. Each bucket is one partition. Pass two sorts a bucket by a
hash of its records, so that the order in which they arrived does not matter,
shuffles it with Spark's Fisher-Yates ``shuffle`` and writes it into its shard's
folder. A record's slot is its place in its bucket plus the number of records in
the shard's earlier buckets. Equal input files and seeds give equal slots.

The law is ``key``: id and shard count decide the shard, and with one more shard
a record either stays or moves into the new one, since only the new shard's hash
can exceed the present largest.

Defined results: null texts have no bytes; null ids are one key; rows that repeat
an id share its shard but have slots of their own; an empty table gives no rows;
all columns are written as they are, but those named shard, bucket, place and
slot, which the result's own replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.common import kept
from concord.session import fresh_path

SHARDS = 16
SEED = 17
#: Bytes of a bucket, which one task gathers, and what a record weighs besides its text.
BUCKET_BYTES = 16 << 20
RECORD_BYTES = 64


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the largest seeded hash of (key, shard)."""
    weights = F.array(*(F.xxhash64(F.lit(seed), key, F.lit(s)) for s in range(shards)))
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def write_shards(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``documents`` to ``path`` in shard folders (shard=0, ...); returns them with shard, bucket, place and slot."""
    spark = documents.sparkSession
    shard = shard_of(F.col(doc_id), shards, seed)
    measured = documents.groupBy(shard.alias("shard")).agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).alias("bytes"))
    held = {r["shard"]: r["bytes"] for r in measured.collect()}  # a row per shard
    each = [max(1, -(-int(held.get(s, 0)) // bucket_bytes)) for s in range(shards)]
    of_shard = lambda values, at: F.get(F.array(*(F.lit(v) for v in values)), at)
    record = F.struct(*(F.col(c) for c in kept(documents, None, ("shard", "bucket", "place", "slot"))))
    hashed = F.xxhash64(F.lit(~seed), F.col(doc_id), F.col(text))
    placed = documents.select(shard.alias("shard"), hashed.alias("hash"), F.xxhash64(hashed, F.monotonically_increasing_id()).alias("spread"), record.alias("record"))
    bucket = (of_shard([sum(each[:s]) for s in range(shards)], F.col("shard")) + F.pmod("spread", of_shard(each, F.col("shard")))).cast("int")
    rows = placed.select("shard", bucket.alias("bucket"), F.struct("hash", F.xxhash64("record").alias("all"), "spread", "record").alias("r"))
    gathered = rows.repartitionById(sum(each), "bucket").groupBy("bucket", "shard").agg(F.collect_list("r").alias("records"))
    # the hashes nearly always settle the order, so that records need not be comparable
    by_hash = F.array_sort("records", lambda a, b: sum((F.when(a[c] < b[c], F.lit(-w)).when(a[c] > b[c], F.lit(w)).otherwise(F.lit(0)) for c, w in (("hash", 4), ("all", 2), ("spread", 1))), F.lit(0)))
    shuffled = gathered.select("bucket", "shard", F.posexplode(F.shuffle(by_hash, seed)).alias("place", "r")).select("bucket", "place", "r.record.*", "shard")
    shuffled.write.partitionBy("shard").parquet(path)
    back = spark.read.schema(shuffled.schema).parquet(path)
    sizes = back.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    # a row per bucket, so a shard's running total is short whatever the records
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    return back.join(offsets.select("bucket", F.struct("earlier").alias("slot")), "bucket").withColumn("slot", F.col("slot.earlier") + F.col("place"))


def shard_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shards in the shared folder, and for every record its size, CRC, shard, slot and shard among one more."""
    path = fresh_path(documents.sparkSession, "shards")
    rows = write_shards(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32")), path, shards=shards, seed=seed)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", shard_of(F.col("doc_id"), shards + 1, seed).alias("grown_shard"))
