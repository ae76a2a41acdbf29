"""State kept up: cached answers with their own life, stored files checked again, damaged state repaired, a catalogue synchronised.

Defined results: an answer that cannot be parsed or dated is no answer; files are
matched by name; repairs give the same rows when they run again; a change of a
process without documents leaves it with an empty chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.functions import records as N

#: Lives of an answer and of an empty one in seconds (fixed values).
LIFE, EMPTY_LIFE = 86_400, 300


def answers_as_of(saves: DataFrame, asks: DataFrame, life: float | None = LIFE, empty_life: float | None = EMPTY_LIFE, bucket_seconds: int = 86_400) -> DataFrame:
    """``asks`` (key, ask_id, at) with payload, the last answer saved until then if it is still fresh, else null.

    ``saves`` are (key, save_id, at, payload, life, empty_life, saved_at): the lives of
    the entry in seconds, null for the defaults (None: no end), and its time as text.
    A payload that is no JSON or a time that cannot be read is a miss, a time after
    the ask is fresh. An as-of join over buckets of time, so that a hot key's rows are
    not one task's: the last save before a bucket comes from the buckets' last ones.
    """
    entry = F.struct("at", "save_id", "payload", "life", "empty_life", "saved_at")
    bucket = lambda: F.floor(F.unix_seconds(F.col("at").cast("timestamp")) / bucket_seconds)
    saved = saves.select("key", bucket().alias("bucket"), F.col("at").alias("when"), F.lit(0).alias("ask"), F.lit(None).cast(asks.schema["ask_id"].dataType).alias("ask_id"), entry.alias("entry"))
    asked = asks.select("key", bucket().alias("bucket"), F.col("at").alias("when"), F.lit(1).alias("ask"), "ask_id", F.lit(None).cast(saved.schema["entry"].dataType).alias("entry"))
    both = saved.unionByName(asked)
    last = both.groupBy("key", "bucket").agg(F.max("entry").alias("last"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = last.withColumn("before", F.last("last", ignorenulls=True).over(earlier)).select("key", "bucket", "before")
    # a save at the ask's own instant counts
    within = Window.partitionBy("key", "bucket").orderBy("when", "ask", F.col("entry.save_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("own", F.last("entry", ignorenulls=True).over(within)).where("ask = 1").join(before, ["key", "bucket"])
    held = met.select("key", "ask_id", "when", F.coalesce("own", "before").alias("e"))
    limit = lambda own, default: F.coalesce(F.col(own), F.lit(default).cast("double"))
    kept = F.when(N.is_empty_payload(F.col("e.payload")), limit("e.empty_life", empty_life)).otherwise(limit("e.life", life))
    moment = F.col("e.saved_at").try_cast("timestamp")
    age = (F.unix_micros(F.col("when").cast("timestamp")) - F.unix_micros(moment)) / 1e6
    readable = F.try_parse_json("e.payload").isNotNull() & moment.isNotNull()
    fresh = readable & (kept.isNull() | (age < 0) | (age < kept))
    return held.select("key", "ask_id", F.when(fresh, F.col("e.payload")).alias("payload"))


def revalidated_files(spark: SparkSession, manifest: DataFrame, path: str, name: str) -> DataFrame:
    """``manifest`` (name, sha256, bytes) against the files under ``path``: name and status, sound, altered, missing or unlisted.

    ``name`` is a pattern whose first group names a file by its path. A full outer
    join by name with digests made in the scan, so that no contents are shuffled.
    """
    scanned = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = scanned.select(F.regexp_extract("path", name, 1).alias("name"), F.sha2("content", 256).alias("digest"), F.col("length").alias("length")).where("name <> ''")
    joined = manifest.select("name", "sha256", "bytes").join(found, "name", "full")
    same = (F.col("digest") == F.col("sha256")) & (F.col("bytes").isNull() | (F.col("bytes") == F.col("length")))
    status = F.when(F.col("digest").isNull(), "missing").when(F.col("sha256").isNull() & F.col("bytes").isNull(), "unlisted").when(F.coalesce(same, F.lit(False)), "sound").otherwise("altered")
    return joined.select("name", status.alias("status"))


def revalidated_processes(documents: DataFrame, roles: Sequence[str], required: Sequence[str]) -> DataFrame:
    """``documents`` (row_id, process, role, revision, sound) of accepted rows to the best row of each process: process, row_id, kept (its roles in order, comma-joined).

    A row needs exactly one document of each required role, sound; of other roles the
    latest revision stays if it is sound. The best row has most roles, then most
    documents, then the greatest id.
    """
    known = documents.where(F.col("role").isin(*roles)).groupBy("process", "row_id", "role").agg(F.count("*").alias("n"), F.max_by("sound", "revision").alias("sound"))
    holds = F.col("sound") & (~F.col("role").isin(*required) | (F.col("n") == 1))
    each = [F.bool_or(holds & (F.col("role") == r)).alias(f"has_{k}") for k, r in enumerate(roles)]
    rows = known.groupBy("process", "row_id").agg(F.count("*").alias("roles"), F.sum("n").alias("documents"), *each)
    whole = F.lit(True)
    for r in required:
        whole &= F.col(f"has_{list(roles).index(r)}")
    names = F.concat_ws(",", *(F.when(F.col(f"has_{k}"), r) for k, r in enumerate(roles)))
    best = rows.where(whole).groupBy("process").agg(F.max(F.struct("roles", "documents", "row_id", names.alias("kept"))).alias("m"))
    return best.select("process", "m.row_id", "m.kept")


#: The time that an unreadable one becomes (fixed value).
EPOCH = "1970-01-01T00:00:00Z"


def _instant(text: Column) -> Column:
    """A date or time as an instant; one without an offset is UTC, whatever the session's zone."""
    # a time may leave its seconds out
    plain = F.regexp_replace(F.trim(text), r"([T ][0-9]{2}:[0-9]{2})(?=$|[Zz+-])", "$1:00")
    zoned = plain.rlike(r"(?:[Zz]|[+-][0-9]{2}:?[0-9]{2})$") & F.contains(plain, F.lit(":"))
    return F.when(plain.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.when(zoned, plain).when(F.contains(plain, F.lit(":")), F.concat(plain, F.lit("Z"))).otherwise(F.concat(F.left(plain, F.lit(10)), F.lit("T00:00:00Z")))).try_cast("timestamp")


def _utc(instant: Column, form: str) -> Column:
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), form)


def repaired_budget(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (day, used, both text) to day and used, summed by the UTC day, and the quarantine: day, used, reason of each row that cannot be read."""
    day = _utc(_instant(F.col("day")), "yyyy-MM-dd")
    used = F.when(F.trim("used").rlike("^[0-9]+$"), F.trim("used")).try_cast("long")
    reason = F.concat_ws("; ", F.when(day.isNull(), "day"), F.when(used.isNull(), "used"))
    told = rows.select("day", "used", day.alias("_day"), used.alias("_used"), reason.alias("reason"))
    sums = told.where("reason = ''").groupBy(F.col("_day").alias("day")).agg(F.sum("_used").cast("string").alias("used"))
    return sums, told.where("reason <> ''").select("day", "used", "reason")


def repaired_cache(rows: DataFrame) -> DataFrame:
    """``rows`` (key, saved_at, life) with times in one form; an unreadable one is the epoch's, and its entry has no life left."""
    moment = _instant(F.col("saved_at"))
    sound = moment.isNotNull()
    return rows.select("key", F.coalesce(F.concat(_utc(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")), F.lit(EPOCH)).alias("saved_at"), F.when(sound, F.col("life")).otherwise(F.lit(0.0)).alias("life"))


def repaired_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` (source, params, page, size, task_id, status, token, until, note) with one row for each natural key (source, params, page, size): valid ids first, then the smallest.

    A leased row without a token or a lease, or whose token an earlier row holds, is pending again with a note.
    """
    key = ["source", "params", "page", "size"]
    rest = [c for c in rows.columns if c not in key]
    valid = F.coalesce(F.col("task_id") > 0, F.lit(False))
    one = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct((~valid).alias("odd"), "task_id", "status", "token", "until")).alias("m")).select(*key, "m.*")
    token = F.nullif(F.trim("token"), F.lit(""))
    told = one.withColumn("token", F.when(F.col("status") == "leased", token))
    # the first of the rows that hold a token keeps it
    first = told.where("token is not null").groupBy("token").agg(F.min("task_id").alias("holder"))
    joined = told.join(first, "token", "left")
    lost = (F.col("status") == "leased") & (F.col("token").isNull() | F.col("until").isNull() | (F.col("task_id") != F.col("holder")))
    lost = F.coalesce(lost, F.lit(True)) & (F.col("status") == "leased")
    note = F.when(F.col("token").isNull() | F.col("until").isNull(), "lease without a token or an end").otherwise("token held twice")
    back = {"status": F.when(lost, "pending").otherwise(F.col("status")), "token": F.when(~lost, F.col("token")), "until": F.when(~lost, F.col("until")), "note": F.when(lost, note).otherwise(F.col("note"))}
    return joined.select(*(back[c].alias(c) if c in back else F.col(c) for c in rows.columns))


def catalogue_of(documents: DataFrame, roles: Sequence[str], buckets: int) -> DataFrame:
    """process, bucket, chain (documents by role, in order of id), pair and complete (one document of the first two, of every role) of ``documents`` (process, document_id, role)."""
    of = lambda r: F.array_sort(F.collect_list(F.when(F.col("role") == r, F.col("document_id"))))
    rows = documents.groupBy("process").agg(*(of(r).alias(r) for r in roles))
    single = [F.size(r) == 1 for r in roles]
    every = single[0]
    for s in single[1:]:
        every &= s
    return rows.select("process", F.pmod(F.xxhash64("process"), F.lit(buckets)).cast("int").alias("bucket"), F.struct(*roles).alias("chain"), (single[0] & single[1]).alias("pair"), every.alias("complete"))


def synchronise(spark: SparkSession, documents: DataFrame, changes: DataFrame, path: str, roles: Sequence[str], buckets: int) -> DataFrame:
    """Bring the catalogue under ``path`` (``catalogue_of`` written by bucket) up to date with ``documents`` where ``changes`` (process) says that they changed; returns it.

    Only the buckets of changed processes are read and written anew; of their
    processes only the changed ones are computed again. Processes left without
    documents keep a row with an empty chain.
    """
    bucket = F.pmod(F.xxhash64("process"), F.lit(buckets)).cast("int")
    touched = changes.select("process").distinct().withColumn("bucket", bucket)
    ids = [r["bucket"] for r in touched.select("bucket").distinct().collect()]  # at most ``buckets``
    held = spark.read.parquet(path)
    old = held.where(F.col("bucket").isin(ids)).join(touched.select("process"), "process", "left_anti")
    found = catalogue_of(documents.join(touched.select("process"), "process", "left_semi"), roles, buckets)
    empty = F.array().cast(found.schema["chain"].dataType[roles[0]].dataType)
    gone = touched.join(found.select("process"), "process", "left_anti").select("process", "bucket", F.struct(*(empty.alias(r) for r in roles)).alias("chain"), F.lit(False).alias("pair"), F.lit(False).alias("complete"))
    columns = ["process", "chain", "pair", "complete", "bucket"]
    # what is kept is read before its partitions are replaced
    fresh = old.select(*columns).unionByName(found.select(*columns)).unionByName(gone.select(*columns))
    staged = f"{path}.staged"
    fresh.write.mode("overwrite").parquet(staged)
    spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return spark.read.parquet(path)
