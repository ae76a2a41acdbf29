"""Session helpers shared by every subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: The folders made within the innermost ``scratch`` of this thread or task; None outside of any.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def build_session(app: str = "concord", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the library expects (UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be any that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    In local mode (tests, notebooks), where none is set, a temporary folder is made
    and kept in the session's settings; on a cluster that is an error, since its
    executors would not share such a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("concord.shared.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="concord-")
        spark.conf.set("concord.shared.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


class Scratch:
    """The folders made within a ``with scratch(spark)`` block, by this caller only."""

    def __init__(self, spark: SparkSession, made: list[str]) -> None:
        self.spark, self.made = spark, made

    def discard(self, *keep: DataFrame) -> None:
        """Delete the block's folders so far but those of ``keep``, results of ``written``; frames that read the others are of no use any more."""
        self._delete(set(self.made) - {df.written_to for df in keep})
        # shuffle files of the plans that are over stay until the driver's JVM collects its garbage
        self.spark._jvm.System.gc()

    def drop(self, *frames: DataFrame) -> None:
        """Delete the folders of these results of ``written``."""
        self._delete({df.written_to for df in frames})

    def _delete(self, paths: set[str]) -> None:
        for path in [p for p in self.made if p in paths]:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
            self.made.remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A block whose folders can be deleted; those left at its end are the outer block's. Blocks of other threads are apart."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield Scratch(spark, made)
    finally:
        _MADE.reset(token)
        outer = _MADE.get()
        if outer is not None:
            outer += made
