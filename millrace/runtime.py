"""Session helpers shared by every part of the engine."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Arrow batches stay small, so that a Python worker holds few long texts at once.
ARROW_ROWS = 1000
ARROW_BYTES = 4 << 20
#: Kept frames of a known number of rows get one file for so many.
ROWS_A_FILE = 500_000
#: Bytes of a table's files that one task of a keyed window gets.
SCAN_BYTES = 8 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session, and let Python workers find this package.

    Cluster settings that are already tighter stay. Workers look where the driver has the package
    besides where they look anyway, as it may be on the driver's path only by its working folder.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), root)))
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that ``spark.checkpoint.dir`` names.

    Only a session whose executors are threads of the driver gets a folder of its own instead.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="millrace-checkpoint-"))


def durable(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """Compute once, keep in the shared checkpoint folder and cut the lineage there.

    The copy is reliable storage, so a lost executor costs only its running tasks. Of a frame
    known to have ``rows`` rows at most, no more than one file for each ``ROWS_A_FILE`` is kept.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    return (frame if rows is None else frame.coalesce(1 + rows // ROWS_A_FILE)).checkpoint(eager=True)


def settled(frame: DataFrame) -> DataFrame:
    """The frame, kept if a shuffle made it: then the order of its rows is no longer a matter of luck.

    Row numbers of a scan or of a kept frame are the same at every evaluation.
    """
    return durable(frame) if "Exchange" in frame._jdf.queryExecution().executedPlan().toString() else frame


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, or with as many underscores before it as it takes to be no column of the frame."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table by Spark's own reader, so that any store Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def dealt(frame: DataFrame, *keys: str) -> DataFrame:
    """A scan dealt out by its keys to as many partitions as it has ``SCAN_BYTES``, if those are more than a shuffle has.

    So what a task sorts doesn't grow with the table, whatever the session's number of partitions.
    """
    parts = int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // SCAN_BYTES
    return frame.repartition(parts, *keys) if parts > shuffle_width(frame.sparkSession) else frame


def spread(frame: DataFrame) -> DataFrame:
    """A scan of fewer partitions than there are cores, dealt over all of them; a larger one as it is.

    For small files only: a table of many row groups has its partitions already.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame._jdf.queryExecution().toRdd().getNumPartitions() >= cores else frame.repartition(cores)
