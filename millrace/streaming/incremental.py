"""Incremental processing: content hashes, keyed state, and streams over the same transforms."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.ids import content_hash

JOB_STATES = ("registered", "rights_checked", "acquired", "decoded", "measured", "cut", "captioned", "validated", "deduplicated", "split", "staged", "published", "verified")
FAILURES = ("failed", "blocked")


def hashed(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn("content_hash", content_hash(*[F.col(c) for c in sorted(rows.columns) if c != key]))


def ingest(known: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """(key, change): fresh rows as new, changed or unchanged against known content hashes."""
    told = hashed(fresh, key).select(key, "content_hash").join(known.select(key, F.col("content_hash").alias("was")), key, "left")
    return told.select(key, F.when(F.col("was").isNull(), F.lit("new")).when(F.col("was") == F.col("content_hash"), F.lit("unchanged")).otherwise(F.lit("changed")).alias("change"))


def pending(items: DataFrame, done: DataFrame, key: str, step: str, input_hash: Column) -> DataFrame:
    """Items whose (key, step) isn't done for this input."""
    memo = done.filter(F.col("step") == step).select(key, "input_hash")
    return items.withColumn("input_hash", input_hash).join(memo, [key, "input_hash"], "left_anti")


def advance(jobs: DataFrame, events: DataFrame, key: str = "source_id") -> DataFrame:
    """(key, state, error): the furthest good state of each job, and the failure after it if there is one.

    ``events``: key, seq, state. A failure stands beside the last good state until a later good one.
    """
    order = F.coalesce(*[F.when(F.col("state") == s, F.lit(i)) for i, s in enumerate(JOB_STATES)], F.lit(-1))
    good, bad = F.col("state").isin(*JOB_STATES), F.col("state").isin(*FAILURES)
    told = events.withColumn("_o", order).groupBy(key).agg(F.max_by("state", F.when(good, F.col("seq"))).alias("state"), F.max(F.when(good, F.col("seq"))).alias("_g"), F.max(F.when(bad, F.col("seq"))).alias("_b"), F.max_by("state", F.when(bad, F.col("seq"))).alias("_f"))
    return jobs.select(key).join(told, key, "left").select(key, F.coalesce("state", F.lit(JOB_STATES[0])).alias("state"), F.when(F.col("_b") > F.coalesce("_g", F.lit(-1)), F.col("_f")).alias("error"))


def reset_downstream(stages: DataFrame, order: list[str], changed: DataFrame, key: str = "video_id") -> DataFrame:
    """Stage rows, with those at or after a changed stage (key, stage) of their key back to pending."""
    rank = lambda c: F.coalesce(*[F.when(c == s, F.lit(i)) for i, s in enumerate(order)], F.lit(len(order)))
    first = changed.groupBy(key).agg(F.min(rank(F.col("stage"))).alias("_first"))
    joined = stages.join(first, key, "left")
    return joined.withColumn("status", F.when(rank(F.col("stage")) >= F.col("_first"), F.lit("pending")).otherwise(F.col("status"))).drop("_first")


def sessions(events: DataFrame, key: str, time: str, gap: str) -> DataFrame:
    """(key, start, end, n): islands of events no further apart than ``gap``; batch or streaming."""
    return events.groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def sliding_counts(events: DataFrame, key: str, time: str, length: str, hop: str, value: str | None = None) -> DataFrame:
    """(key, start, n, total) of sliding windows; batch or streaming."""
    total = F.sum(value) if value else F.lit(None).cast("double")
    return events.groupBy(key, F.window(time, length, hop).alias("w")).agg(F.count(F.lit(1)).alias("n"), total.alias("total")).select(key, F.col("w.start").alias("start"), "n", "total")


def stream_sessions(spark: SparkSession, path: str, ddl: str, key: str, time: str, gap: str, late: str) -> DataFrame:
    """Sessions of a directory of Parquet files that grows; rows later than ``late`` are left out."""
    return sessions(spark.readStream.schema(ddl).parquet(path).withWatermark(time, late), key, time, gap)


def stream_upserts(source: DataFrame, table: str, key: str, checkpoint: str, order: str | None = None, prepare: Callable[[DataFrame], DataFrame] = lambda d: d, parts: int = 64) -> StreamingQuery:
    """A stream's rows merged by key into a Parquet table of ``parts`` partitions by the key's hash.

    Of a key's rows the one of the greatest ``order`` counts, of equal ones and without an order
    the one of the greatest content. A batch reads and rewrites only the partitions its keys
    fall in, under a version of its own; ``upserted`` takes of each
    partition the latest finished version. A batch that is run again writes the same
    version; a table that is there already, from whatever checkpoint, is carried on.
    ``order`` compares with the table too: a late older row doesn't replace a newer one.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        ready = prepare(batch)
        ranked = [*([F.col(order)] if order else []), F.to_json(F.struct(*ready.columns))]
        best = Window.partitionBy(key).orderBy(*[c.desc() for c in ranked])
        rows = ready.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n").withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
        old = upserted(spark, table, before=(checkpoint, epoch))
        if old is not None:
            touched = old.join(rows.select("part").distinct(), "part", "left_semi")
            if order:
                later = rows.join(touched.select(key, F.col(order).alias("_was")), key).filter(F.col("_was") > F.col(order)).select(key)
                rows = rows.join(later, key, "left_anti")
            rows = rows.unionByName(touched.join(rows.select(key), key, "left_anti"), allowMissingColumns=True)
        rows.write.mode("overwrite").partitionBy("part").parquet(f"{table}/{_version(spark, table, checkpoint, epoch)}")

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Names of a table's finished versions, oldest first: v<number>_<batch of a checkpoint>."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [s.getPath().getParent().getName() for s in files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/v*/_SUCCESS"))] if files.exists(root) else []
    return sorted(done, key=lambda n: int(n[1:].split("_")[0]))


def _version(spark: SparkSession, table: str, checkpoint: str, epoch: int) -> str:
    """The batch's own version if it was written before, else the next one."""
    tag = f"{zlib.crc32(checkpoint.encode()):08x}-{epoch}"
    known = _versions(spark, table)
    return next((n for n in known if n.split("_")[1] == tag), f"v{int(known[-1][1:].split('_')[0]) + 1 if known else 0}_{tag}")


def upserted(spark: SparkSession, table: str, before: tuple[str, int] | None = None) -> DataFrame | None:
    """The table's present rows with their ``part``: of each partition those of its latest version; None if there is none."""
    names = _versions(spark, table)
    if before:
        own = _version(spark, table, *before)
        names = [n for n in names if int(n[1:].split("_")[0]) < int(own[1:].split("_")[0])]
    if not names:
        return None
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(f"{table}/{n}").withColumn("_v", F.lit(k)) for k, n in enumerate(names)])
    newest = rows.groupBy("part").agg(F.max("_v").alias("_v"))
    return rows.join(F.broadcast(newest), ["part", "_v"], "left_semi").drop("_v")
