"""Runs, segments and spans over shots, frames and samples."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def longest_run(samples: DataFrame, value: str, level: float, key: str = "video_id", order: str = "t") -> DataFrame:
    """(key, length, start, end): the longest unbroken run of samples at or above a level, the first of equal ones."""
    w = Window.partitionBy(key).orderBy(order)
    high = F.coalesce(F.col(value) >= level, F.lit(False))
    placed = samples.withColumn("_h", high).withColumn("_i", F.sum((~high).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = placed.filter("_h").groupBy(key, "_i").agg(F.count(F.lit(1)).alias("length"), F.min(order).alias("start"), F.max(order).alias("end"))
    best = Window.partitionBy(key).orderBy(F.col("length").desc(), "start")
    return runs.withColumn("_n", F.row_number().over(best)).filter("_n = 1").select(key, "length", "start", "end")


def segments(shots: DataFrame, most: int = 8, longest: float = 90.0, key: str = "video_id") -> DataFrame:
    """Shots with ``segment``, from 1: one ends as soon as it has ``most`` shots or lasts ``longest`` seconds.

    Where a segment ends depends on where it began, so a video is walked in order; the walk
    streams over sorted partitions and holds two numbers.
    """
    kind = shots.schema[key].dataType.simpleString()
    schema = StructType.fromDDL(f"{key} {kind}, scene_id string, segment long")
    arrow = to_arrow_schema(schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        video, segment, held, began = None, 0, 0, 0.0
        for batch in batches:
            out = []
            for name, _, s, e in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if name != video:
                    video, segment, held = name, 0, 0
                if held == 0:
                    segment, began = segment + 1, s
                held += 1
                out.append(segment)
                if held >= most or e - began >= longest:
                    held = 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64())], schema=arrow)

    chosen = shots.select(key, F.col("scene_id").cast("string").alias("scene_id"), F.col("start_time").cast("double").alias("s"), F.col("end_time").cast("double").alias("e"))
    return chosen.repartition(key).sortWithinPartitions(key, "s", "scene_id").mapInArrow(walk, schema)


def transitions(shots: DataFrame, kind: Column, key: str = "video_id", half: float = 0.25) -> DataFrame:
    """(key, scene_id, previous, transition, start_time, end_time): a short event around each cut whose kind is known."""
    w = Window.partitionBy(key).orderBy("start_time", "scene_id")
    told = shots.withColumn("previous", F.lag("scene_id").over(w)).withColumn("transition", kind).filter("previous IS NOT NULL AND transition IS NOT NULL")
    return told.select(key, "scene_id", "previous", "transition", F.greatest(F.lit(0.0), F.col("start_time") - half).alias("start_time"), (F.col("start_time") + half).alias("end_time"))


def filled_gaps(frames: DataFrame, most: int, key: str = "video_id", order: str = "t", priority: str = "priority") -> DataFrame:
    """At most ``most`` frames a video: those of the lowest priority number first, then one after the other where the largest gap is.

    A frame fills a gap by its distance to the nearest kept one; of equal ones the earliest. A
    video's frames are walked by one task, as each choice depends on the last; their number is
    bounded by the sampler.
    """
    kind = frames.schema[key].dataType.simpleString()

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values([priority, order])
        firsts = rows[rows[priority] == rows[priority].min()]
        kept = list(firsts[order][:most])
        rest = [t for t in rows[order] if t not in set(kept)]
        while rest and len(kept) < most:
            best = max(rest, key=lambda t: (min(abs(t - k) for k in kept), -t))
            kept.append(best)
            rest.remove(best)
        return pd.DataFrame({key: [pdf[key].iloc[0]] * len(kept), order: sorted(kept)})

    return frames.groupBy(key).applyInPandas(choose, f"{key} {kind}, {order} double")


def frame_faults(frames: DataFrame, most_gap: float, key: str = "video_id", order: str = "number", time: str = "t") -> DataFrame:
    """(key, number, fault): frames out of order, at the time of the one before, or too long after it."""
    w = Window.partitionBy(key).orderBy(order)
    step = F.col(time) - F.lag(time).over(w)
    fault = F.when(step < 0, F.lit("out_of_order")).when(step == 0, F.lit("repeated")).when(step > most_gap, F.lit("gap"))
    return frames.select(key, order, fault.alias("fault")).filter("fault IS NOT NULL")


def moving_span(points: DataFrame, least: float, key: str = "video_id", order: str = "t") -> DataFrame:
    """(key, start, end): from the first to the last step of a trajectory (x, y) that is longer than ``least``."""
    w = Window.partitionBy(key).orderBy(order)
    step = F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w))
    moved = points.withColumn("_from", F.lag(order).over(w)).withColumn("_step", step).filter(F.col("_step") > least)
    return moved.groupBy(key).agg(F.min("_from").alias("start"), F.max(order).alias("end"))


def snapped(shots: DataFrame, duration: Column, tolerance: float = 0.5, key: str = "video_id") -> DataFrame:
    """Shots whose first begins at 0 and whose last ends at the duration, if they are that close to it."""
    w = Window.partitionBy(key).orderBy("start_time", "scene_id")
    first, last = F.row_number().over(w) == 1, F.lead("scene_id").over(w).isNull()
    return shots.withColumn("_f", first).withColumn("_l", last).withColumn("_d", duration).withColumn("start_time", F.when(F.col("_f") & (F.col("start_time") <= tolerance), F.lit(0.0)).otherwise(F.col("start_time"))).withColumn("end_time", F.when(F.col("_l") & (F.abs(F.col("_d") - F.col("end_time")) <= tolerance), F.col("_d")).otherwise(F.col("end_time"))).drop("_f", "_l", "_d")


def planned_clips(shots: DataFrame, longest: float = 30.0) -> DataFrame:
    """(…, part, start_time, end_time, frames): clips of ``longest`` seconds at most, one after the other, with their number of frames at ``fps``."""
    n = F.greatest(F.lit(1), F.ceil((F.col("end_time") - F.col("start_time")) / longest))
    each = shots.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))).withColumn("_s", F.col("start_time") + F.col("part") * longest)
    cut = each.withColumn("end_time", F.least(F.col("_s") + longest, F.col("end_time"))).withColumn("start_time", F.col("_s")).drop("_s")
    return cut.withColumn("frames", F.round((F.col("end_time") - F.col("start_time")) * F.col("fps")).cast("bigint"))


def descriptions(shots: DataFrame, label: str, subjects: str, key: str = "video_id", group: str = "segment", top: int = 3) -> DataFrame:
    """(key, group, label, subjects, scene_ids, start_time, end_time): one row a group of shots.

    The label is the most frequent, of equals the least; subjects are the ``top`` most frequent,
    equals by name; scene ids stand in order of time.
    """
    base = shots.groupBy(key, group).agg(F.mode(label, True).alias(label), F.transform(F.array_sort(F.collect_list(F.struct("start_time", "scene_id"))), lambda x: x["scene_id"]).alias("scene_ids"), F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))
    counted = shots.select(key, group, F.explode(F.array_distinct(subjects)).alias("s")).groupBy(key, group, "s").agg(F.count(F.lit(1)).alias("n"))
    best = counted.withColumn("_r", F.row_number().over(Window.partitionBy(key, group).orderBy(F.col("n").desc(), "s"))).filter(F.col("_r") <= top)
    named = best.groupBy(key, group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "s"))), lambda x: x["s"]).alias("subjects"))
    return base.join(named, [key, group], "left").withColumn("subjects", F.coalesce("subjects", F.array().cast("array<string>")))


def detected(detections: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """(…, label, n, best, mean): detections as one row for each class."""
    return detections.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"), F.max(score).alias("best"), F.avg(score).alias("mean"))
