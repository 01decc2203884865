"""On-screen text: detections to tracks, fragments, misreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.media import one_edit
from ..functions.text import normalize_text
from . import temporal


def readable(text: Column) -> Column:
    """Enough letters and digits, a vowel in some word, and no long run of one character."""
    t = F.trim(text)
    letters = F.length(F.regexp_replace(t, r"(?U)[^\p{L}\p{N}]", ""))
    return (letters >= 2) & (letters * 2 >= F.length(t)) & t.rlike(r"(?i)[aeiouy0-9]") & ~t.rlike(r"(.)\1{4,}")


def tracks(detections: DataFrame, gap: float = 3.0) -> DataFrame:
    """(video_id, text, start_time, end_time, n): detections of equal normalised text, no further apart than ``gap``."""
    spans = detections.select("video_id", normalize_text(F.col("text")).alias("text"), F.col("t").alias("start_time"), F.col("t").alias("end_time")).filter("text <> ''")
    return temporal.gap_islands(spans, ["video_id", "text"], gap).drop("island")


def fragments(found: DataFrame, near: float = 2.0, width: float = 30.0) -> DataFrame:
    """(video_id, text, start_time, whole): tracks whose text is part of a longer one shown at that time;
    the longest such text, then the one seen most.

    Tracks meet in time buckets, so a long video's tracks are compared with their neighbours only.
    """
    a = found.withColumn("_end", F.col("end_time") + near)
    padded = a.select("video_id", "text", "n", "start_time", F.col("_end").alias("end_time"))
    longer = padded.withColumnRenamed("text", "whole")
    met = temporal.interval_join(padded, longer, width=width).filter((F.length("text") < F.length("r_whole")) & F.col("r_whole").contains(F.col("text")))
    return met.groupBy("video_id", "text", "start_time").agg(F.max_by("r_whole", F.struct(F.length("r_whole"), "r_n", "r_whole")).alias("whole"))


def misreads(found: DataFrame, near: float = 2.0, width: float = 30.0) -> DataFrame:
    """(video_id, text, start_time, likely): tracks one edit from a neighbour that was seen more often."""
    padded = found.select("video_id", "text", "n", "start_time", (F.col("end_time") + near).alias("end_time"))
    met = temporal.interval_join(padded, padded, width=width).filter((F.col("n") < F.col("r_n")) & (F.col("text") != F.col("r_text")) & one_edit(F.col("text"), F.col("r_text")))
    return met.groupBy("video_id", "text", "start_time").agg(F.max_by("r_text", F.struct("r_n", "r_text")).alias("likely"))


def prefix_families(found: DataFrame, least: int = 4) -> DataFrame:
    """Tracks with ``family``: the longest text in the video that begins with theirs (typed-out captions)."""
    w = Window.partitionBy("video_id").orderBy(F.col("text").desc())
    ahead = F.lag("text").over(w)
    grown = F.coalesce((F.length("text") >= least) & ahead.startswith(F.col("text")), F.lit(False))
    marked = found.withColumn("_new", (~grown).cast("int")).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.withColumn("family", F.max_by("text", F.length("text")).over(Window.partitionBy("video_id", "_g"))).drop("_new", "_g")
