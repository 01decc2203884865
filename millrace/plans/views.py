"""The driver's tables seen as timed records, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import dealt, read


def seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events as timed events of a video: ten minutes for each unit of value."""
    s = seconds(F.col("ts"))
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), "event_id", "event_type", s.alias("start_time"), (s + F.col("value") * 600).alias("end_time"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as contiguous scenes of a video, as long as their quantity; some have a gap before them."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    to = F.sum("l_quantity").over(w.rowsBetween(Window.unboundedPreceding, 0))
    gap = (F.col("l_linenumber") % 3 == 0).cast("int")
    shift = F.sum(gap).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = dealt(read(spark, sf_dir, "lineitem"), "l_orderkey").select(F.col("l_orderkey").alias("video_id"), F.row_number().over(w).cast("bigint").alias("scene_id"), (to - F.col("l_quantity") + shift).alias("start_time"), (to + shift).alias("end_time"), "l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_linenumber", "l_suppkey")
    return out.withColumn("objects", F.array(F.col("l_returnflag"), F.col("l_linestatus"), (F.col("l_suppkey") % 3).cast("string")))


TIMELINE = "timeline AS (SELECT user_id AS video_id, event_id, event_type, epoch_us(ts) / 1e6 AS start_time, epoch_us(ts) / 1e6 + value * 600 AS end_time FROM events)"
SCENES = """lines AS (SELECT *, row_number() OVER w AS scene_id, sum(l_quantity) OVER w AS upto, sum(CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END) OVER w AS shift FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
scenes AS (SELECT l_orderkey AS video_id, scene_id, upto - l_quantity + shift AS start_time, upto + shift AS end_time, l_returnflag, l_linestatus, l_discount, l_tax, l_linenumber, l_suppkey, [l_returnflag, l_linestatus, (l_suppkey % 3)::VARCHAR] AS objects FROM lines)"""
NORM = r"trim(regexp_replace(regexp_replace(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}_\s%'']', ' ', 'g'), '\s+', ' ', 'g'))"


def norm_sql(column: str) -> str:
    return NORM.format(column)
