"""Measurements over samples and frames: labels, islands, trends, uncertainty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Upper ends of the lighting levels in mean brightness.
LEVELS = (("dark", 50.0), ("dim", 95.0), ("normal", 170.0))


def lighting_level(brightness: Column) -> Column:
    out = None
    for name, high in LEVELS:
        out = F.when(brightness < high, F.lit(name)) if out is None else out.when(brightness < high, F.lit(name))
    return F.when(brightness.isNotNull(), out.otherwise(F.lit("bright")))


def speech_confidence(mean_log_probability: Column, silence: Column) -> Column:
    """The mean token probability, less the chance that nothing was said; in [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.exp(mean_log_probability) * (1 - F.coalesce(silence, F.lit(0.0)))))


def speed_class(magnitude: Column, slow: float = 1.0, fast: float = 4.0) -> Column:
    return F.when(magnitude < slow, F.lit("slow")).when(magnitude < fast, F.lit("moderate")).otherwise(F.when(magnitude.isNotNull(), F.lit("fast")))


def position(x: Column, y: Column) -> Column:
    """Where a point of the unit square lies on a grid of three by three."""
    across = F.when(x < 1 / 3, F.lit("left")).when(x < 2 / 3, F.lit("center")).otherwise(F.lit("right"))
    down = F.when(y < 1 / 3, F.lit("top")).when(y < 2 / 3, F.lit("middle")).otherwise(F.lit("bottom"))
    return F.concat_ws("_", down, across)


def summaries(samples: DataFrame, by: list[str], means: list[str], modes: list[str]) -> DataFrame:
    """Means and medians of numbers, modes of labels; of equally frequent labels the least."""
    return samples.groupBy(*by).agg(*[F.avg(c).alias(f"{c}_mean") for c in means], *[F.median(c).alias(f"{c}_median") for c in means], *[F.mode(c, True).alias(f"{c}_mode") for c in modes])


def label_islands(samples: DataFrame, label: str, key: str = "video_id", order: str = "t") -> DataFrame:
    """(key, island, label, first, last, n): runs of one label; a single sample of another between two equal
    ones counts as theirs."""
    w = Window.partitionBy(key).orderBy(order)
    before, after = F.lag(label).over(w), F.lead(label).over(w)
    smooth = samples.withColumn("_s", F.when((before == after) & (F.col(label) != before), before).otherwise(F.col(label)))
    fresh = F.coalesce((F.col("_s") != F.lag("_s").over(w)).cast("int"), F.lit(1))
    numbered = smooth.withColumn("_new", fresh).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "island").agg(F.first("_s").alias("label"), F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))


def trend(samples: DataFrame, value: str, key: str = "video_id", order: str = "t", least: float = 20.0) -> DataFrame:
    """(key, change, trend): the last quarter's mean less the first's; rising, falling or steady."""
    w = Window.partitionBy(key).orderBy(order)
    placed = samples.withColumn("_r", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    quarter = F.greatest(F.lit(1), F.floor(F.col("_n") / 4))
    change = F.avg(F.when(F.col("_r") > F.col("_n") - quarter, F.col(value))) - F.avg(F.when(F.col("_r") <= quarter, F.col(value)))
    told = placed.groupBy(key).agg(change.alias("change"))
    return told.withColumn("trend", F.when(F.col("change") >= least, F.lit("rising")).when(F.col("change") <= -least, F.lit("falling")).otherwise(F.lit("steady")))


def uncertainty_ms(precision: Column, sample_gap: Column) -> Column:
    """How far an event's boundary may be off: by its precision class, half a sampling step for samples."""
    return F.when(precision == "exact", F.lit(40.0)).when(precision == "sample", sample_gap * 500).when(precision == "word", F.lit(200.0)).when(precision == "scene", F.lit(1000.0))


def record_kind(columns: list[str]) -> str:
    """The record type that a table's columns are of."""
    for column, kind in (("question_id", "qa"), ("sequence_id", "sequence"), ("event_id", "event"), ("clip_id", "clip"), ("frame_id", "frame"), ("segment_id", "video_description"), ("scene_id", "scene")):
        if column in columns:
            return kind
    return "unknown"


def with_status(validation: Column, status: Column, reason: str, history: Column) -> Column:
    """(validation, history) after a status change; nothing is added if the status stays."""
    changed = ~validation["status"].eqNullSafe(status)
    step = F.struct(validation["status"].alias("was"), status.alias("now"), F.lit(reason).alias("reason"))
    return F.struct(validation.withField("status", status).alias("validation"), F.when(changed, F.array_append(history, step)).otherwise(history).alias("history"))
