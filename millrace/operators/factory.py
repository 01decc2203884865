"""Eligibility of clips and captions for training targets: rights, fit, verdicts, draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable, shuffle_width

from ..functions.reasons import first_reason, reasons

#: What an evidence file may say, and what is exported without and with a note.
EVIDENCE = ("cleared", "restricted", "review_required", "unknown")


def resolved_rights(records: DataFrame, evidence: DataFrame, mapped: dict[str, str], key: str = "video_id") -> DataFrame:
    """Records with rights and rights_by: stated evidence (key, status) first, then the declared licence by ``mapped``, never cleared without either."""
    held = evidence.filter(F.col("status").isin(*EVIDENCE)).select(key, F.col("status").alias("_stated"))
    joined = records.join(held, key, "left")
    declared = F.lower(F.trim("license"))
    by_map = F.coalesce(*[F.when(declared == k, F.lit(v)) for k, v in mapped.items()], F.lit("review_required"))
    known = declared.isNotNull() & (declared != "")
    rights = F.when(F.col("_stated").isNotNull(), F.col("_stated")).when(known, by_map).otherwise(F.lit("review_required"))
    by = F.when(F.col("_stated").isNotNull(), F.lit("evidence")).when(known, F.concat(F.lit("declared:"), declared)).otherwise(F.lit("none"))
    return joined.withColumn("rights", rights).withColumn("rights_by", by).drop("_stated")


def misfits(duration: Column, fps: Column, width: Column, height: Column, split: Column, shortest: float, longest: float, least_fps: float, size: tuple[int, int], mode: str = "min", tolerance: float = 0.05, splits: tuple[str, ...] = ("train",)) -> Column:
    """Why a clip doesn't fit a training target; what is unknown doesn't fit."""
    w, h = size
    known = (width > 0) & (height > 0)
    rules = [
        (F.coalesce(duration < shortest, F.lit(True)), "duration_below"),
        (F.coalesce(duration > longest, F.lit(True)), "duration_above"),
        (F.coalesce(fps < least_fps, F.lit(True)), "fps_below"),
    ]
    if mode != "any":
        rules += [(~F.coalesce(known, F.lit(False)), "dimensions_unknown"), (known & F.lit(mode == "min") & ((width < w) | (height < h)), "resolution_below"), (known & (F.abs(width / height - w / h) / (w / h) > tolerance), "aspect_ratio"), (known & F.lit(mode == "exact") & ((width != w) | (height != h)), "resolution_differs")]
    return reasons(*rules, (split.isNotNull() & ~split.isin(*splits), F.concat(F.lit("split:"), split)))


def verdict(media: Column, caption: Column, text: Column, rights: Column, duplicate: Column, visual: Column, start_frame: Column, allowed: tuple[str, ...] = ("cleared",), override: tuple[str, ...] = (), drop_near: bool = True) -> Column:
    """(video_reasons, image_reasons, status, note) of one record: why it can't be used from text, why not from a start frame, and its state.

    ``duplicate`` is exact, near or null; states are passed, failed, needs_review or not_checked.
    """
    open_rights = rights.isin(*allowed, *override)
    base = reasons(
        (media != "passed", F.concat(F.lit("media:"), media)),
        (caption != "passed", F.concat(F.lit("caption:"), caption)),
        (F.trim(F.coalesce(text, F.lit(""))) == "", "caption:missing"),
        (~F.coalesce(open_rights, F.lit(False)), F.concat(F.lit("rights:"), F.coalesce(rights, F.lit("none")))),
        (duplicate == "exact", "duplicate:exact"),
        ((duplicate == "near") & F.lit(drop_near), "duplicate:near"),
        (visual == "failed", "visual:failed"),
    )
    image = F.concat(base, reasons((start_frame != "passed", F.concat(F.lit("start_frame:"), start_frame))))
    bad = F.lit("failed")
    status = F.when((media == bad) | (caption == bad) | (visual == bad), bad).when(media == "not_checked", F.lit("not_checked")).when((media == "needs_review") | (caption == "needs_review") | (rights == "review_required") | F.coalesce(duplicate == "near", F.lit(False)), F.lit("needs_review")).otherwise(F.lit("passed"))
    note = F.when(rights.isin(*override) if override else F.lit(False), F.concat(F.lit("rights_override:"), rights))
    return F.struct(base.alias("video_reasons"), image.alias("image_reasons"), status.alias("status"), note.alias("note"))


def clip_fault(status: Column, target: Column, boundary: Column, start: Column, end: Column, prompt: Column, statuses: tuple[str, ...] = ("accepted",), targets: tuple[str, ...] = (), shortest: float = 2.0, longest: float = 30.0) -> Column:
    """The first reason for which a clip is no candidate for training; null if it is one."""
    named = lambda what, c: F.concat(F.lit(f"{what}:"), F.coalesce(c, F.lit("none")))
    length = F.coalesce(end, F.lit(0.0)) - F.coalesce(start, F.lit(0.0))
    return first_reason(
        (~F.coalesce(status.isin(*statuses), F.lit(False)), named("status", status)),
        (~F.coalesce(target.isin(*targets), F.lit(False)) if targets else F.lit(False), named("target", target)),
        (F.coalesce(boundary != "passed", F.lit(True)), named("boundary", boundary)),
        (length < shortest, "too_short"),
        (length > longest, "too_long"),
        (F.trim(F.coalesce(prompt, F.lit(""))) == "", "no_prompt"),
    )


def same_source(stated_duration: Column, found_duration: Column, stated_hash: Column, found_hash: Column, tolerance: float = 1.0) -> Column:
    """(state, by, delta): whether a file that was fetched again carries the video that older records describe."""
    delta = F.round(F.abs(F.coalesce(found_duration, F.lit(0.0)) - stated_duration), 3)
    identical = F.coalesce(stated_hash == found_hash, F.lit(False))
    state = F.when(stated_duration.isNull(), F.lit("unverified")).when(delta <= tolerance, F.lit("matched")).otherwise(F.lit("mismatch"))
    return F.struct(state.alias("state"), F.when(identical, F.lit("hash")).otherwise(F.lit("duration")).alias("by"), delta.alias("delta"))


def media_faults(exists: Column, size: Column, probed: Column, duration: Column, width: Column, height: Column, fps: Column, frames: Column, tolerance: float = 2.0) -> Column:
    """Why a media file isn't valid, from its probe; a file that isn't there has no other fault."""
    lost = F.abs(frames - duration * fps) > tolerance
    inside = reasons((size == 0, "empty_file"), (~probed, "unreadable"), (duration <= 0, "no_duration"), (F.least(width, height) <= 0, "no_dimensions"), (fps <= 0, "no_frame_rate"), (lost, "frame_count_differs"))
    return F.when(~F.coalesce(exists, F.lit(False)), F.array(F.lit("missing_file"))).otherwise(inside)


def picked(key: Column, names: list[str], n: int) -> Column:
    """``n`` names for a key, one after the other from a place that its hash says, the same at every run."""
    k = min(n, len(names))
    if k <= 0:
        return F.array().cast("array<string>")
    start = F.pmod(F.conv(F.substring(F.sha1(key.cast("string")), 1, 12), 16, 10).cast("bigint"), F.lit(len(names))).cast("int")
    table = F.array(*[F.lit(x) for x in names])
    return F.array(*[F.get(table, (start + i) % len(names)) for i in range(k)])


#: Batches whose steps are summed in one task.
SUMMED = 100_000


def drawn_batches(records: DataFrame, task: str, key: str, weights: dict[str, float], sizes: dict[str, int], seed: str = "1") -> DataFrame:
    """Records with ``batch`` and ``turn``: each task's records in order of a hash, cut to batches, and all batches in a weighted order.

    A batch comes at -log(u) / weight, u from the hash of its task and number: a task with twice
    the weight is drawn twice as often, the same at every run, and every batch comes once.
    """
    known = records.filter(F.col(task).isin(*weights))
    lookup = lambda table: F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])[F.col(task)]
    hashed = F.sha1(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    sorted_ = numbered(known.withColumn("_h", hashed), [task, "_h", key], "_rank")
    first = {row[task]: row["n"] for row in sorted_.groupBy(task).agg(F.min("_rank").alias("n")).collect()}
    own = F.col("_rank") - lookup({t: first.get(t, 0) for t in weights})
    size = lookup({t: sizes.get(t, 1) for t in weights})
    cut = sorted_.withColumn("_own", own).withColumn("batch", F.floor(F.col("_own") / size))
    u = (F.conv(F.substring(F.sha1(F.concat_ws("|", F.lit(seed), F.col(task), F.col("batch").cast("string"))), 1, 12), 16, 10).cast("bigint") + 1) / F.lit(float(16**12) + 1)
    each = cut.filter(F.col("_own") % size == 0).select(task, "batch", F.floor(F.col("batch") / SUMMED).alias("_part"), (-F.log(u) / lookup(weights)).alias("_step"))
    # Arrivals are sums over runs of batches, onto the sum of the runs before.
    runs = each.groupBy(task, "_part").agg(F.sum("_step").alias("_sum"))
    before = Window.partitionBy(task).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(task, "_part").orderBy("batch")
    arrival = each.withColumn("_in", F.sum("_step").over(inside)).join(runs.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0.0))).drop("_sum"), [task, "_part"])
    turns = numbered(arrival.select(task, "batch", (F.col("_base") + F.col("_in")).alias("_at")), ["_at", task], "turn")
    return cut.drop("_h", "_rank", "_own").join(turns.select(task, "batch", (F.col("turn") + 1).alias("turn")), [task, "batch"])


def numbered(records: DataFrame, by: list[str], name: str) -> DataFrame:
    """Records with their place, from 0, in the order of ``by``: sorted in ranges, so that no task holds all of them."""
    spark = records.sparkSession
    ranges = max(shuffle_width(spark), spark.sparkContext.defaultParallelism)
    kept = durable(records.repartitionByRange(ranges, *by).sortWithinPartitions(*by))
    at = F.monotonically_increasing_id()
    told = kept.withColumn("_range", F.shiftright(at, 33)).withColumn(name, at.bitwiseAND(F.lit((1 << 33) - 1)))
    base, upto = {}, 0
    for row in sorted(told.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda row: row["_range"]):
        base[row["_range"]], upto = upto, upto + row["n"]
    start = F.create_map(*[F.lit(x).cast("bigint") for pair in base.items() for x in pair])[F.col("_range")] if base else F.lit(0).cast("bigint")
    return told.withColumn(name, F.col(name) + start).drop("_range")


def rights_block(status: Column, licence: Column, evidence: Column) -> Column:
    """(status, terms, publishable) of a producer's licence status."""
    terms = F.when(status == "cc0", F.lit("no conditions")).when(status == "cc-by", F.lit("attribution")).when(status.isin("reserved", "platform_standard"), F.lit("permission needed")).otherwise(F.lit("unknown"))
    return F.struct(F.coalesce(status, F.lit("unknown")).alias("status"), terms.alias("terms"), (F.coalesce(status.isin("cc0", "cc-by"), F.lit(False)) | F.coalesce(F.trim(evidence) != "", F.lit(False))).alias("publishable"), licence.alias("license"))
