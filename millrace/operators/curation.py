"""Splits, tiers, subsets and eligibility of records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.reasons import none, reasons

TIER_RANK = {"gold": 3, "silver": 2, "bronze": 1}
TRUSTED_CONFIDENCE = ("human", "model_logprob", "calibrated")


@dataclass(frozen=True)
class SplitConfig:
    salt: str = "v1"
    test_fraction: float = 0.05
    validation_fraction: float = 0.05
    min_test: int = 1
    min_validation: int = 1


def split_of(key: Column, cfg: SplitConfig) -> Column:
    """The hash bucket of one group, whatever other groups there are."""
    u = ids.unit_hash(cfg.salt, key)
    return F.when(u < cfg.test_fraction, F.lit("test")).when(u < cfg.test_fraction + cfg.validation_fraction, F.lit("validation")).otherwise(F.lit("train"))


def assign_splits(groups: DataFrame, key: str, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """(key, split) of each distinct group.

    Groups fall by hash; where that leaves test or validation below its minimum, the train groups
    of the lowest hashes move over, test first. One group at least stays in train; minimums that
    don't fit beside it shrink, validation first. Only three counts come to the driver, and only
    as many groups as the minimums ask for are ranked.
    """
    hashed = groups.select(key).dropna().distinct().withColumn("_u", ids.unit_hash(cfg.salt, F.col(key))).withColumn("split", split_of(F.col(key), cfg))
    have = {r["split"]: r["n"] for r in hashed.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(have.values())
    if n <= 1:
        return hashed.select(key, F.lit("train").alias("split"))
    test, validation = max(0, cfg.min_test), max(0, cfg.min_validation)
    while test + validation > n - 1:
        if validation >= test and validation > 0:
            validation -= 1
        else:
            test -= 1
    spare = max(0, have.get("train", 0) - 1)
    to_test = min(spare, max(0, test - have.get("test", 0)))
    to_validation = min(spare - to_test, max(0, validation - have.get("validation", 0)))
    if to_test + to_validation == 0:
        return hashed.select(key, "split")
    lowest = hashed.filter("split = 'train'").orderBy("_u", key).limit(to_test + to_validation)
    moved = lowest.withColumn("_n", F.row_number().over(Window.orderBy("_u", key))).select(key, F.when(F.col("_n") <= to_test, F.lit("test")).otherwise(F.lit("validation")).alias("_moved"))
    return hashed.join(F.broadcast(moved), key, "left").select(key, F.coalesce("_moved", "split").alias("split"))


def keep_assignments(groups: DataFrame, held: DataFrame, key: str, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Splits of all groups; groups that ``held`` (key, split) knows never move."""
    fresh = assign_splits(groups, key, cfg)
    return fresh.join(held.select(key, F.col("split").alias("_held")), key, "left").select(key, F.coalesce("_held", "split").alias("split"))


def split_leaks(records: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups that lie in more than one split."""
    return records.groupBy(group).agg(F.array_sort(F.collect_set(split)).alias("splits")).filter(F.size("splits") > 1)


def group_of(video: Column, canonical: Column, channel: Column) -> Column:
    """The split group of a video, the same as its canonical copy's: ``channel`` is that copy's, if there is one."""
    return F.coalesce(channel_group(channel), canonical, video)


def channel_group(channel: Column) -> Column:
    slug = F.trim(F.regexp_replace(F.lower(channel), r"\s+", " "))
    return F.when(slug != "", F.concat(F.lit("channel:"), slug))


def tier(status: Column, overall: Column, confidence: Column, source: Column, components: Column, gold: float = 0.8, silver: float = 0.6, gold_confidence: float = 0.7) -> Column:
    """(tier, reasons): why the record isn't in the tier above. Rejected and duplicate ones have none."""
    accepted = F.coalesce(status == "accepted", F.lit(False))
    dropped = F.coalesce(status.isin("rejected", "duplicate"), F.lit(False))
    block = reasons(
        (~F.coalesce(F.array_contains(components, "grounding"), F.lit(False)), "no_grounding_component"),
        (confidence.isNull(), "confidence_unavailable"),
        (confidence < gold_confidence, f"confidence_below_{gold_confidence}"),
        ((confidence >= gold_confidence) & ~F.coalesce(source, F.lit("unavailable")).isin(*TRUSTED_CONFIDENCE), F.concat(F.lit("confidence_source_"), F.coalesce(source, F.lit("unavailable")))),
    )
    below = reasons((~accepted, F.coalesce(F.concat(F.lit("status_"), status), F.lit("status_missing"))), (overall.isNull(), "quality_unscored"), (accepted & overall.isNotNull(), f"overall_below_{silver}"))
    said = lambda name, why: F.struct(F.lit(name).cast("string").alias("tier"), why.alias("reasons"))
    return (
        F.when(dropped, said(None, F.array(F.concat(F.lit("status_"), status))))
        .when(accepted & (overall >= gold) & none(block), said("gold", F.array().cast("array<string>")))
        .when(accepted & (overall >= gold), said("silver", block))
        .when(accepted & (overall >= silver), said("silver", F.array(F.lit(f"overall_below_{gold}"))))
        .otherwise(said("bronze", below))
    )


def tier_rank(name: Column) -> Column:
    return F.coalesce(*[F.when(name == t, F.lit(r)) for t, r in TIER_RANK.items()], F.lit(0))


def cap_tier(told: Column, cap: str, when: Column, reason: str) -> Column:
    """Lowered to ``cap``, with the reason, where ``when`` holds and the tier is above it."""
    lower = when & (tier_rank(told["tier"]) > TIER_RANK[cap])
    return F.when(lower, F.struct(F.lit(cap).alias("tier"), F.array_append(told["reasons"], F.lit(reason)).alias("reasons"))).otherwise(told)


def cinematic_reasons(tier_name: Column, duration: Column, camera: Column, aesthetic: Column, sharpness: Column, flags: Column, canonical: Column, least_tier: str = "silver", shortest: float = 2.0, least_aesthetic: float = 4.5, least_sharpness: float = 0.0, need_aesthetic: bool = False) -> Column:
    """Why a scene isn't cinematic; none if it is."""
    return reasons(
        (tier_rank(tier_name) < TIER_RANK[least_tier], f"tier_below_{least_tier}"),
        (duration < shortest, "too_short"),
        (F.coalesce(camera, F.lit("unknown")) == "unknown", "camera_unknown"),
        (aesthetic.isNull() & F.lit(need_aesthetic), "no_aesthetic_score"),
        (aesthetic < least_aesthetic, f"aesthetic_below_{least_aesthetic}"),
        (F.lit(least_sharpness > 0) & (sharpness < least_sharpness), "soft_focus"),
        (F.size(flags) > 0, "quality_flags"),
        (canonical.isNotNull(), "near_duplicate_video"),
    )


def all_members(records: DataFrame, key: str, members: str, chosen: DataFrame, member: str, scope: str = "video_id") -> DataFrame:
    """(scope, key) of records with members, all of which are among the ``chosen`` (scope, member)."""
    each = records.select(scope, key, F.explode(members).alias(member))
    told = each.join(chosen.select(scope, member).distinct().withColumn("_in", F.lit(True)), [scope, member], "left")
    return told.groupBy(scope, key).agg(F.bool_and(F.coalesce("_in", F.lit(False))).alias("_all")).filter("_all").select(scope, key)


@dataclass(frozen=True)
class Task:
    kinds: tuple[str, ...]
    subsets: tuple[str, ...] = ()
    targets: tuple[str, ...] = ()
    evidence: bool = False
    camera: bool = False
    prompt: bool = False
    rights: bool = False
    media: bool = False


#: What each task export takes.
TASKS = {
    "understanding": Task(("frames", "clips", "scenes", "events", "video_descriptions")),
    "temporal_reasoning": Task(("temporal_qa", "long_video_qa", "events", "sequences"), evidence=True),
    "cinematic": Task(("scenes", "clips", "frames"), subsets=("cinematic",), camera=True),
    "generation_ready": Task(("clips", "sequences", "scenes"), subsets=("strict",), targets=("single_shot", "multi_shot"), prompt=True, rights=True, media=True),
}


def ineligible(task: Task, kind: Column, status: Column, subsets: Column, target: Column | None = None, prompt: Column | None = None, camera: Column | None = None, ambiguous: Column | None = None, resolved: Column | None = None, rights: Column | None = None, media: Column | None = None, release_rights: tuple[str, ...] = ("cc-by", "cc0", "owned")) -> Column:
    """Why a record doesn't fit a task; a record of another kind gets that one reason."""
    no, missing = F.lit(None).cast("string"), lambda c, word="missing": F.coalesce(c, F.lit(word))
    target, prompt, camera, rights = (no if c is None else c for c in (target, prompt, camera, rights))
    said = lambda head, c: F.concat(F.lit(head), c)
    rules = [(missing(status) != "accepted", said("status:", missing(status)))]
    rules += [(~F.coalesce(F.array_contains(subsets, s), F.lit(False)), f"not_in_subset:{s}") for s in task.subsets]
    if task.targets:
        rules.append((~missing(target).isin(*task.targets), said("generation_target:", missing(target))))
    if task.prompt:
        rules.append((F.trim(missing(prompt, "")) == "", "prompt:missing"))
    if task.camera:
        unknown = missing(camera, "unknown") == "unknown"
        rules += [(unknown, "camera:unknown"), (~unknown & F.coalesce(ambiguous, F.lit(False)) if ambiguous is not None else F.lit(False), "camera:ambiguous")]
    if task.evidence:
        rules.append((~F.coalesce(resolved, F.lit(False)) if resolved is not None else F.lit(True), "evidence:unresolved"))
    if task.rights:
        rules.append((~missing(rights, "unknown").isin(*release_rights), said("rights:", missing(rights, "unknown"))))
    if task.media:
        rules.append((~F.coalesce(media, F.lit(False)) if media is not None else F.lit(True), "media:missing"))
    return F.when(~kind.isin(*task.kinds), F.array(said("record_type:", kind))).otherwise(reasons(*rules))


def duration_band(seconds: Column, bands: dict[str, tuple[float, float]]) -> Column:
    """The first half-open band that holds the duration, else null."""
    return F.coalesce(*[F.when((seconds >= low) & (seconds < high), F.lit(name)) for name, (low, high) in bands.items()], F.lit(None).cast("string"))


def resolution(width: Column, height: Column, target: int = 720, native: int = 480, least: int = 360, upscale: bool = False, ladder: tuple[int, ...] = (1080, 720, 576)) -> Column:
    """(bucket, action, width, height, experimental) of a source's size by its short edge."""
    short = F.least(width, height)
    even = lambda x: F.greatest(F.lit(2), (F.bround(x / 2) * 2).cast("int"))
    said = lambda bucket, action, w, h, trial: F.struct((bucket if isinstance(bucket, Column) else F.lit(bucket)).alias("bucket"), F.lit(action).alias("action"), w.cast("int").alias("width"), h.cast("int").alias("height"), F.lit(trial).alias("experimental"))
    scaled = (even(width * target / short), even(height * target / short))
    rung = F.coalesce(*[F.when(short >= x, F.lit(f"native_{x}")) for x in ladder], F.lit("native_480_576"))
    out = F.when((width <= 0) | (height <= 0), F.lit(None)).when(short > target, said(f"{target}p", "downscaled", *scaled, False)).when(short == target, said(f"{target}p", "kept", even(width), even(height), False))
    if upscale:
        out = out.when(short >= least, said(f"{target}p_upscaled", "upscaled", *scaled, True))
    return out.when(short >= native, said(rung, "keep_native", even(width), even(height), False)).when(short >= least, said("lowres_360", "keep_native_experimental", even(width), even(height), True)).otherwise(said("excluded_lowres", "excluded", width, height, False))
