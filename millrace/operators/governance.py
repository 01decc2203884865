"""Rules around records: why they failed, what they claim, how good they are, which leave, what ran."""

from __future__ import annotations

import platform
import sys
from importlib import metadata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.reasons import first_reason
from .policy import mean_available

#: Provider sources that measure, by whose score a text is grounded.
INSTRUMENTS = ("ocr_score", "asr_probability", "detector_score", "measurement")
#: Classes of boundary that were measured.
MEASURED = ("measured", "asr", "frame")


def exported(status: Column, review: bool = True, rejected: bool = False) -> Column:
    """Whether a record leaves with an export: accepted, or without a status, always, duplicates never."""
    s = F.coalesce(status, F.lit("accepted"))
    return (s == "accepted") | (F.lit(review) & (s == "review")) | (F.lit(rejected) & (s == "rejected"))


def failure_category(codes: Column, status: Column, claims: Column, ambiguous: Column) -> Column:
    """Why a record was judged as it was, in one word; the first that applies.

    ``claims`` are the states of its claims, ``codes`` the reason codes of its validation.
    """
    said = lambda *parts: F.exists(codes, lambda c: F.coalesce(*[F.when(c.contains(p), F.lit(True)) for p in parts], F.lit(False)))
    begins = lambda p: F.exists(codes, lambda c: c.startswith(p))
    return F.coalesce(
        first_reason(
            (begins("human:"), "human_labelled"),
            (F.array_contains(claims, "contradicted"), "contradicted_claim"),
            (said("clip_boundaries", "timestamps"), "boundary"),
            (said("camera_motion_agreement") | F.coalesce(ambiguous, F.lit(False)), "camera"),
            (said("semantic_verification"), "semantic"),
            (said("missing_check:"), "missing_check"),
            (said("confidence:"), "confidence"),
            ((status == "accepted") & (F.size(codes) == 0), "accepted"),
        ),
        F.lit("other"),
    )


def claims(camera: Column, camera_source: Column, objects: Column, light: Column, setting: Column, contradicted: Column) -> Column:
    """The claims of a shot: (kind, value, source, status) of its camera, subjects, light and setting.

    What an instrument says is supported, what a model says isn't checked, and what a list of
    contradicted kinds names is contradicted. Unknown values claim nothing but that.
    """
    claim = lambda kind, value, source, status: F.struct(F.lit(kind).alias("kind"), value.alias("value"), source.alias("source"), F.when(F.array_contains(contradicted, kind), F.lit("contradicted")).otherwise(status).alias("status"))
    state = lambda measured: F.when(measured, F.lit("supported")).otherwise(F.lit("not_checked"))
    known = F.coalesce(camera != "unknown", F.lit(False))
    moves = F.when(known, claim("camera", camera, camera_source, state(camera_source.isin(*INSTRUMENTS)))).otherwise(claim("camera", F.lit("unknown"), F.lit("none"), F.lit("unknown")))
    subjects = F.transform(F.coalesce(objects, F.array().cast("array<string>")), lambda o: claim("subject", o, F.lit("detector_score"), F.lit("supported")))
    lit = F.when(light.isNotNull(), F.array(claim("lighting", light, F.lit("measurement"), F.lit("supported")))).otherwise(F.filter(subjects, lambda _: F.lit(False)))
    placed = F.when(F.coalesce(setting != "unknown", F.lit(False)), F.array(claim("setting", setting, F.lit("model"), F.lit("not_checked")))).otherwise(F.filter(subjects, lambda _: F.lit(False)))
    return F.concat(F.array(moves), subjects, lit, placed)


def claim_states(claims_: Column) -> Column:
    """Numbers of claims by state, as a struct of the four states."""
    n = lambda s: F.size(F.filter(claims_, lambda c: c["status"] == s)).alias(s)
    return F.struct(n("supported"), n("contradicted"), n("not_checked"), n("unknown"))


def event_quality(verified: Column, confidence: Column, source: Column, precision: Column, description: Column) -> Column:
    """(grounding, temporal_accuracy, description_quality, overall) of an event.

    A verifier's score grounds it, or the score of the instrument that its text quotes; its time
    is as good as that score where the boundary was measured. What isn't known is null and
    doesn't count in the mean.
    """
    grounding = F.coalesce(verified, F.when(source.isin(*INSTRUMENTS), confidence))
    time = F.when(precision.isin(*MEASURED), confidence)
    return F.struct(grounding.alias("grounding"), time.alias("temporal_accuracy"), description.alias("description_quality"), mean_available([grounding, time, description]).alias("overall"))


def relation_quality(groundings: Column, times: Column) -> Column:
    """(grounding, temporal_accuracy): the least of its events', null if any event has none."""
    least = lambda xs: F.when((F.size(xs) > 0) & ~F.exists(xs, lambda x: x.isNull()), F.round(F.array_min(xs), 3))
    return F.struct(least(groundings).alias("grounding"), least(times).alias("temporal_accuracy"))


def aligned_speech(start: Column, end: Column, duration: Column, tolerance: float = 0.25) -> Column:
    """(state, end): a speech segment against the audio's length; an end just past it is trimmed, more is only flagged."""
    outside = (start > duration + tolerance) | (end > duration + tolerance) | (end < start)
    state = F.when(duration.isNull() | (duration <= 0), F.lit("not_checked")).when(outside, F.lit("outside_audio")).when(end > duration, F.lit("clamped")).otherwise(F.lit("within_audio"))
    return F.struct(state.alias("state"), F.when(state == "clamped", F.round(duration, 3)).otherwise(end).alias("end"))


def impossible_time(start: Column, end: Column) -> Column:
    """Whether a record's time can't be: before the beginning, or an end before its start; unknown times can."""
    return F.coalesce(start < 0, F.lit(False)) | F.coalesce(end < start, F.lit(False))


def stage_block(stages: dict[str, Column]) -> Column:
    """A video's coverage: each stage as ran, empty or not_run, by the number of its results (null didn't run)."""
    state = lambda n: F.when(n.isNull(), F.lit("not_run")).when(n == 0, F.lit("empty")).otherwise(F.lit("ran"))
    return F.create_map(*[x for name, n in stages.items() for x in (F.lit(name), state(n))])


def usable_entity(name: Column, kind: Column, kinds: tuple[str, ...] = ("PERSON", "ORG", "GPE", "LOC", "FAC", "EVENT", "PRODUCT", "WORK_OF_ART")) -> Column:
    """Whether a recognised name can be asked about: of a kind that names something, with letters, neither a number nor one letter."""
    n = F.trim(name)
    return F.coalesce(kind.isin(*kinds) & (F.length(n) >= 2) & n.rlike(r"\p{L}") & ~n.rlike(r"^[\d\W]+$"), F.lit(False))


def provenance(url: Column, title: Column, licence: Column, fetched: Column) -> Column:
    return F.struct(url.alias("url"), title.alias("title"), F.coalesce(licence, F.lit("unknown")).alias("license"), fetched.alias("fetched_at"), F.sha1(url).alias("source_id"))


def reproducibility(spark: SparkSession, config: dict[str, str], packages: tuple[str, ...] = ("pyspark", "pyarrow", "numpy", "pandas")) -> DataFrame:
    """(key, value): the versions, settings and configuration under which a release was made."""
    from ..functions.ids import stable_hash

    def version(name: str) -> str:
        try:
            return metadata.version(name)
        except metadata.PackageNotFoundError:
            return ""

    rows = [("python", sys.version.split()[0]), ("platform", platform.platform()), ("spark", spark.version), ("timezone", spark.conf.get("spark.sql.session.timeZone", "") or ""), *((f"package:{p}", version(p)) for p in packages), *((f"config:{k}", str(v)) for k, v in sorted(config.items()))]
    table = spark.createDataFrame(rows, "key string, value string")
    joined = "|".join(f"{k}={v}" for k, v in sorted(config.items()))
    return table.unionByName(spark.range(1).select(F.lit("config").alias("key"), stable_hash(F.lit(joined), length=16).alias("value")))


def reannotated(old: DataFrame, steps: list, key: str = "record_id") -> DataFrame:
    """Older records through steps (frame to frame) one after the other, with ``changed``: whether any column but the version differs."""
    from ..functions.ids import content_hash

    columns = [c for c in sorted(old.columns) if c != "schema_version"]
    out = old
    for step in steps:
        out = step(out)
    before = old.select(key, content_hash(*[F.col(c) for c in columns]).alias("_was"))
    now = out.withColumn("_now", content_hash(*[F.col(c) for c in columns if c in out.columns]))
    return now.join(before, key, "left").withColumn("changed", ~F.col("_now").eqNullSafe(F.col("_was"))).drop("_now", "_was")


def media_report(found: DataFrame, stated: DataFrame, path: str = "path") -> DataFrame:
    """(state, n) of the files that records point to: present, empty or missing, and those nothing points to."""
    both = stated.select(path).distinct().withColumn("_stated", F.lit(True)).join(found.select(path, "length"), path, "full_outer")
    state = F.when(F.col("_stated").isNull(), F.lit("unreferenced")).when(F.col("length").isNull(), F.lit("missing")).when(F.col("length") == 0, F.lit("empty")).otherwise(F.lit("present"))
    return both.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def removable(files: DataFrame, uploaded: DataFrame, kept_kinds: tuple[str, ...] = ("manifest", "records")) -> DataFrame:
    """(path, bytes): what a cleanup may delete: files of verified uploads whose checksum is the uploaded one, but records and manifests."""
    safe = files.join(uploaded.filter("verified").select("path", F.col("sha256").alias("_up")), "path")
    return safe.filter((F.col("sha256") == F.col("_up")) & ~F.col("kind").isin(*kept_kinds)).select("path", F.col("length").alias("bytes"))
