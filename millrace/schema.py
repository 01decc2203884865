"""Record types, their common columns, vocabularies, and the migration of older rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "2.3.0"
RECORD_TYPES = ("frames", "clips", "scenes", "sequences", "events", "temporal_qa", "long_video_qa", "video_descriptions")

VALIDATION = "struct<status: string, checks: map<string, string>, reason_codes: array<string>, issues: array<string>, policy_version: string, semantic_verification: string>"
QUALITY = "struct<grounding: double, temporal_accuracy: double, description_quality: double, overall: double, components_used: array<string>>"
COMMON = f"record_id string, record_type string, video_id string, split string, tier string, tier_reasons array<string>, subsets array<string>, canonical_video_id string, source_group_id string, schema_version string, generation_target string, confidence double, confidence_source string, quality {QUALITY}, validation {VALIDATION}, extensions map<string, string>"
SPAN = "start_time double, end_time double, duration double"
EVIDENCE = "struct<start_time: double, end_time: double, event_ids: array<string>, scene_ids: array<string>, frame_ids: array<string>, timestamps: array<double>>"
CAMERA = "struct<movement: string, camera_movement: string, movement_direction: string, movement_speed: string, shot_size: string, confidence: double, movement_ambiguous: boolean>"
QA = f"{COMMON}, question_id string, type string, question string, answer string, difficulty string, evidence {EVIDENCE}"

#: The Spark schema of each record type.
SCHEMAS = {
    "frames": f"{COMMON}, frame_id string, scene_id string, frame_path string, timestamp double, caption string",
    "clips": f"{COMMON}, clip_id string, scene_id string, clip_path string, {SPAN}, fps double, width int, height int, boundary_check string, generation_prompt string, camera {CAMERA}",
    "scenes": f"{COMMON}, scene_id string, {SPAN}, summary string, description string, generation_prompt string, objects array<string>, quality_flags array<string>, transition_in string, camera {CAMERA}, environment struct<setting: string, time_of_day: string, location: string>, measurements struct<lighting_level: string, sharpness: double, aesthetic_score: double, brightness_mean: double>",
    "sequences": f"{COMMON}, sequence_id string, {SPAN}, n_shots int, scene_ids array<string>, clip_ids array<string>, coherence array<string>, generation_prompt string, shot_prompts array<string>",
    "events": f"{COMMON}, event_id string, event_type string, event string, action string, entities array<string>, scene_ids array<string>, frame_ids array<string>, {SPAN}, source string, uncertainty_ms double",
    "temporal_qa": QA,
    "long_video_qa": QA,
    "video_descriptions": f"{COMMON}, segment_id string, {SPAN}, description string, shots array<struct<scene_id: string, summary: string>>, facts map<string, array<string>>",
}

#: Steps of older versions: what each renames or derives.
STEPS: tuple[tuple[str, str, dict[str, str]], ...] = (
    ("0.0.0", "2.0.0", {"start": "start_time", "end": "end_time", "id": "record_id"}),
    ("2.0.0", "2.1.0", {"prompt": "generation_prompt"}),
    ("2.1.0", "2.2.0", {"group_id": "source_group_id"}),
    ("2.2.0", "2.3.0", {"target": "generation_target"}),
)


def path(version: str) -> list[str]:
    """Versions a row passes through to the present one; none for an unknown or newer version."""
    versions = [STEPS[0][0], *(s[1] for s in STEPS)]
    return versions[versions.index(version) + 1 :] if version in versions else []


def migrate(rows: DataFrame, known: list[str]) -> DataFrame:
    """Rows of any version at the present one, with unknown columns moved to ``extensions``.

    Each step's renames fill a column that is null and are only done for rows old enough; rows
    of a newer version are left as they are. No row is dropped.
    """
    version = F.coalesce(F.col("schema_version"), F.lit("0.0.0")) if "schema_version" in rows.columns else F.lit("0.0.0")
    newer = F.split(version, r"\.").cast("array<int>") > F.split(F.lit(VERSION), r"\.").cast("array<int>")
    out = rows.withColumn("_newer", newer).withColumn("_version", version)
    for _, to, renames in STEPS:
        older = F.split(F.col("_version"), r"\.").cast("array<int>") < F.split(F.lit(to), r"\.").cast("array<int>")
        for old, new in renames.items():
            if old in rows.columns:
                held = F.col(new) if new in out.columns else F.lit(None).cast(rows.schema[old].dataType)
                out = out.withColumn(new, F.when(older, F.coalesce(held, F.col(old))).otherwise(held))
    renamed = {old for *_, r in STEPS for old in r}
    extra = [c for c in rows.columns if c not in known and c not in renamed and c != "schema_version"]
    pairs = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v"))) for c in extra])) if extra else F.array().cast("array<struct<k: string, v: string>>")
    return out.withColumn("extensions", F.map_from_entries(pairs)).withColumn("schema_version", F.when(F.col("_newer"), F.col("_version")).otherwise(F.lit(VERSION))).drop(*extra, *[r for r in renamed if r in rows.columns], "_newer", "_version")


def first_known(*columns: Column) -> Column:
    """The first value that is neither null nor an empty text."""
    return F.coalesce(*[F.when(F.trim(c.cast("string")) != "", c) for c in columns])
