"""Records made of other records: events of seven modalities, richer relations, training pairs, benchmark items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text
from . import temporal

EVENT = "video_id, event_type, event, entities, scene_ids, start_time, end_time, precision, source".split(", ")


def _events(frame: DataFrame, kind: str | Column, said: Column, entities: Column, source: str, precision: str, scenes: Column | None = None) -> DataFrame:
    """Rows of the one event form; empty phrases are no events."""
    scene_list = F.array().cast("array<string>") if scenes is None else scenes
    told = frame.select("video_id", (F.lit(kind) if isinstance(kind, str) else kind).alias("event_type"), F.trim(said).alias("event"), F.coalesce(entities, F.array().cast("array<string>")).alias("entities"), scene_list.cast("array<string>").alias("scene_ids"), F.col("start_time").cast("double").alias("start_time"), F.col("end_time").cast("double").alias("end_time"), F.lit(precision).alias("precision"), F.lit(source).alias("source"))
    return told.filter("event <> ''")


def vision_events(scenes: DataFrame) -> DataFrame:
    """An appearance for each object that the scene before didn't have, and an event for each action."""
    own = F.array(F.col("scene_id").cast("string"))
    new = temporal.new_entities(scenes).select("*", F.explode("appeared").alias("_o"))
    seen = _events(new, "appearance", F.concat(F.col("_o"), F.lit(" comes into view")), F.array("_o"), "vision", "scene", own)
    acts = scenes.select("*", F.explode("actions").alias("_a"))
    mentioned = F.filter("objects", lambda o: F.contains(F.lower("_a"), F.lower(o)))
    return seen.unionByName(_events(acts, "action", F.col("_a"), mentioned, "vision", "scene", own))


def camera_events(scenes: DataFrame) -> DataFrame:
    return _events(scenes.filter("camera IS NOT NULL AND camera <> 'unknown'"), "camera", F.concat(F.lit("the camera: "), F.regexp_replace("camera", "_", " ")), F.array().cast("array<string>"), "motion", "sample", F.array(F.col("scene_id").cast("string")))


def speech_events(segments: DataFrame, least: int = 3) -> DataFrame:
    """Speech of ``least`` words or more."""
    return _events(segments.filter(F.size(F.split(F.trim("text"), r"\s+")) >= least), "speech", F.concat(F.lit("speech: "), F.trim("text")), F.array().cast("array<string>"), "asr", "word")


def screen_text_events(tracks: DataFrame) -> DataFrame:
    return _events(tracks, "text_on_screen", F.concat(F.lit("text on screen: "), F.col("text")), F.array("text"), "ocr", "sample")


def sound_events(sounds: DataFrame) -> DataFrame:
    """Sounds but speech and silence."""
    return _events(sounds.filter("category NOT IN ('speech', 'silence')"), "sound", F.concat(F.lit("sound of "), F.col("label")), F.array("label"), "audio", "sample")


def change_events(scenes: DataFrame, attributes: list[str]) -> DataFrame:
    """State changes against the scene before, at the start of the later one."""
    told = temporal.state_changes(scenes, attributes, order="start_time").withColumn("end_time", F.col("start_time") + 0.5)
    return _events(told, "state_change", F.concat(F.regexp_replace("attribute", "_", " "), F.lit(" changes from "), F.col("before"), F.lit(" to "), F.col("after")), F.array().cast("array<string>"), "vision", "scene")


def cut_events(transitions: DataFrame) -> DataFrame:
    return _events(transitions, "transition", F.concat(F.col("transition"), F.lit(" to another shot")), F.array().cast("array<string>"), "detector", "exact", F.array(F.col("previous").cast("string"), F.col("scene_id").cast("string")))


def all_events(*parts: DataFrame) -> DataFrame:
    """The events of several modalities with ids in order of time within each video; equal rows count once."""
    merged = reduce(DataFrame.unionByName, parts).dropDuplicates(["video_id", "event_type", "event", "start_time", "end_time"])
    return temporal.renumbered(merged, "evt_", ["start_time", "end_time", "event_type", "event"], width=5)


def richer_relations(relations: DataFrame, events: DataFrame, generic: tuple[str, ...] = ("person", "people", "object", "scene"), close: float = 1.0, change: float = 2.0, tolerance: float = 0.25) -> DataFrame:
    """Relations that interval algebra doesn't tell: CONTINUES, CHANGES_TO and INTERRUPTS, beside the given ones' rows.

    events: event_id, event_type, action, entities, scene_ids. An action, a camera movement or an
    object that goes on right after in another shot continues; an entity with a new action soon
    after, or a new camera movement within the shot, changes; a short sound or cut inside speech,
    an action or a camera movement twice as long interrupts it.
    """
    named = F.array_except(F.transform(F.col("entities"), text.normalize_text), F.array(*[F.lit(g) for g in (*generic, "")]))
    side = lambda n: events.select("video_id", F.col("event_id").alias(f"event_{n}"), F.struct(F.col("event_type").alias("kind"), text.normalize_text(F.coalesce("action", F.lit(""))).alias("act"), named.alias("names"), F.col("scene_ids").alias("scenes"), F.col("start_time").alias("s"), F.col("end_time").alias("e")).alias(n))
    both = relations.join(side("a"), ["video_id", "event_a"]).join(side("b"), ["video_id", "event_b"])
    a, b = F.col("a"), F.col("b")
    before = (F.col("relation") == "BEFORE") & (a["kind"] == b["kind"])
    shared = F.arrays_overlap(a["names"], b["names"])
    acted = (a["act"] != "") & (b["act"] != "")
    other_shot = F.array_sort(F.array_distinct(a["scenes"])) != F.array_sort(F.array_distinct(b["scenes"]))
    goes_on = before & (F.col("gap_seconds") <= close) & a["kind"].isin("action", "camera", "appearance") & ((acted & (a["act"] == b["act"])) | ((a["kind"] == "appearance") & shared)) & other_shot
    turns = before & (F.col("gap_seconds") <= change) & (a["kind"] == "action") & acted & (a["act"] != b["act"]) & shared
    moves = before & (F.col("gap_seconds") <= close) & (a["kind"] == "camera") & (a["act"] != b["act"]) & F.arrays_overlap(a["scenes"], b["scenes"])
    inside = (F.col("relation") == "DURING") & a["kind"].isin("sound", "transition") & b["kind"].isin("speech", "action", "camera") & (a["s"] > b["s"] + tolerance) & (a["e"] - a["s"] < (b["e"] - b["s"]) / 2)
    kinds = F.array_compact(F.array(F.when(goes_on, F.lit("CONTINUES")), F.when(turns | moves, F.lit("CHANGES_TO")), F.when(inside, F.lit("INTERRUPTS"))))
    return both.select("video_id", "event_a", "event_b", F.explode(kinds).alias("relation"), "gap_seconds")


def shared_names(a: Column, b: Column, generic: tuple[str, ...] = ("person", "people", "object", "scene")) -> Column:
    """Entities that two lists share, normalised, in order of the first, without those that name nothing."""
    return F.array_except(F.array_intersect(F.transform(a, text.normalize_text), F.transform(b, text.normalize_text)), F.array(*[F.lit(g) for g in (*generic, "")]))


def shared_by_all(lists: DataFrame, key: str, items: str) -> DataFrame:
    """(key, shared): what every list of a key holds, sorted."""
    numbered = lists.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    held = lists.select(key, F.explode(F.array_distinct(items)).alias("_i")).groupBy(key, "_i").agg(F.count(F.lit(1)).alias("_c"))
    whole = held.join(numbered, key).filter("_c = _n").groupBy(key).agg(F.array_sort(F.collect_list("_i")).alias("shared"))
    return numbered.select(key).join(whole, key, "left").withColumn("shared", F.coalesce("shared", F.array().cast("array<string>")))


def training_pairs(clips: DataFrame, prompt: Column, path: str = "clip_path") -> DataFrame:
    """(pair_id, record_id, video_id, clip_path, prompt, negatives) of clips that have both a file and a prompt."""
    told = clips.withColumn("prompt", F.trim(prompt)).filter(f"{path} IS NOT NULL AND prompt <> ''")
    negatives = F.col("negatives") if "negatives" in clips.columns else F.array().cast("array<string>")
    return told.select(ids.stable_hash(F.lit("pair"), F.col("record_id"), length=16).alias("pair_id"), "record_id", "video_id", F.col(path).alias("clip_path"), "prompt", negatives.alias("negatives"))


def benchmark_items(records: DataFrame, task: str, needed: list[str], split: str = "test", human: bool = True) -> DataFrame:
    """Held-out records of a split as items of one task: accepted, by a human if asked, with all ``needed`` columns known.

    records: record_id, record_type, video_id, split, status, verification.
    """
    held = (F.col("split") == split) & (F.col("status") == "accepted") & (F.lit(not human) | (F.col("verification") == "human"))
    known = reduce(lambda a, c: a & F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False)) & ~F.coalesce(F.col(c).cast("string").isin("unknown"), F.lit(False)), needed, F.lit(True))
    return records.filter(held & known).select(ids.stable_hash(F.lit(task), F.col("record_id"), length=16).alias("item_id"), F.lit(task).alias("task"), "record_id", "record_type", "video_id", "split", *needed)


def parent_spans(records: DataFrame, parents: DataFrame, tolerance: float = 0.3) -> DataFrame:
    """Records with ``within``: whether their time lies in their parent's (by video_id, parent_id), null without a parent there."""
    held = parents.select("video_id", F.col("scene_id").alias("parent_id"), F.col("start_time").alias("_s"), F.col("end_time").alias("_e"))
    joined = records.join(held, ["video_id", "parent_id"], "left")
    return joined.withColumn("within", (F.col("start_time") >= F.col("_s") - tolerance) & (F.col("end_time") <= F.col("_e") + tolerance)).drop("_s", "_e")


def fair_use(records: DataFrame, key: str, caps: dict[str, int], order: Column) -> DataFrame:
    """Records within every cap of use: at most so many of each value of each capped column, those of the least ``order`` first, column by column."""
    out = records.withColumn("_o", order)
    for column, most in caps.items():
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy(column).orderBy("_o", key))).filter(F.col("_n") <= most).drop("_n")
    return out.drop("_o")
