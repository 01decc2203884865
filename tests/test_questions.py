from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace import plugins
from millrace.functions import captions
from millrace.operators import ocr, questions


def test_generated_questions_are_well_formed_and_recompute(spark):
    rows = [("v", f"e{i}", "a", 12.0 * i, 12.0 * i + 4, ["a car passes", "the camera pans left", "a dog barks"][i % 3]) for i in range(8)]
    events = spark.createDataFrame(rows, "video_id string, event_id string, event_type string, start_time double, end_time double, event string")
    asked = questions.generate(events)
    assert {r.type for r in asked.select("type").distinct().collect()} >= {"duration", "event_localization", "temporal_ordering", "timestamp"}
    assert asked.filter(F.size(questions.form_faults(F.col("question"))) > 0).count() == 0
    assert asked.filter(F.size(questions.answer_faults(F.col("answer"), F.col("type"))) > 0).count() == 0
    states = {r.recomputed for r in questions.recompute(asked, events).collect()}
    assert states == {"passed"}
    wrong = asked.filter("type = 'duration'").withColumn("answer", F.lit("About 9 seconds (from 1.0s to 2.0s)."))
    assert {r.recomputed for r in questions.recompute(wrong, events).collect()} == {"failed"}


def test_all_eight_templates(spark):
    rows = [("v", f"e{i}", ["appearance", "action", "action"][i % 3], 12.0 * i, 12.0 * i + 4, ["a car passes", "the camera pans left", "a dog barks"][i % 3], ["car", "view", "dog"][i % 3], "day" if i < 5 else "night") for i in range(8)]
    events = spark.createDataFrame(rows, "video_id string, event_id string, event_type string, start_time double, end_time double, event string, entity string, light string")
    asked = questions.generate(events, entity="entity", attributes=["light"]).cache()
    got = asked.collect()
    assert {r.type for r in got} == set(questions.ANSWERS) - {"before_after"}
    assert asked.filter(F.size(questions.form_faults(F.col("question"))) > 0).count() == 0
    assert asked.filter(F.size(questions.answer_faults(F.col("answer"), F.col("type"))) > 0).count() == 0
    assert {r.recomputed for r in questions.recompute(asked, events).collect()} == {"passed"}
    late = events.withColumn("start_time", F.col("start_time") + F.when(F.col("event_id").isin("e5", "e2"), 300).otherwise(0)).withColumn("end_time", F.col("end_time") + F.when(F.col("event_id").isin("e5", "e2"), 300).otherwise(0))
    wrong = {r.type for r in questions.recompute(asked, late).collect() if r.recomputed == "failed"}
    assert wrong >= {"duration", "event_localization", "timestamp", "temporal_ordering", "state_change", "multi_event", "long_range"}
    assert {r.recomputed for r in questions.recompute(asked, events.limit(0)).collect()} == {"not_run"}
    change = [r for r in got if r.type == "state_change"]
    assert [(r.answer, r.event_ids, r.start_time, r.end_time, r.difficulty) for r in change] == [("The light changes from day to night (the change happens around 60.0s).", ["e4", "e5"], 48.0, 64.0, "medium")]
    assert len([r for r in got if r.type == "multi_event"]) == 12
    assert any(r.answer == "3 shots (starting around 0s, 36s, 72s)." and r.event_ids == ["e0", "e3", "e6"] for r in got)
    assert any(r.type == "long_range" and r.event_ids == ["e1", "e4"] and r.difficulty == "hard" for r in got)


@pytest.mark.parametrize(("text", "expected"), [("the camera pans left", ["pan_left"]), ("it pans left and pans right", ["pan_left", "pan_right"]), ("a still camera", ["static"]), ("nothing", [])])
def test_movements(spark, text, expected):
    row = spark.range(1).select(captions.movements(F.lit(text)).alias("m"), captions.contradictions(F.lit(text)).alias("c")).first()
    assert row.m == expected and bool(row.c) == (len(expected) == 2)


def test_camera_conflicts(spark):
    rows = spark.createDataFrame([("pans left", "pan_right"), ("pans left", "pan_left"), ("a fixed camera", "zoom_in"), ("zooms in", "static"), ("zooms in", "pan_left"), ("zooms in", None)], "t string, m string")
    got = [(r.c.hard, r.c.soft) for r in rows.select(captions.camera_conflicts(F.col("t"), F.col("m")).alias("c")).collect()]
    assert got == [(["opposite_direction"], []), ([], []), (["said_static"], []), (["said_moving"], []), ([], ["other_movement"]), ([], [])]


def test_prompt_needs_more_than_timing(spark):
    n, s = F.lit(None).cast("string"), F.array().cast("array<string>")
    full = captions.generation_prompt(F.lit(4.0), F.lit("wide"), F.array(F.lit("a car"), F.lit("a dog")), F.lit("outdoor"), F.lit("night"), F.lit("slow pan to the left"), F.lit("dim"), s)
    bare = captions.generation_prompt(F.lit(4.0), n, s, n, n, n, n, s)
    row = spark.range(1).select(full.alias("f"), bare.alias("b")).first()
    assert row.f == "A 4-second wide shot of a car and a dog outdoors at night, slow pan to the left, dim lighting." and row.b is None


def test_tracks_fragments_and_misreads(spark):
    rows = [("v", "HELLO WORLD", float(t)) for t in range(5)] + [("v", "hello", 2.0), ("v", "HELLO WORLO", 3.5), ("v", "HELLO WORLD", 60.0)]
    found = ocr.tracks(spark.createDataFrame(rows, "video_id string, text string, t double"))
    assert sorted((r.text, r.n) for r in found.collect()) == [("hello", 1), ("hello world", 1), ("hello world", 5), ("hello worlo", 1)]
    assert {(r.text, r.whole) for r in ocr.fragments(found).collect()} >= {("hello", "hello world")}
    assert [(r.text, r.likely) for r in ocr.misreads(found).collect()] == [("hello worlo", "hello world")]


def test_providers(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    got = rows.select(plugins.apply("mock_vision", F.col("x")).alias("m"), plugins.apply("null", F.col("x")).alias("n")).collect()
    assert got[0].m in plugins.MockAnalyzer.LABELS and got[1].m is None and {r.n for r in got} == {None}
    slept: list[float] = []
    bucket = plugins.TokenBucket(2.0, 1, clock=lambda: 0.0, sleep=slept.append)
    bucket.take(), bucket.take()
    assert slept == [0.5]


def test_timestamps_name_all_that_is_active(spark):
    events = spark.createDataFrame([("v", f"e{i}", float(i), 100.0 - i, f"thing {i}") for i in range(7)], "video_id string, event_id string, start_time double, end_time double, event string")
    got = {r.answer: (r.event_ids, r.start_time, r.end_time) for r in questions.timestamps(events).collect()}
    assert got == {" ".join(f"Thing {i}." for i in range(7)): ([f"e{i}" for i in range(7)], 0.0, 100.0)}


def test_conflicts_look_through_a_caption_once(spark):
    from millrace.plans import QUERIES

    plan = QUERIES["caption_conflicts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(captions.MOVEMENTS["tilt_up"]) == 1
