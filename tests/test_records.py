from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace import plugins
from millrace.functions import audio, camera, captions, media, parsing, text
from millrace.operators import agreement, builders, curation, dedup, factory, governance, motion, negatives, policy, relational, release, reports, shots, stats, temporal
from millrace.streaming import incremental


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()


def test_gaps_are_filled_where_they_are_largest(spark):
    rows = [("v", float(t), 0 if t in (0, 100) else 1) for t in range(0, 101, 10)]
    got = shots.filled_gaps(spark.createDataFrame(rows, "video_id string, t double, priority int"), 4)
    assert sorted(r.t for r in got.collect()) == [0.0, 20.0, 50.0, 100.0]


def test_wrong_answers_differ_and_lie_outside(spark):
    events = spark.createDataFrame([("v", f"e{i}", 20.0 * i, 20.0 * i + 5, f"a {w} moves") for i, w in enumerate(("car", "dog", "cat", "bus", "car"))], "video_id string, event_id string, start_time double, end_time double, event string")
    asked = spark.createDataFrame([("v", "q1", "temporal_ordering", "First a car moves, then a dog moves.", 0.0, 25.0), ("v", "q2", "duration", "About 4 seconds (from 2.0s to 6.0s).", 2.0, 6.0), ("v", "q3", "timestamp", "A car moves.", 0.0, 5.0)], "video_id string, question_id string, type string, answer string, start_time double, end_time double")
    got = negatives.wrong_answers(asked, events, spark.createDataFrame([("v", 100.0)], "video_id string, duration double")).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.rank):
        by.setdefault(r.question_id, []).append((r.kind, r.negative))
    assert by["q1"][0] == ("swapped_order", "First a dog moves, then a car moves.") and by["q2"][0][0] == "wrong_duration"
    assert all(len(v) <= 3 and len({n for _, n in v}) == len(v) for v in by.values())
    assert "A car moves." not in [n for _, n in by["q3"]] and all(k == "other_event" for k, _ in by["q3"])


def test_wordings_need_their_fields(spark):
    rows = spark.createDataFrame([("a", "pan", "day"), ("b", None, "night")], "k string, camera string, light string")
    got = negatives.worded(rows, ["A {camera} by {light}.", "By {light}.", "At {light}, calm."], ["camera", "light"], "k").collect()
    assert all("{" not in r.prompt for r in got) and {r.wording for r in got} == {0, 1} and len(got) == 4
    assert {r.prompt for r in got if r[0] == "b"} == {"By night.", "At night, calm."}


@pytest.mark.parametrize(("said", "meant"), [('x {"a": 1} y', {"a": 1}), ("```json\n{'a': [1, 2,]}\n```", {"a": [1, 2]}), ('{"a": {"b": "c', {"a": {"b": "c"}}), ("none", None), (None, None), ('{"a": "br{ace"}', {"a": "br{ace"})])
def test_answers_are_read_tolerantly(said, meant):
    got = parsing.first_object(said)
    assert (json.loads(got) if got else None) == meant


def test_camera_words_and_taxonomy(spark):
    for label in camera.LABELS:
        row = one(spark, camera.family(F.lit(label)), camera.direction(F.lit(label)), camera.from_parts(camera.family(F.lit(label)), camera.direction(F.lit(label))))
        assert row.c2 == label and (row.c1 or "") in camera.DIRECTIONS[row.c0]
    row = one(spark, camera.from_parts(F.lit("orbit"), F.lit("anticlockwise")), camera.stabilisation(F.lit("on a tripod")), camera.depth_of_field(F.lit("bokeh")), audio.category(F.lit("Dog bark")), camera.video_flags(F.lit(320), F.lit(240), F.lit(30.0), F.lit(1.0), F.lit(True)))
    assert (row.c0, row.c1, row.c2, row.c3, row.c4) == ("orbit_counterclockwise", "stabilized", "shallow", "animal", ["low_resolution", "too_short"])


def test_flags_name_limits_in_order(spark):
    n = F.lit(None).cast("double")
    row = one(spark, captions.outside(captions.SHOT_LIMITS, sharpness=F.lit(1.0), dark=F.lit(0.9), bright=n), captions.light_conflict(F.lit("dark"), F.lit(200.0)), captions.light_conflict(F.lit("odd"), F.lit(1.0)), text.specificity(F.lit("a red car passes 3 houses")), media.one_edit(F.lit("abc"), F.lit("abd")))
    assert row.c0 == ["blurry", "underexposed"] and row.c1 is True and row.c2 is None and row.c3 is not None and row.c4 is True


def test_providers_answer_for_every_row(spark):
    rows = spark.createDataFrame([("SALE now 12",), (None,)], "x string")
    for name in plugins.PROVIDERS:
        source = rows.withColumn("x", F.when(F.col("x").isNotNull(), F.lit("25.0"))) if name == "fixed_scenes" else rows
        got = [r.y for r in source.select(plugins.apply(name, F.col("x")).alias("y")).collect()]
        assert len(got) == 2 and got[1] is None and (got[0] is None) == (name == "null"), name
    assert json.loads(plugins.FixedScenes().batch(["25"])[0]) == [[0.0, 10.0], [10.0, 20.0], [20.0, 25.0]]
    assert json.loads(plugins.WordVerifier().batch(["a red car|||the red car passes"])[0])["state"] == "passed"


def test_greedy_canonical_is_not_transitive(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (5, 9)], "a long, b long")
    assert {(r.id, r.canonical) for r in dedup.greedy_canonical(None, pairs).collect()} == {(2, 1), (9, 5)}


def test_question_pairs_need_type_evidence_and_answer(spark):
    rows = [("q1", "duration", "How long is it?", "About 4 seconds", ["e1"], 0.0, 4.0), ("q2", "duration", "How long is it", "About 4 seconds", ["e1"], 0.0, 4.0), ("q3", "duration", "How long is it now?", "About 9 seconds", ["e7"], 50.0, 59.0)]
    asked = spark.createDataFrame(rows, "question_id string, type string, question string, answer string, event_ids array<string>, start_time double, end_time double")
    near = spark.createDataFrame([("q1", "q2"), ("q1", "q3")], "a string, b string")
    assert [(r.a, r.b) for r in dedup.question_pairs(asked, near).collect()] == [("q1", "q2")]


def test_richer_relations_of_a_short_timeline(spark):
    rows = [("e1", "action", 0.0, 2.0, "ride", ["man"], ["s1"]), ("e2", "action", 2.5, 4.0, "ride", ["man"], ["s2"]), ("e3", "action", 5.0, 6.0, "fall", ["man"], ["s2"]), ("e4", "speech", 0.0, 20.0, "", [], ["s1"]), ("e5", "sound", 8.0, 9.0, "", [], ["s2"])]
    events = spark.createDataFrame([("v", *r) for r in rows], "video_id string, event_id string, event_type string, start_time double, end_time double, action string, entities array<string>, scene_ids array<string>")
    got = {(r.event_a, r.event_b, r.relation) for r in builders.richer_relations(temporal.neighbour_relations(events), events).collect()}
    assert got == {("e1", "e2", "CONTINUES"), ("e2", "e3", "CHANGES_TO"), ("e5", "e4", "INTERRUPTS")}


def test_events_of_all_seven_modalities(spark):
    scenes = spark.createDataFrame([("v", "s1", 0.0, 5.0, ["car"], ["a car stops"], "pan_left", "day"), ("v", "s2", 5.0, 9.0, ["dog"], [], "unknown", "night")], "video_id string, scene_id string, start_time double, end_time double, objects array<string>, actions array<string>, camera string, light string")
    speech = spark.createDataFrame([("v", "so it goes on", 1.0, 2.0), ("v", "no", 3.0, 3.2)], "video_id string, text string, start_time double, end_time double")
    tracks = spark.createDataFrame([("v", "SALE", 2.0, 4.0)], "video_id string, text string, start_time double, end_time double")
    sounds = spark.createDataFrame([("v", "bark", "animal", 6.0, 7.0), ("v", "talk", "speech", 1.0, 2.0)], "video_id string, label string, category string, start_time double, end_time double")
    cuts = shots.transitions(scenes, F.lit("cut"))
    made = builders.all_events(builders.vision_events(scenes), builders.camera_events(scenes), builders.speech_events(speech), builders.screen_text_events(tracks), builders.sound_events(sounds), builders.change_events(scenes, ["light"]), builders.cut_events(cuts)).collect()
    assert sorted(r.event_type for r in made) == ["action", "appearance", "camera", "sound", "speech", "state_change", "text_on_screen", "transition"]
    assert next(r for r in made if r.event_type == "action").entities == ["car"] and [r.event_id for r in sorted(made, key=lambda r: (r.start_time, r.end_time))][0] == "evt_00001"


def test_rights_and_cleanup(spark):
    files = spark.createDataFrame([("a", "x", 5, "clip"), ("b", "y", 6, "clip"), ("m", "z", 7, "manifest")], "path string, sha256 string, length long, kind string")
    up = spark.createDataFrame([("a", "x", True), ("b", "other", True), ("m", "z", True)], "path string, sha256 string, verified boolean")
    assert [(r.path, r.bytes) for r in governance.removable(files, up).collect()] == [("a", 5)]
    kept = {r.key: r.value for r in governance.reproducibility(spark, {"seed": "1"}).collect()}
    assert kept["spark"] == spark.version and kept["config:seed"] == "1" and len(kept["config"]) == 16
    old = spark.createDataFrame([("r1", "a", "1.0"), ("r2", "b", "1.0")], "record_id string, label string, schema_version string")
    redone = governance.reannotated(old, [lambda d: d.withColumn("label", F.upper("label")).withColumn("schema_version", F.lit("2")), lambda d: d.withColumn("label", F.when(F.col("label") == "A", F.lit("a")).otherwise(F.col("label")))])
    assert {r.record_id: r.changed for r in redone.collect()} == {"r1": False, "r2": True}


def test_small_rules(spark):
    row = one(
        spark,
        motion.with_status(F.struct(F.lit("accepted").alias("status"), F.array().cast("array<string>").alias("reason_codes")), F.lit("review"), "x", F.array().cast("array<struct<was: string, now: string, reason: string>>")),
        curation.tier_rank(F.lit("gold")),
        governance.impossible_time(F.lit(-1.0), F.lit(None).cast("double")),
        governance.stage_block({"asr": F.lit(0), "ocr": F.lit(None).cast("int")}),
        builders.shared_names(F.array(F.lit("A Car"), F.lit("person")), F.array(F.lit("a car"), F.lit("person"))),
    )
    assert row.c0.validation.status == "review" and [tuple(h) for h in row.c0.history] == [("accepted", "review", "x")]
    assert (row.c1, row.c2, row.c3, row.c4) == (3, True, {"asr": "empty", "ocr": "not_run"}, ["a car"])
    assert motion.record_kind(["event_id", "event_type"]) in ("event", "events") and "x" in reports.rendered(spark.createDataFrame([("x", 1.5)], "a string, b double"), ["a", "b"], ["a"])


def test_machine_paths_histories_and_states(spark):
    rows = spark.createDataFrame([("r1", "/home/u/x"), ("r2", "clips/x"), ("r3", "C:\\x")], "record_id string, p string")
    assert sorted(r.record_id for r in release.machine_paths(rows).collect())[:1] == ["r1"]
    held = spark.createDataFrame([("g1", "test")], "g string, split string")
    groups = spark.createDataFrame([(f"g{i}",) for i in range(30)], "g string")
    assert {r.g: r.split for r in curation.keep_assignments(groups, held, "g").collect()}["g1"] == "test"
    stages = spark.createDataFrame([("v", s, "done") for s in ("a", "b", "c")], "video_id string, stage string, status string")
    reset = incremental.reset_downstream(stages, ["a", "b", "c"], spark.createDataFrame([("v", "b")], "video_id string, stage string"))
    assert {r.stage: r.status for r in reset.collect()} == {"a": "done", "b": "pending", "c": "pending"}
    items = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    done = spark.createDataFrame([("x", "s", "1")], "k string, step string, input_hash string")
    assert [r.k for r in incremental.pending(items, done, "k", "s", F.col("v").cast("string")).collect()] == ["y"]


def test_hashes_of_sets_of_any_size(spark):
    keys = spark.createDataFrame([(i,) for i in range(500)], "k long")
    a, b = stats.ranged_hash(keys, "k").first(), stats.ranged_hash(keys.orderBy(F.rand()).unionAll(keys), "k").first()
    assert (a.frozen, a.n) == (b.frozen, 500) and stats.ranged_hash(keys.filter("k > 0"), "k").first().frozen != a.frozen
    with pytest.raises(Exception, match="more than 10 keys"):
        stats.frozen_hash(keys, "k", most=10).collect()


def test_alignment_and_lookalikes(spark):
    scores = spark.createDataFrame([("v", c, f, 1.0 if c == f else 0.2 + 0.1 * f) for c in range(5) for f in range(5)], "v string, c int, f int, s double")
    assert {r.state for r in relational.aligned(scores, "v", "c", "f", "s").collect()} == {"passed"}
    assert {r.state for r in relational.aligned(scores.filter("c < 2 AND f < 2"), "v", "c", "f", "s").collect()} == {"not_run"}
    assert agreement.sample_size(0) == 0 and policy.STATES[0] == "passed" and factory.EVIDENCE[0] == "cleared"
