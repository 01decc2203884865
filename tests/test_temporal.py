from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.functions import interval
from millrace.operators import temporal

EVENTS = "video_id string, event_id string, start_time double, end_time double"


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [((0, 2), (3, 5), ("BEFORE", False)), ((3, 5), (3.5, 4), ("DURING", True)), ((3, 4), (3, 5), ("STARTS", False)), ((3, 5), (4, 5), ("ENDS", True)), ((2, 4), (3, 5), ("OVERLAPS", False)), ((0, 2), (0, 2), None)],
)
def test_relation_of_two_intervals(spark, a, b, expected):
    r = spark.range(1).select(interval.relation(*[F.lit(float(x)) for x in (*a, *b)]).alias("r")).first()["r"]
    assert (tuple(r) if r else None) == expected


def test_neighbours_reach_k_and_inverse(spark):
    events = spark.createDataFrame([("v", f"e{i}", float(10 * i), 10.0 * i + 1) for i in range(5)], EVENTS)
    told = {(r.event_a, r.event_b, r.relation) for r in temporal.neighbour_relations(events, k=2, inverse=True).collect()}
    assert ("e0", "e2", "BEFORE") in told and ("e2", "e0", "AFTER") in told and ("e0", "e3", "BEFORE") not in told


def test_long_range_links_skip_near_ones(spark):
    events = spark.createDataFrame([("v", f"e{i}", 10.0 * i, 10.0 * i + 2, "dog") for i in range(1, 8)], EVENTS + ", entity string")
    links = {(r.event_a, r.event_b) for r in temporal.long_range_links(events, k=2).collect()}
    assert {b for a, b in links if a == "e1"} == {"e4", "e5"}
    assert temporal.long_range_links(events.limit(0)).count() == 0


def test_interval_join_gives_each_pair_once(spark):
    a = spark.createDataFrame([("v", "x", 0.0, 100.0), ("w", "y", 0.0, 1.0)], EVENTS)
    b = spark.createDataFrame([("v", "p", 50.0, 250.0), ("v", "q", 100.0, 120.0)], EVENTS)
    got = [(r.event_id, r.r_event_id) for r in temporal.interval_join(a, b, width=10.0).collect()]
    assert got == [("x", "p")]


def test_as_of_and_nearest(spark):
    left = spark.createDataFrame([("v", 1.0), ("v", 5.0), ("w", 5.0)], "video_id string, t double")
    right = spark.createDataFrame([("v", 2.0, "a"), ("v", 9.0, "b")], "video_id string, t double, x string")
    assert {(r.video_id, r.t): r.x for r in temporal.as_of(left, right, "x").collect()} == {("v", 1.0): None, ("v", 5.0): "a", ("w", 5.0): None}
    assert {(r.video_id, r.t): r.x for r in temporal.nearest(left, right, "x").collect()} == {("v", 1.0): "a", ("v", 5.0): "a", ("w", 5.0): None}


def test_runs_break_on_length_and_gap(spark):
    rows = [("v", str(i), 10.0 * i, 10.0 * i + 10) for i in range(15)] + [("v", "x", 200.0, 203.0)]
    scenes = spark.createDataFrame(rows, "video_id string, scene_id string, start_time double, end_time double")
    assert [(r.n, r.start_time) for r in temporal.bounded_runs(scenes).orderBy("run").collect()] == [(12, 0.0), (3, 120.0)]


def test_cycles_are_found(spark):
    edges = [("v", "a", "b", "BEFORE"), ("v", "b", "c", "BEFORE"), ("v", "c", "a", "BEFORE"), ("w", "a", "b", "BEFORE")]
    got = temporal.before_cycles(spark.createDataFrame(edges, "video_id string, event_a string, event_b string, relation string")).collect()
    assert [(r.video_id, r.cycle) for r in got] == [("v", ["a", "b", "c", "a"])]


def test_continuity_is_mutual(spark):
    scenes = spark.createDataFrame([("v", "1", 0.0, 2.0, ["a"]), ("v", "2", 2.3, 4.0, ["a", "b"]), ("v", "3", 9.0, 10.0, [])], "video_id string, scene_id string, start_time double, end_time double, objects array<string>")
    out = temporal.continuity(scenes)
    rows = {r.scene_id: r for r in out.collect()}
    assert rows["1"].temporal_adjacency and rows["1"].subject_continuity and not rows["2"].temporal_adjacency
    assert rows["2"].subject_continuity is None and rows["3"].next_scene_id is None
    assert temporal.continuity_faults(out).count() == 0


def test_evenly_spaced_takes_both_ends(spark):
    frames = spark.createDataFrame([("v", float(i)) for i in range(10)], "video_id string, t double")
    assert sorted(r.t for r in temporal.evenly_spaced(frames, 4).collect()) == [0.0, 3.0, 6.0, 9.0]


def test_points_in_intervals_of_any_length(spark):
    spans = [("v", "far", 0.0, 1e13), ("v", "long", -500.0, 4000.0), ("v", "short", 60.0, 61.0), ("v", "moment", 120.0, 120.0), ("v", "none", 9.0, 8.0), ("u", "other", 0.0, 1e6)]
    points = [("v", "a", 60.0), ("v", "b", 61.0), ("v", "c", 120.0), ("v", "d", -500.0), ("v", "e", 4000.5), ("v", "f", 1e13), ("u", "g", 8.5)]
    got = temporal.points_in_intervals(spark.createDataFrame(points, "video_id string, p string, t double"), spark.createDataFrame(spans, EVENTS)).collect()
    want = sorted((p, i) for v, p, t in points for u, i, s, e in spans if u == v and s <= t <= e)
    assert sorted((r.p, r.r_event_id) for r in got) == want


def test_scans_are_dealt_by_their_size(spark, monkeypatch):
    from millrace import runtime

    frame = runtime.read(spark, "/root/testdata/sf0.001", "lineitem")
    assert runtime.dealt(frame, "l_orderkey") is frame
    monkeypatch.setattr(runtime, "SCAN_BYTES", 10_000)
    many = runtime.dealt(frame, "l_orderkey")
    assert many.rdd.getNumPartitions() > 8 and many.count() == frame.count()
