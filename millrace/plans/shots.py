"""Queries of windows, runs and measurements."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids
from ..functions.media import box_iou, camera_label
from ..operators import motion, shots, stats, temporal
from ..runtime import read
from .registry import query
from .views import SCENES, TIMELINE, scenes, timeline


@query(f"WITH {SCENES}, l AS (SELECT video_id, scene_id, lead(scene_id) OVER (PARTITION BY video_id ORDER BY start_time, scene_id) AS nxt, CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE lag(scene_id) OVER (PARTITION BY video_id ORDER BY start_time, scene_id) END AS prv FROM scenes) SELECT a.video_id, a.scene_id, a.nxt AS next_scene_id FROM l a LEFT JOIN l b ON a.video_id = b.video_id AND a.nxt = b.scene_id JOIN (SELECT 1) ON true WHERE a.nxt IS NOT NULL AND b.prv IS DISTINCT FROM a.scene_id".replace("l_suppkey % 10", "(video_id + scene_id) % 10"))
def continuity_faults(spark, sf_dir):
    linked = temporal.continuity(scenes(spark, sf_dir)).withColumn("prev_scene_id", F.when((F.col("video_id") + F.col("scene_id")) % 10 != 0, F.col("prev_scene_id")))
    return temporal.continuity_faults(linked)


@query("WITH o AS (SELECT user_id, event_id, value, sum(CASE WHEN value >= 40 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS i FROM events), r AS (SELECT user_id, i, count(*) AS length, min(event_id) AS start, max(event_id) AS \"end\" FROM o WHERE value >= 40 GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY length DESC, start) AS n FROM r) SELECT user_id, length, start AS first, \"end\" AS last FROM b WHERE n = 1")
def longest_level_run(spark, sf_dir):
    found = shots.longest_run(read(spark, sf_dir, "events"), "value", 40.0, "user_id", "event_id")
    return found.select("user_id", "length", F.col("start").alias("first"), F.col("end").alias("last"))


_WALK = f"WITH RECURSIVE {SCENES}, o AS (SELECT video_id, scene_id, start_time AS s, end_time AS e, row_number() OVER (PARTITION BY video_id ORDER BY start_time, scene_id::VARCHAR) AS rn FROM scenes)"


@query(f"{_WALK}, r AS (SELECT video_id, scene_id, rn, 1::BIGINT AS segment, 1 AS held, s AS began, e FROM o WHERE rn = 1 UNION ALL SELECT o.video_id, o.scene_id, o.rn, CASE WHEN r.held >= 3 OR r.e - r.began >= 60 THEN r.segment + 1 ELSE r.segment END, CASE WHEN r.held >= 3 OR r.e - r.began >= 60 THEN 1 ELSE r.held + 1 END, CASE WHEN r.held >= 3 OR r.e - r.began >= 60 THEN o.s ELSE r.began END, o.e FROM r JOIN o ON o.video_id = r.video_id AND o.rn = r.rn + 1) SELECT video_id, scene_id::VARCHAR AS scene_id, segment FROM r")
def shot_segments(spark, sf_dir):
    return shots.segments(scenes(spark, sf_dir), most=3, longest=60.0)


@query(f"{_WALK}, r AS (SELECT video_id, scene_id, rn, 1 AS run, 1 AS n, s AS began, s, e FROM o WHERE rn = 1 UNION ALL SELECT o.video_id, o.scene_id, o.rn, CASE WHEN abs(o.s - r.e) <= 0.5 AND o.e - r.began <= 120 AND r.n < 12 THEN r.run ELSE r.run + 1 END, CASE WHEN abs(o.s - r.e) <= 0.5 AND o.e - r.began <= 120 AND r.n < 12 THEN r.n + 1 ELSE 1 END, CASE WHEN abs(o.s - r.e) <= 0.5 AND o.e - r.began <= 120 AND r.n < 12 THEN r.began ELSE o.s END, o.s, o.e FROM r JOIN o ON o.video_id = r.video_id AND o.rn = r.rn + 1), g AS (SELECT video_id, run AS g, string_agg(scene_id::VARCHAR, ',' ORDER BY rn) AS scene_ids, min(s) AS start_time, max(e) AS end_time, count(*) AS n FROM r GROUP BY ALL) SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY g) AS run, scene_ids, start_time, end_time, n FROM g WHERE n >= 2 AND end_time - start_time >= 8")
def sequence_runs(spark, sf_dir):
    return temporal.bounded_runs(scenes(spark, sf_dir)).withColumn("scene_ids", F.array_join("scene_ids", ","))


@query(f"WITH {SCENES}, p AS (SELECT *, lag(scene_id) OVER (PARTITION BY video_id ORDER BY start_time, scene_id) AS previous, CASE l_returnflag WHEN 'A' THEN 'cut' WHEN 'N' THEN 'fade' END AS transition FROM scenes) SELECT video_id, scene_id, previous, transition, greatest(0, start_time - 0.25) AS start_time, start_time + 0.25 AS end_time FROM p WHERE previous IS NOT NULL AND transition IS NOT NULL")
def transition_events(spark, sf_dir):
    kind = F.when(F.col("l_returnflag") == "A", F.lit("cut")).when(F.col("l_returnflag") == "N", F.lit("fade"))
    return shots.transitions(scenes(spark, sf_dir), kind)


@query(f"WITH {TIMELINE}, l AS (SELECT video_id, event_id AS number, CASE WHEN event_id % 17 = 0 THEN start_time - 500000 ELSE start_time END AS t FROM timeline), s AS (SELECT video_id, number, t - lag(t) OVER (PARTITION BY video_id ORDER BY number) AS step FROM l) SELECT video_id, number, CASE WHEN step < 0 THEN 'out_of_order' WHEN step = 0 THEN 'repeated' ELSE 'gap' END AS fault FROM s WHERE step <= 0 OR step > 300000")
def frame_order_faults(spark, sf_dir):
    t = F.when(F.col("event_id") % 17 == 0, F.col("start_time") - 500000).otherwise(F.col("start_time"))
    return shots.frame_faults(timeline(spark, sf_dir).select("video_id", F.col("event_id").alias("number"), t.alias("t")), 300000.0)


@query("WITH p AS (SELECT user_id AS video_id, event_id AS t, value AS x, value * 0.5 AS y FROM events), s AS (SELECT *, lag(t) OVER w AS was, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS step FROM p WINDOW w AS (PARTITION BY video_id ORDER BY t)) SELECT video_id, min(was) AS first, max(t) AS last FROM s WHERE step > 60 GROUP BY video_id")
def moving_spans(spark, sf_dir):
    points = read(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), F.col("event_id").alias("t"), F.col("value").alias("x"), (F.col("value") * 0.5).alias("y"))
    return shots.moving_span(points, 60.0).select("video_id", F.col("start").alias("first"), F.col("end").alias("last"))


@query(f"WITH {SCENES}, n AS (SELECT *, lead(scene_id) OVER w IS NULL AS is_last, row_number() OVER w = 1 AS is_first, max(end_time) OVER (PARTITION BY video_id) + 0.4 AS d FROM scenes WINDOW w AS (PARTITION BY video_id ORDER BY start_time, scene_id)) SELECT video_id, scene_id, CASE WHEN is_first AND start_time <= 0.5 THEN 0 ELSE start_time END AS start_time, CASE WHEN is_last AND video_id % 2 = 0 THEN d ELSE end_time END AS end_time FROM n")
def snapped_scenes(spark, sf_dir):
    shots_ = scenes(spark, sf_dir)
    last = shots_.groupBy("video_id").agg(F.max("end_time").alias("_end"))
    duration = F.col("_end") + F.when(F.col("video_id") % 2 == 0, 0.4).otherwise(0.9)
    return shots.snapped(shots_.join(last, "video_id"), duration).select("video_id", "scene_id", "start_time", "end_time")


@query(f"WITH {SCENES}, n AS (SELECT *, greatest(1, ceil((end_time - start_time) / 15))::BIGINT AS k FROM scenes), p AS (SELECT *, unnest(range(k)) AS part FROM n) SELECT video_id, scene_id, part, start_time + part * 15 AS start_time, least(start_time + part * 15 + 15, end_time) AS end_time, round((least(start_time + part * 15 + 15, end_time) - (start_time + part * 15)) * 24)::BIGINT AS frames FROM p")
def clip_plan(spark, sf_dir):
    return shots.planned_clips(scenes(spark, sf_dir).withColumn("fps", F.lit(24.0)), 15.0).select("video_id", "scene_id", "part", "start_time", "end_time", "frames")


@query(f"WITH {SCENES}, g AS (SELECT *, (scene_id - 1) // 3 AS segment FROM scenes), m0 AS (SELECT video_id, segment, l_returnflag, count(*) AS n FROM g GROUP BY ALL), m AS (SELECT *, row_number() OVER (PARTITION BY video_id, segment ORDER BY n DESC, l_returnflag) AS r FROM m0), o AS (SELECT video_id, segment, unnest(list_distinct(objects)) AS s FROM g), c0 AS (SELECT video_id, segment, s, count(*) AS n FROM o GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY video_id, segment ORDER BY n DESC, s) AS r FROM c0), t AS (SELECT video_id, segment, string_agg(s, ',' ORDER BY r) AS subjects FROM c WHERE r <= 3 GROUP BY ALL), b AS (SELECT video_id, segment, string_agg(scene_id::VARCHAR, ',' ORDER BY start_time, scene_id) AS scene_ids, min(start_time) AS start_time, max(end_time) AS end_time FROM g GROUP BY ALL) SELECT b.video_id, b.segment, m.l_returnflag, subjects, scene_ids, start_time, end_time FROM b JOIN m ON b.video_id = m.video_id AND b.segment = m.segment AND m.r = 1 JOIN t ON b.video_id = t.video_id AND b.segment = t.segment")
def description_groups(spark, sf_dir):
    grouped = scenes(spark, sf_dir).withColumn("segment", F.floor((F.col("scene_id") - 1) / 3))
    told = shots.descriptions(grouped, "l_returnflag", "objects")
    return told.withColumn("subjects", F.array_join("subjects", ",")).withColumn("scene_ids", F.array_join("scene_ids", ","))


@query("SELECT l_orderkey, l_returnflag AS label, count(*) AS n, max(l_discount) AS best, round(avg(l_discount), 9) AS mean FROM lineitem GROUP BY ALL")
def detections_by_class(spark, sf_dir):
    return shots.detected(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "l_discount").withColumnRenamed("l_returnflag", "label").withColumn("mean", F.round("mean", 9))


@query("SELECT user_id, round(regr_slope(value, event_id), 9) AS slope FROM events GROUP BY user_id")
def trajectory_slope(spark, sf_dir):
    return stats.slope(read(spark, sf_dir, "events"), ["user_id"], "value", "event_id").withColumn("slope", F.round("slope", 9))


@query("WITH m0 AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM m0), v AS (SELECT user_id, round(avg(value), 6) AS value_mean, median(value) AS value_median FROM events GROUP BY 1) SELECT v.user_id, value_mean, value_median, event_type AS event_type_mode FROM v JOIN m ON v.user_id = m.user_id AND r = 1")
def measurement_summaries(spark, sf_dir):
    return motion.summaries(read(spark, sf_dir, "events"), ["user_id"], ["value"], ["event_type"]).withColumn("value_mean", F.round("value_mean", 6))


@query(f"WITH {TIMELINE} SELECT video_id, 'evt_' || printf('%04d', row_number() OVER (PARTITION BY video_id ORDER BY start_time, end_time, event_type, event_id)) AS number, event_id FROM timeline")
def renumbered_events(spark, sf_dir):
    told = temporal.renumbered(timeline(spark, sf_dir).withColumn("event", F.col("event_id")), "evt_", ["start_time", "end_time", "event_type", "event"], name="number")
    return told.select("video_id", "number", F.col("event").alias("event_id"))


@query("WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount - 0.05 AS dx, l_tax - 0.04 AS dy, l_discount * 8 AS m, (l_quantity - 25) / 800 AS d FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN m < 0.3 THEN 'static' WHEN abs(d) >= 0.02 THEN CASE WHEN d > 0 THEN 'zoom_in' ELSE 'zoom_out' END WHEN abs(dx) >= abs(dy) THEN CASE WHEN dx > 0 THEN 'pan_left' ELSE 'pan_right' END WHEN dy > 0 THEN 'tilt_up' ELSE 'tilt_down' END AS label FROM f")
def flow_labels(spark, sf_dir):
    label = camera_label(F.col("l_discount") - 0.05, F.col("l_tax") - 0.04, F.col("l_discount") * 8, (F.col("l_quantity") - 25) / 800)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", label.alias("label"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN 40.0 WHEN 'click' THEN value * 500 WHEN 'purchase' THEN 200.0 WHEN 'signup' THEN 1000.0 END::DOUBLE AS uncertainty_ms FROM events")
def boundary_uncertainty(spark, sf_dir):
    precision = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in (("view", "exact"), ("click", "sample"), ("purchase", "word"), ("signup", "scene"))])
    return read(spark, sf_dir, "events").select("event_id", motion.uncertainty_ms(precision, F.col("value")).alias("uncertainty_ms"))


@query("WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, [l_discount, l_tax, l_discount + 0.1, l_tax + 0.1] AS a, [0.03, 0.03, 0.12, 0.12] AS c FROM lineitem), i AS (SELECT *, greatest(0, least(a[3], c[3]) - greatest(a[1], c[1])) * greatest(0, least(a[4], c[4]) - greatest(a[2], c[2])) AS x FROM b) SELECT l_orderkey, l_linenumber, l_partkey, round(x / ((a[3] - a[1]) * (a[4] - a[2]) + 0.0081 - x), 6) AS iou FROM i")
def box_overlap(spark, sf_dir):
    a = F.struct(F.col("l_discount").alias("x1"), F.col("l_tax").alias("y1"), (F.col("l_discount") + 0.1).alias("x2"), (F.col("l_tax") + 0.1).alias("y2"))
    b = F.struct(F.lit(0.03).alias("x1"), F.lit(0.03).alias("y1"), F.lit(0.12).alias("x2"), F.lit(0.12).alias("y2"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(box_iou(a, b), 6).alias("iou"))


@query("SELECT event_id, substr(sha1('video|' || user_id || '|' || event_type), 1, 12) AS stable, 'clip_' || lpad((event_id % 1000)::VARCHAR, 3, '0') AS clip FROM events")
def stable_ids(spark, sf_dir):
    told = ids.stable_hash(F.lit("video"), F.col("user_id").cast("string"), F.col("event_type"))
    return read(spark, sf_dir, "events").select("event_id", told.alias("stable"), ids.numbered("clip_", F.col("event_id") % 1000, 3).alias("clip"))
