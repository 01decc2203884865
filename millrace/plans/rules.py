"""Queries of rules: policies, eligibility, camera and caption checks, made texts, richer relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import audio, camera, captions, media, parsing, text
from ..functions.reasons import first_reason
from ..operators import builders, curation, dedup, factory, governance, motion, negatives, ocr, policy, questions, temporal
from ..runtime import read, spread
from .registry import query
from .views import SCENES, TIMELINE, scenes, timeline

KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_K = ", ".join(KEY)


def _lines(spark, sf_dir):
    return read(spark, sf_dir, "lineitem")


def _choice(column, *pairs, default=None):
    out = F.lit(default).cast("string") if default is None else F.lit(default)
    return F.coalesce(*[F.when(column == k, F.lit(v)) for k, v in pairs], out)


@query(f"SELECT {_K}, l_discount >= 0 AND l_quantity / 10 >= l_discount * 20 - 0.0 AND l_quantity / 10 <= 4 + 0.05 AS fits FROM lineitem")
def timespans(spark, sf_dir):
    ok = policy.timespan_ok(F.col("l_discount") * 20, F.col("l_quantity") / 10, F.lit(4.0))
    return _lines(spark, sf_dir).select(*KEY, ok.alias("fits"))


@query(f"SELECT {_K}, CASE WHEN l_returnflag = 'A' AND l_linestatus <> 'O' AND (l_linenumber = 1 OR l_tax > 0.04) THEN 'review' ELSE CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'review' ELSE 'rejected' END END AS status FROM lineitem")
def export_policy(spark, sf_dir):
    status = _choice(F.col("l_returnflag"), ("A", "accepted"), ("N", "review"), ("R", "rejected"))
    version = F.when(F.col("l_linenumber") != 1, F.lit("2"))
    boundary = F.when(F.col("l_tax") <= 0.04, F.lit("passed"))
    semantic = F.when(F.col("l_linestatus") == "O", F.lit("human"))
    return _lines(spark, sf_dir).select(*KEY, policy.enforced(status, version, boundary, semantic).alias("status"))


@query(f"SELECT {_K}, CASE WHEN l_discount > 0.08 THEN 'failed' WHEN l_tax > 0.06 THEN 'error' WHEN l_quantity > 45 THEN 'not_run' WHEN l_linenumber <> 7 THEN 'passed' ELSE 'not_applicable' END AS summary FROM lineitem")
def verification_summary(spark, sf_dir):
    state = lambda bad, name: F.when(bad, F.lit(name)).otherwise(F.when(F.col("l_linenumber") != 7, F.lit("passed")))
    states = F.create_map(F.lit("a"), state(F.col("l_discount") > 0.08, "failed"), F.lit("b"), state(F.col("l_tax") > 0.06, "error"), F.lit("c"), state(F.col("l_quantity") > 45, "not_run"))
    return _lines(spark, sf_dir).select(*KEY, policy.summary(states, ["a", "b", "c", "d"]).alias("summary"))


@query(f"SELECT {_K}, array_to_string(list_filter([CASE WHEN l_returnflag <> 'A' THEN 'status_' || CASE l_returnflag WHEN 'N' THEN 'review' ELSE 'rejected' END END, CASE WHEN l_linenumber = 1 THEN 'policy_version:missing' END, CASE WHEN l_tax > 0.05 THEN 'failed:events_exist' END, CASE WHEN l_discount > 0.05 THEN 'missing_check:interval_semantics' END, CASE WHEN l_quantity > 40 THEN 'near_duplicate_video' END], lambda x: x IS NOT NULL), ',') AS reasons FROM lineitem")
def strict_release(spark, sf_dir):
    status = _choice(F.col("l_returnflag"), ("A", "accepted"), ("N", "review"), ("R", "rejected"))
    exist = F.when(F.col("l_tax") > 0.05, F.lit("false")).otherwise(F.lit("true"))
    checks = F.map_filter(F.create_map(F.lit("events_exist"), exist, F.lit("interval_semantics"), F.lit("true")), lambda k, _: (k != "interval_semantics") | (F.col("l_discount") <= 0.05))
    canonical = F.when(F.col("l_quantity") > 40, F.lit("v"))
    why = policy.strict_reasons("relation", status, F.when(F.col("l_linenumber") != 1, F.lit("2")), checks, F.lit("passed"), F.lit("t2v"), canonical)
    return _lines(spark, sf_dir).select(*KEY, F.array_join(why, ",").alias("reasons"))


@query(f"SELECT {_K}, CASE WHEN l_discount > 0.05 AND l_returnflag = 'A' THEN 'silver' ELSE CASE l_returnflag WHEN 'A' THEN 'gold' WHEN 'N' THEN 'silver' ELSE 'bronze' END END AS tier FROM lineitem")
def capped_tiers(spark, sf_dir):
    name = _choice(F.col("l_returnflag"), ("A", "gold"), ("N", "silver"), ("R", "bronze"))
    told = F.struct(name.alias("tier"), F.array(F.lit("x")).alias("reasons"))
    return _lines(spark, sf_dir).select(*KEY, curation.cap_tier(told, "silver", F.col("l_discount") > 0.05, "quality_flags")["tier"].alias("tier"))


@query(f"SELECT {_K}, CASE WHEN l_returnflag <> 'A' THEN 'status:' || CASE l_returnflag WHEN 'N' THEN 'review' ELSE 'rejected' END WHEN l_linestatus <> 'O' THEN 'boundary:failed' WHEN l_quantity / 2 < 2 THEN 'too_short' WHEN l_quantity / 2 > 20 THEN 'too_long' WHEN l_linenumber = 4 THEN 'no_prompt' END AS fault FROM lineitem")
def clip_faults(spark, sf_dir):
    status = _choice(F.col("l_returnflag"), ("A", "accepted"), ("N", "review"), ("R", "rejected"))
    boundary = F.when(F.col("l_linestatus") == "O", F.lit("passed")).otherwise(F.lit("failed"))
    fault = factory.clip_fault(status, F.lit("t2v"), boundary, F.lit(0.0), F.col("l_quantity") / 2, F.when(F.col("l_linenumber") != 4, F.lit("p")), longest=20.0)
    return _lines(spark, sf_dir).select(*KEY, fault.alias("fault"))


@query("WITH m AS (SELECT o_orderkey, o_totalprice / 10000 AS d, o_custkey % 40 + 5 AS fps, 640 + o_custkey % 900 AS w, 360 + o_orderkey % 500 AS h, CASE WHEN o_orderkey % 9 = 0 THEN 'test' WHEN o_orderkey % 9 = 1 THEN NULL ELSE 'train' END AS s FROM orders) SELECT o_orderkey, array_to_string(list_filter([CASE WHEN d < 3 THEN 'duration_below' END, CASE WHEN d > 12 THEN 'duration_above' END, CASE WHEN fps < 15 THEN 'fps_below' END, CASE WHEN w < 832 OR h < 480 THEN 'resolution_below' END, CASE WHEN abs(w / h - 832 / 480) / (832 / 480) > 0.2 THEN 'aspect_ratio' END, CASE WHEN s = 'test' THEN 'split:test' END], lambda x: x IS NOT NULL), ',') AS misfits FROM m")
def target_misfits(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    split = F.when(F.col("o_orderkey") % 9 == 0, F.lit("test")).when(F.col("o_orderkey") % 9 != 1, F.lit("train"))
    why = factory.misfits(F.col("o_totalprice") / 10000, (F.col("o_custkey") % 40 + 5).cast("double"), 640 + F.col("o_custkey") % 900, 360 + F.col("o_orderkey") % 500, split, 3.0, 12.0, 15.0, (832, 480), tolerance=0.2)
    return orders.select("o_orderkey", F.array_join(why, ",").alias("misfits"))


_VERDICT = """WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'passed' WHEN 'O' THEN 'not_checked' ELSE 'failed' END AS media, CASE WHEN o_custkey % 5 = 0 THEN 'needs_review' ELSE 'passed' END AS caption, o_custkey % 7 = 0 AS no_text, CASE o_custkey % 4 WHEN 0 THEN 'review_required' WHEN 1 THEN 'unknown' ELSE 'cleared' END AS rights, CASE o_orderkey % 11 WHEN 0 THEN 'exact' WHEN 1 THEN 'near' END AS dup, CASE WHEN o_orderkey % 13 = 0 THEN 'failed' ELSE 'passed' END AS visual, CASE WHEN o_orderkey % 3 = 0 THEN 'not_run' ELSE 'passed' END AS frame FROM orders),
b AS (SELECT *, list_filter([CASE WHEN media <> 'passed' THEN 'media:' || media END, CASE WHEN caption <> 'passed' THEN 'caption:' || caption END, CASE WHEN no_text THEN 'caption:missing' END, CASE WHEN rights = 'review_required' THEN 'rights:review_required' END, CASE WHEN dup = 'exact' THEN 'duplicate:exact' END, CASE WHEN dup = 'near' THEN 'duplicate:near' END, CASE WHEN visual = 'failed' THEN 'visual:failed' END], lambda x: x IS NOT NULL) AS v FROM r)
SELECT o_orderkey, array_to_string(v, ',') AS video_reasons, array_to_string(list_concat(v, CASE WHEN frame <> 'passed' THEN ['start_frame:' || frame] ELSE [] END), ',') AS image_reasons, CASE WHEN media = 'failed' OR visual = 'failed' THEN 'failed' WHEN media = 'not_checked' THEN 'not_checked' WHEN caption = 'needs_review' OR rights = 'review_required' OR coalesce(dup = 'near', false) THEN 'needs_review' ELSE 'passed' END AS status, CASE WHEN rights = 'unknown' THEN 'rights_override:unknown' END AS note FROM b"""


@query(_VERDICT)
def factory_verdict(spark, sf_dir):
    cust, order = F.col("o_custkey"), F.col("o_orderkey")
    told = factory.verdict(
        _choice(F.col("o_orderstatus"), ("F", "passed"), ("O", "not_checked"), default="failed"),
        F.when(cust % 5 == 0, F.lit("needs_review")).otherwise(F.lit("passed")),
        F.when(cust % 7 == 0, F.lit(" ")).otherwise(F.lit("a caption")),
        F.when(cust % 4 == 0, F.lit("review_required")).when(cust % 4 == 1, F.lit("unknown")).otherwise(F.lit("cleared")),
        F.when(order % 11 == 0, F.lit("exact")).when(order % 11 == 1, F.lit("near")),
        F.when(order % 13 == 0, F.lit("failed")).otherwise(F.lit("passed")),
        F.when(order % 3 == 0, F.lit("not_run")).otherwise(F.lit("passed")),
        override=("unknown",),
    )
    v = read(spark, sf_dir, "orders").select("o_orderkey", told.alias("v"))
    return v.select("o_orderkey", F.array_join("v.video_reasons", ",").alias("video_reasons"), F.array_join("v.image_reasons", ",").alias("image_reasons"), "v.status", "v.note")


@query("SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN CASE WHEN c_nationkey % 2 = 0 THEN 'cleared' ELSE 'restricted' END WHEN o_orderkey % 4 = 0 THEN 'review_required' WHEN o_orderpriority = '1-URGENT' THEN 'cleared' WHEN o_orderpriority = '5-LOW' THEN 'restricted' ELSE 'review_required' END AS rights, CASE WHEN c_custkey IS NOT NULL THEN 'evidence' WHEN o_orderkey % 4 = 0 THEN 'none' ELSE 'declared:' || lower(o_orderpriority) END AS rights_by FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 6 = 0 AND c_nationkey % 3 > 0) c ON o_custkey = c_custkey")
def factory_rights(spark, sf_dir):
    nation = F.col("c_nationkey")
    status = F.when(nation % 3 == 0, F.lit("maybe")).when(nation % 2 == 0, F.lit("cleared")).otherwise(F.lit("restricted"))
    evidence = read(spark, sf_dir, "customer").filter("c_custkey % 6 = 0").select(F.col("c_custkey").alias("o_custkey"), status.alias("status"))
    records = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("license"))
    return factory.resolved_rights(records, evidence, {"1-urgent": "cleared", "5-low": "restricted"}, "o_custkey").select("o_orderkey", "rights", "rights_by")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN 'unverified' WHEN round(abs(o_totalprice - (o_totalprice + o_custkey % 5 - 2)), 3) <= 1 THEN 'matched' ELSE 'mismatch' END AS state, CASE WHEN o_orderkey % 3 = 0 THEN 'hash' ELSE 'duration' END AS how FROM orders")
def source_matches(spark, sf_dir):
    price, cust = F.col("o_totalprice"), F.col("o_custkey")
    told = factory.same_source(F.when(cust % 10 != 0, price), price + cust % 5 - 2, F.lit("h"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("h")).otherwise(F.lit("g")))
    return read(spark, sf_dir, "orders").select("o_orderkey", told["state"].alias("state"), told["by"].alias("how"))


@query("SELECT p_partkey, array_to_string(CASE WHEN p_partkey % 10 = 0 THEN ['missing_file'] ELSE list_filter([CASE WHEN p_size < 2 THEN 'empty_file' END, CASE WHEN p_partkey % 7 = 0 THEN 'unreadable' END, CASE WHEN abs((p_size * 24 + p_partkey % 6) - p_size * 24.0) > 2 THEN 'frame_count_differs' END], lambda x: x IS NOT NULL) END, ',') AS faults FROM part")
def media_faults(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    why = factory.media_faults(k % 10 != 0, F.when(size < 2, 0).otherwise(size), k % 7 != 0, size.cast("double"), F.lit(640), F.lit(360), F.lit(24.0), size * 24 + k % 6)
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(why, ",").alias("faults"))


@query("WITH s AS (SELECT c_custkey, (('0x' || substr(sha1(c_custkey::VARCHAR), 1, 12))::BIGINT % 4)::INT AS k FROM customer) SELECT c_custkey, ['crop', 'flip', 'half_rate', 'gray'][k + 1] || ',' || ['crop', 'flip', 'half_rate', 'gray'][(k + 1) % 4 + 1] AS transforms FROM s")
def picked_transforms(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", F.array_join(factory.picked(F.col("c_custkey"), ["crop", "flip", "half_rate", "gray"], 2), ",").alias("transforms"))


@query("WITH r AS (SELECT o_orderkey, o_orderstatus, floor((row_number() OVER (PARTITION BY o_orderstatus ORDER BY sha1('1|' || o_orderkey), o_orderkey) - 1) / CASE o_orderstatus WHEN 'F' THEN 4 ELSE 2 END)::BIGINT AS batch FROM orders WHERE o_orderstatus IN ('F', 'O')), b AS (SELECT DISTINCT o_orderstatus, batch, -ln((('0x' || substr(sha1('1|' || o_orderstatus || '|' || batch), 1, 12))::BIGINT + 1) / 281474976710657.0) / CASE o_orderstatus WHEN 'F' THEN 3.0 ELSE 1.0 END AS step FROM r), a AS (SELECT o_orderstatus, batch, sum(step) OVER (PARTITION BY o_orderstatus ORDER BY batch) AS arrives FROM b), t AS (SELECT o_orderstatus, batch, row_number() OVER (ORDER BY arrives, o_orderstatus) AS turn FROM a) SELECT o_orderkey, o_orderstatus, batch, turn FROM r JOIN t USING (o_orderstatus, batch)")
def drawn_batches(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    told = factory.drawn_batches(orders, "o_orderstatus", "o_orderkey", {"F": 3.0, "O": 1.0}, {"F": 4, "O": 2})
    return told.select("o_orderkey", "o_orderstatus", "batch", F.col("turn").cast("bigint").alias("turn"))


@query("SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 'pan' WHEN 'Brand#2' THEN 'zoom' WHEN 'Brand#3' THEN 'tracking' WHEN 'Brand#4' THEN 'static' ELSE 'unknown' END AS family, CASE p_brand WHEN 'Brand#1' THEN 'left' WHEN 'Brand#2' THEN 'in' END AS direction, CASE WHEN p_size % 3 = 0 THEN 'pan_left' WHEN p_size % 3 = 1 THEN 'orbit' ELSE 'unknown' END AS joined FROM part")
def camera_taxonomy(spark, sf_dir):
    stated = _choice(F.col("p_brand"), ("Brand#1", "Pan Left"), ("Brand#2", "zoom_in"), ("Brand#3", "tracking"), ("Brand#4", " static "), default="wobbly")
    third = F.col("p_size") % 3
    joined = camera.from_parts(F.when(third == 0, F.lit("Pan")).when(third == 1, F.lit("orbit")).otherwise(F.lit("tilt")), F.when(third == 0, F.lit("left")).when(third == 1, F.lit("sideways")))
    return read(spark, sf_dir, "part").select("p_partkey", camera.family(stated).alias("family"), camera.direction(stated).alias("direction"), joined.alias("joined"))


_CAM = "SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 'pan' WHEN 'Brand#2' THEN 'zoom' WHEN 'Brand#3' THEN 'tracking' WHEN 'Brand#4' THEN 'static' ELSE 'unknown' END AS a, CASE p_size % 5 WHEN 0 THEN 'pan' WHEN 1 THEN 'dolly' WHEN 2 THEN 'static' WHEN 3 THEN 'handheld' END AS b, p_retailprice % 10 / 10 AS c FROM part"


@query(f"WITH m AS ({_CAM}) SELECT p_partkey, CASE WHEN a = 'unknown' OR b IS NULL THEN 'not_applicable' WHEN a = b AND (a = 'static' OR c >= 0.6) THEN 'passed' ELSE 'failed' END AS state, CASE WHEN a = 'unknown' OR b IS NULL THEN 'nothing_to_compare' WHEN a = b AND (a = 'static' OR c >= 0.6) THEN 'same_family' WHEN a = b THEN 'inconsistent_flow' WHEN (a = 'zoom' AND b = 'dolly') OR (a = 'tracking' AND b = 'pan') THEN 'look_alike' WHEN b = 'handheld' OR c < 0.6 THEN 'inconclusive_flow' ELSE 'other_family' END AS why FROM m")
def camera_agreement(spark, sf_dir):
    stated = _choice(F.col("p_brand"), ("Brand#1", "pan_left"), ("Brand#2", "zoom_in"), ("Brand#3", "tracking"), ("Brand#4", "static"), default="odd")
    size = F.col("p_size") % 5
    measured = F.when(size == 0, F.lit("pan_right")).when(size == 1, F.lit("dolly_in")).when(size == 2, F.lit("static")).when(size == 3, F.lit("handheld"))
    told = camera.agreement(stated, measured, F.col("p_retailprice") % 10 / 10)
    return read(spark, sf_dir, "part").select("p_partkey", told["state"].alias("state"), told["why"].alias("why"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'slow pan to the left' WHEN p_size % 4 = 1 THEN 'zoom in' WHEN p_size % 4 = 2 THEN 'static camera' END AS phrase FROM part")
def camera_words(spark, sf_dir):
    k = F.col("p_size") % 4
    move = F.when(k == 0, F.lit("pan")).when(k == 1, F.lit("zoom")).when(k == 2, F.lit("static")).otherwise(F.lit("unknown"))
    way = F.when(k == 0, F.lit("left")).when(k == 1, F.lit("in"))
    return read(spark, sf_dir, "part").select("p_partkey", captions.camera_phrase(move, way, F.when(k != 1, F.lit("slow"))).alias("phrase"))


_SAID = "CASE l_linenumber WHEN 1 THEN 'The camera pans left.' WHEN 2 THEN 'It pans left and then pans right' WHEN 3 THEN 'A static camera, zooms in' WHEN 4 THEN 'it tilts up' ELSE 'nothing moves' END"


def _said():
    return _choice(F.col("l_linenumber"), (1, "The camera pans left."), (2, "It pans left and then pans right"), (3, "A static camera, zooms in"), (4, "it tilts up"), default="nothing moves")


@query(f"SELECT {_K}, CASE l_linenumber WHEN 1 THEN 'pan_left' WHEN 2 THEN 'pan_left,pan_right' WHEN 3 THEN 'zoom_in,static' WHEN 4 THEN 'tilt_up' ELSE '' END AS moves, CASE l_linenumber WHEN 2 THEN 'pan_in_two_directions' WHEN 3 THEN 'static_and_moving' ELSE '' END AS contradictions, CASE WHEN l_returnflag = 'A' THEN CASE l_linenumber WHEN 2 THEN 'opposite_direction' WHEN 3 THEN 'said_static' ELSE '' END WHEN l_returnflag = 'N' THEN CASE WHEN l_linenumber <= 4 THEN 'said_moving' ELSE '' END ELSE '' END AS hard FROM lineitem")
def caption_conflicts(spark, sf_dir):
    label = F.when(F.col("l_returnflag") == "A", F.lit("pan_left")).when(F.col("l_returnflag") == "N", F.lit("static"))
    said, text_ = F.col("_said"), F.col("_text")
    # Each caption is looked through once; an explode keeps the planner from putting the patterns into every use.
    lines = _lines(spark, sf_dir).select(*KEY, _said().alias("_text"), label.alias("_label"))
    looked = lines.select("*", F.explode(F.array(captions.movements(text_))).alias("_said"))
    hard = captions.camera_conflicts(text_, F.col("_label"), said)["hard"]
    return looked.select(*KEY, F.array_join(said, ",").alias("moves"), F.array_join(captions.contradictions(text_, said), ",").alias("contradictions"), F.array_join(hard, ",").alias("hard"))


@query("WITH q AS (SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 'What happens next to the car?' WHEN 1 THEN 'car moves?' WHEN 2 THEN 'Is this right? Is it?' WHEN 3 THEN '' ELSE 'The car moves on and on' END AS q, CASE turn % 5 WHEN 0 THEN 'About 5 seconds' WHEN 1 THEN 'First a, then b.' WHEN 2 THEN '' WHEN 3 THEN 'Around 1:05' ELSE 'soon' END AS a FROM conversations) SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN '' WHEN 1 THEN 'no_interrogative,too_short' WHEN 2 THEN 'more_than_one_question_mark' WHEN 3 THEN 'empty' ELSE 'no_interrogative,no_question_mark' END AS form, CASE turn % 5 WHEN 0 THEN '' WHEN 1 THEN 'no_duration' WHEN 2 THEN 'empty' WHEN 3 THEN 'no_duration' ELSE 'no_duration' END AS answer FROM q")
def question_faults(spark, sf_dir):
    k = F.col("turn") % 5
    q = _choice(k, (0, "What happens next to the car?"), (1, "car moves?"), (2, "Is this right? Is it?"), (3, ""), default="The car moves on and on")
    a = _choice(k, (0, "About 5 seconds"), (1, "First a, then b."), (2, ""), (3, "Around 1:05"), default="soon")
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(questions.form_faults(q), ",").alias("form"), F.array_join(questions.answer_faults(a, F.lit("duration")), ",").alias("answer"))


@query("WITH a AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'First a dog, then a cat.' WHEN 1 THEN 'Before. It rains' WHEN 2 THEN 'Around 0:12 (starts at 12.0s).' ELSE 'About 4 seconds (from 2.0s to 6.0s).' END AS a FROM conversations) SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'First a cat, then a dog.' WHEN 1 THEN 'After. It rains' END AS swapped, CASE WHEN turn % 4 = 2 THEN 'Around 0:32 (starts at 32.0s).' END AS moved, CASE WHEN turn % 4 = 3 THEN 'About 10 seconds (from 2.0s to 12.0s).' END AS longer FROM a")
def wrong_answers(spark, sf_dir):
    a = _choice(F.col("turn") % 4, (0, "First a dog, then a cat."), (1, "Before. It rains"), (2, "Around 0:12 (starts at 12.0s)."), default="About 4 seconds (from 2.0s to 6.0s).")
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", negatives.swapped(a).alias("swapped"), negatives.other_time(a, F.lit(100.0)).alias("moved"), negatives.other_duration(a).alias("longer"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'The camera pans right over ' || p_name WHEN p_size % 3 = 1 THEN p_name || ' in bright lighting' END AS negative FROM part")
def swapped_captions(spark, sf_dir):
    k = F.col("p_size") % 3
    said = F.when(k == 0, F.concat(F.lit("The camera pans left over "), "p_name")).when(k == 1, F.concat("p_name", F.lit(" in dim lighting"))).otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", negatives.swapped_attribute(said).alias("negative"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN 'music' WHEN 'click' THEN 'animal' WHEN 'purchase' THEN 'traffic' WHEN 'signup' THEN 'other' ELSE 'speech' END AS category FROM events")
def sound_categories(spark, sf_dir):
    label = _choice(F.col("event_type"), ("view", "Piano music"), ("click", "A Dog barks"), ("purchase", "car horn"), ("signup", "beep"), default="Narration over music")
    return read(spark, sf_dir, "events").select("event_id", audio.category(label).alias("category"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity * 4 < 50 THEN 'dark' WHEN l_quantity * 4 < 95 THEN 'dim' WHEN l_quantity * 4 < 170 THEN 'normal' ELSE 'bright' END AS light, round(greatest(0, least(1, exp(-l_discount * 10) * (1 - l_tax))), 9) AS speech, CASE WHEN l_quantity < 10 THEN 'slow' WHEN l_quantity < 40 THEN 'moderate' ELSE 'fast' END AS speed, CASE WHEN l_tax < 0.08 / 3 THEN 'top' WHEN l_tax < 0.16 / 3 THEN 'middle' ELSE 'bottom' END || '_' || CASE WHEN l_discount < 0.1 / 3 THEN 'left' WHEN l_discount < 0.2 / 3 THEN 'center' ELSE 'right' END AS place FROM lineitem")
def measured_classes(spark, sf_dir):
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    return _lines(spark, sf_dir).select(*KEY, motion.lighting_level(q * 4).alias("light"), F.round(motion.speech_confidence(-d * 10, t), 9).alias("speech"), motion.speed_class(q, 10.0, 40.0).alias("speed"), motion.position(d / 0.1, t / 0.08).alias("place"))


@query("WITH t AS (SELECT event_id, event_id % 9000 AS s FROM events) SELECT event_id, printf('%.1f', round_even(s / 4, 1)) || ' seconds' AS seconds, CASE WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%d:%02d', s // 60, s % 60) END AS clock FROM t")
def written_times(spark, sf_dir):
    s = F.col("event_id") % 9000
    return read(spark, sf_dir, "events").select("event_id", text.format_seconds(s / 4).alias("seconds"), text.clock(s.cast("double")).alias("clock"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '{\"a\":' || page_id || ',\"b\":[1]}' WHEN page_id % 3 = 1 THEN '{\"a\":{\"x\":\"y\"}}' END AS answer FROM pages")
def model_answers(spark, sf_dir):
    n = F.col("page_id")
    said = F.when(n % 3 == 0, F.concat(F.lit('Sure: ```json\n{"b": [1,], "a": '), n.cast("string"), F.lit("}\n``` hope this helps"))).when(n % 3 == 1, F.lit('The answer is {"a": {"x": "y"')).otherwise(F.lit("no idea"))
    return read(spark, sf_dir, "pages").select("page_id", parsing.answer_json(said).alias("answer"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 3.5 WHEN p_size % 3 = 1 THEN -2.0 END::DOUBLE AS number, CASE WHEN p_size % 3 = 0 THEN 'wide' WHEN p_size % 3 = 1 THEN 'close_up' ELSE 'unknown' END AS word FROM part")
def loose_values(spark, sf_dir):
    k = F.col("p_size") % 3
    number = F.when(k == 0, F.lit("about 3,5mm")).when(k == 1, F.lit("-2")).otherwise(F.lit("none"))
    word = F.when(k == 0, F.lit("a wide-angle shot")).when(k == 1, F.lit("Close-Up")).otherwise(F.lit("odd"))
    return read(spark, sf_dir, "part").select("p_partkey", parsing.loose_number(number).alias("number"), parsing.one_of(word, ["wide", "close_up", "medium"]).alias("word"))


_ACTS = f"{TIMELINE}, ev AS (SELECT video_id, event_id, CASE event_type WHEN 'view' THEN 'action' WHEN 'click' THEN 'camera' WHEN 'error' THEN 'sound' WHEN 'purchase' THEN 'appearance' ELSE 'speech' END AS kind, (event_id % 3)::VARCHAR AS act, (event_id % 4)::VARCHAR AS ent, event_id % 5 AS sc, start_time AS s, end_time AS e FROM timeline)"


@query(f"WITH {_ACTS}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY s, e, event_id) AS rn FROM ev), p AS (SELECT a.video_id, a.event_id AS event_a, b.event_id AS event_b, a.kind AS k1, b.kind AS k2, a.act AS a1, b.act AS a2, a.ent AS n1, b.ent AS n2, a.sc AS c1, b.sc AS c2, a.s AS s1, a.e AS e1, b.s AS s2, b.e AS e2, round(b.s - a.e, 3) AS gap FROM r a JOIN r b ON a.video_id = b.video_id AND b.rn - a.rn BETWEEN 1 AND 6), q AS (SELECT *, e1 <= s2 + 0.25 AND NOT (abs(s1 - s2) <= 0.25 AND abs(e1 - e2) <= 0.25) AS bef, s2 >= s1 - 0.25 AND e2 <= e1 + 0.25 AND abs(s1 - s2) > 0.25 AND abs(e1 - e2) > 0.25 AS b_in_a FROM p) SELECT video_id, event_a, event_b, 'CONTINUES' AS relation FROM q WHERE bef AND k1 = k2 AND gap <= 40000 AND k1 IN ('action', 'camera', 'appearance') AND (a1 = a2 OR (k1 = 'appearance' AND n1 = n2)) AND c1 <> c2 UNION ALL SELECT video_id, event_a, event_b, 'CHANGES_TO' FROM q WHERE bef AND k1 = k2 AND ((k1 = 'action' AND gap <= 80000 AND a1 <> a2 AND n1 = n2) OR (k1 = 'camera' AND gap <= 40000 AND a1 <> a2 AND c1 = c2)) UNION ALL SELECT video_id, event_b, event_a, 'INTERRUPTS' FROM q WHERE NOT bef AND b_in_a AND k2 = 'sound' AND k1 IN ('speech', 'action', 'camera') AND s2 > s1 + 0.25 AND e2 - s2 < (e1 - s1) / 2")
def richer_relations(spark, sf_dir):
    n = F.col("event_id")
    kind = _choice(F.col("event_type"), ("view", "action"), ("click", "camera"), ("error", "sound"), ("purchase", "appearance"), default="speech")
    events = timeline(spark, sf_dir).select("video_id", "event_id", kind.alias("event_type"), (n % 3).cast("string").alias("action"), F.array((n % 4).cast("string")).alias("entities"), F.array((n % 5).cast("string")).alias("scene_ids"), "start_time", "end_time")
    relations = temporal.neighbour_relations(events.select("video_id", "event_id", "event_type", "start_time", "end_time"))
    return builders.richer_relations(relations, events, close=40000.0, change=80000.0).drop("gap_seconds")


@query(f"WITH {TIMELINE}, c AS (SELECT a.video_id, a.event_id AS event_a, b.event_id AS event_b, b.start_time - a.end_time AS gap_seconds, row_number() OVER (PARTITION BY a.event_id ORDER BY b.start_time, b.event_id) AS n FROM timeline a JOIN timeline b ON a.video_id = b.video_id AND a.event_type = b.event_type AND b.start_time >= a.end_time + 20 AND a.event_id % 3 <> b.event_id % 3) SELECT video_id, event_a, event_b, gap_seconds FROM c WHERE n <= 3")
def links_to_other_scenes(spark, sf_dir):
    return temporal.long_range_links(timeline(spark, sf_dir).withColumn("scene", F.col("event_id") % 3), "event_type", scene="scene")


@query(f"WITH {SCENES}, g AS (SELECT video_id, list(objects) AS o FROM scenes GROUP BY 1) SELECT video_id, array_to_string(list_sort(list_filter(o[1], lambda x: len(list_filter(o, lambda y: NOT list_contains(y, x))) = 0)), ',') AS shared FROM (SELECT video_id, list_transform(o, lambda x: list_distinct(x)) AS o FROM g)")
def shared_entities(spark, sf_dir):
    return builders.shared_by_all(scenes(spark, sf_dir), "video_id", "objects").withColumn("shared", F.array_join("shared", ","))


_MADE = f"""{SCENES}, w AS (SELECT *, lag(objects) OVER v AS was, lag(scene_id) OVER v AS previous, lag(l_linestatus) OVER v AS st FROM scenes WINDOW v AS (PARTITION BY video_id ORDER BY start_time, scene_id)),
appear AS (SELECT video_id, 'appearance' AS event_type, o || ' comes into view' AS event, start_time, end_time FROM (SELECT *, unnest(list_distinct(list_filter(objects, lambda x: NOT list_contains(was, x)))) AS o FROM w WHERE was IS NOT NULL)),
acts AS (SELECT video_id, 'action' AS event_type, 'ship ' || l_returnflag AS event, start_time, end_time FROM scenes),
cam AS (SELECT video_id, 'camera' AS event_type, 'the camera: pan left' AS event, start_time, end_time FROM scenes WHERE l_suppkey % 4 = 0),
chg AS (SELECT video_id, 'state_change' AS event_type, 'l linestatus changes from ' || st || ' to ' || l_linestatus AS event, start_time, start_time + 0.5 AS end_time FROM w WHERE st <> l_linestatus),
cut AS (SELECT video_id, 'transition' AS event_type, 'fade to another shot' AS event, greatest(0, start_time - 0.25) AS start_time, start_time + 0.25 AS end_time FROM w WHERE previous IS NOT NULL AND l_tax > 0.06),
al AS (SELECT DISTINCT * FROM (SELECT * FROM appear UNION ALL SELECT * FROM acts UNION ALL SELECT * FROM cam UNION ALL SELECT * FROM chg UNION ALL SELECT * FROM cut))"""


@query(f"WITH {_MADE} SELECT video_id, 'evt_' || printf('%05d', row_number() OVER (PARTITION BY video_id ORDER BY start_time, end_time, event_type, event)) AS event_id, event_type, event, start_time, end_time FROM al")
def extracted_events(spark, sf_dir):
    from ..operators import shots

    base = scenes(spark, sf_dir).withColumn("actions", F.array(F.concat(F.lit("ship "), "l_returnflag"))).withColumn("camera", F.when(F.col("l_suppkey") % 4 == 0, F.lit("pan_left")))
    cuts = shots.transitions(base, F.when(F.col("l_tax") > 0.06, F.lit("fade")))
    made = builders.all_events(builders.vision_events(base), builders.camera_events(base), builders.change_events(base, ["l_linestatus"]), builders.cut_events(cuts))
    return made.select("video_id", "event_id", "event_type", "event", "start_time", "end_time")


@query("SELECT substr(sha1('captioning|' || 'r' || o_orderkey), 1, 16) AS item_id, 'captioning' AS task, 'r' || o_orderkey AS record_id, 'clips' AS record_type, o_custkey AS video_id, 'test' AS split, o_orderpriority AS reference FROM orders WHERE o_orderkey % 10 = 0 AND o_orderstatus = 'F' AND o_custkey % 2 = 0 AND o_orderpriority NOT LIKE '%LOW'")
def benchmark_items(spark, sf_dir):
    n = F.col("o_orderkey")
    low = F.col("o_orderpriority").endswith("LOW")
    records = read(spark, sf_dir, "orders").select(F.concat(F.lit("r"), n.cast("string")).alias("record_id"), F.lit("clips").alias("record_type"), F.col("o_custkey").alias("video_id"), F.when(n % 10 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"), F.when(F.col("o_orderstatus") == "F", F.lit("accepted")).otherwise(F.lit("review")).alias("status"), F.when(F.col("o_custkey") % 2 == 0, F.lit("human")).otherwise(F.lit("model")).alias("verification"), F.when(~low, F.col("o_orderpriority")).otherwise(F.lit("unknown")).alias("reference"))
    return builders.benchmark_items(records, "captioning", ["reference"])


@query("SELECT substr(sha1('pair|' || 'r' || p_partkey), 1, 16) AS pair_id, 'r' || p_partkey AS record_id, p_brand AS video_id, 'clips/' || p_size AS clip_path, p_name AS prompt FROM part WHERE p_size % 5 <> 0 AND p_partkey % 7 <> 0")
def training_pairs(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select(F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("record_id"), F.col("p_brand").alias("video_id"), F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("clips/"), F.col("p_size").cast("string"))).alias("clip_path"), F.when(F.col("p_partkey") % 7 != 0, F.concat(F.col("p_name"), F.lit(" "))).alias("caption"))
    return builders.training_pairs(parts, F.col("caption")).drop("negatives")


@query(f"WITH {SCENES} SELECT c.video_id, c.scene_id, CASE WHEN p.scene_id IS NULL THEN NULL ELSE c.start_time + c.l_discount >= p.start_time - 0.3 AND c.end_time + c.l_discount * 10 <= p.end_time + 0.3 END AS within FROM scenes c LEFT JOIN scenes p ON c.video_id = p.video_id AND p.scene_id = c.scene_id + CASE WHEN c.l_suppkey % 9 = 0 THEN 50 ELSE 0 END")
def parent_spans(spark, sf_dir):
    base = scenes(spark, sf_dir)
    d = F.col("l_discount")
    records = base.select("video_id", "scene_id", (F.col("scene_id") + F.when(F.col("l_suppkey") % 9 == 0, 50).otherwise(0)).alias("parent_id"), (F.col("start_time") + d).alias("start_time"), (F.col("end_time") + d * 10).alias("end_time"))
    return builders.parent_spans(records, base).select("video_id", "scene_id", "within")


@query("WITH a AS (SELECT o_orderkey, o_custkey, o_orderpriority, sha1(o_orderkey::VARCHAR) AS u FROM orders), b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY u, o_orderkey) AS n FROM a), c AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY u, o_orderkey) AS m FROM b WHERE n <= 2) SELECT o_orderkey, o_custkey, o_orderpriority FROM c WHERE m <= 50")
def usage_caps(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return builders.fair_use(orders, "o_orderkey", {"o_custkey": 2, "o_orderpriority": 50}, F.sha1(F.col("o_orderkey").cast("string")))


@query("WITH t AS (SELECT conv_id, turn, trim(text, ' ') AS t FROM conversations), l AS (SELECT *, length(regexp_replace(t, '[^\\p{L}\\p{N}]', '', 'g')) AS n FROM t) SELECT conv_id, turn, n >= 2 AND n * 2 >= length(t) AND regexp_matches(t, '(?i)[aeiouy0-9]') AND len(list_filter(range(greatest(0, length(t) - 4)), lambda i: t[i + 1] = t[i + 2] AND t[i + 2] = t[i + 3] AND t[i + 3] = t[i + 4] AND t[i + 4] = t[i + 5] AND t[i + 1] <> chr(10))) = 0 AS readable FROM l")
def readable_texts(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", ocr.readable(F.col("text")).alias("readable"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'both' WHEN p_partkey % 4 = 1 THEN p_name WHEN p_partkey % 4 = 2 THEN p_type END AS caption FROM part")
def caption_choice(spark, sf_dir):
    from ..schema import first_known

    k = F.col("p_partkey") % 4
    return read(spark, sf_dir, "part").select("p_partkey", first_known(F.when(k == 0, F.lit("both")).otherwise(F.lit(" ")), F.when(k == 1, F.col("p_name")), F.when(k == 2, F.col("p_type")).otherwise(F.lit(""))).alias("caption"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'cc0' WHEN 'O' THEN 'cc-by' ELSE 'platform_standard' END AS license, o_orderstatus <> 'P' OR o_orderkey % 2 = 0 AS publishable FROM orders")
def licence_states(spark, sf_dir):
    said = _choice(F.col("o_orderstatus"), ("F", "CC0 1.0 Universal"), ("O", "Creative Commons Attribution"), default="Standard platform licence")
    status = policy.licence(said)
    block = factory.rights_block(status, said, F.when(F.col("o_orderkey") % 2 == 0, F.lit("mail")))
    return read(spark, sf_dir, "orders").select("o_orderkey", block["status"].alias("license"), block["publishable"].alias("publishable"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity >= 20) AND (l_discount <= 0.05) AND (l_tax < 0.05) AS frozen FROM lineitem")
def motionless_shots(spark, sf_dir):
    d, t = F.col("l_discount"), F.col("l_tax")
    still = captions.motionless({"change": (F.array(d, d / 2, d / 3), 0.05, True), "flow": (F.array(t, t, t), 0.0499, False)}, F.col("l_quantity"), 20.0)
    return _lines(spark, sf_dir).select(*KEY, still.alias("frozen"))


@query("SELECT doc_id, CASE WHEN n_chars < 200 THEN 'short' WHEN lang <> 'en' THEN 'language:' || lang WHEN n_chars > 5000 THEN 'long' END AS reason FROM documents")
def first_reasons(spark, sf_dir):
    n, lang = F.col("n_chars"), F.col("lang")
    return read(spark, sf_dir, "documents").select("doc_id", first_reason((n < 200, "short"), (lang != "en", F.concat(F.lit("language:"), lang)), (n > 5000, "long")).alias("reason"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'channel:building site' WHEN c_custkey % 5 = 0 THEN 'v' || (c_custkey - 1) ELSE 'v' || c_custkey END AS grp FROM customer")
def split_groups(spark, sf_dir):
    video = F.concat(F.lit("v"), F.col("c_custkey").cast("string"))
    canonical = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("v"), (F.col("c_custkey") - 1).cast("string")))
    channel = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" Building   Site "))
    return read(spark, sf_dir, "customer").select("c_custkey", curation.group_of(video, canonical, channel).alias("grp"))


@query("WITH RECURSIVE e AS (SELECT p_partkey AS x, p_partkey // 2 AS y FROM part WHERE p_partkey % 3 = 0 AND p_partkey > 0), r AS (SELECT x, y FROM e UNION ALL SELECT r.x, e.y FROM r JOIN e ON r.y = e.x AND e.x <> e.y) SELECT x AS id, min(y) AS canonical FROM r GROUP BY x")
def canonical_chains(spark, sf_dir):
    links = read(spark, sf_dir, "part").filter("p_partkey % 3 = 0 AND p_partkey > 0").select(F.col("p_partkey").alias("id"), F.floor(F.col("p_partkey") / 2).alias("canonical"))
    return dedup.resolve_chains(links)


@query("SELECT doc_id, len(w)::INT AS words, (len(w) - len(list_distinct(w)))::INT AS repeated FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents)")
def word_counts(spark, sf_dir):
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    told = spread(read(spark, sf_dir, "documents")).select("doc_id", words.alias("w"))
    return told.select("doc_id", F.size("w").alias("words"), (F.size("w") - F.size(F.array_distinct("w"))).alias("repeated"))


@query()
def text_likeness(spark, sf_dir):
    """How alike neighbouring names are, by matching blocks and by one edit (no SQL has the first)."""
    names = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    nxt = names.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other"))
    return names.join(nxt, "p_partkey").select("p_partkey", F.round(media.sequence_ratio(F.col("p_name"), F.col("other")), 6).alias("ratio"), media.one_edit(F.col("p_name"), F.col("other")).alias("one_edit"))


@query("SELECT o_orderkey, o_orderstatus, o_orderstatus = 'F' OR (o_orderstatus = 'O') OR o_orderkey % 5 = 0 AS leaves FROM orders")
def export_filter(spark, sf_dir):
    status = F.when(F.col("o_orderkey") % 5 != 0, _choice(F.col("o_orderstatus"), ("F", "accepted"), ("O", "review"), default="duplicate"))
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", governance.exported(status).alias("leaves"))


@query(f"SELECT {_K}, CASE WHEN l_linenumber = 1 THEN 'human_labelled' WHEN l_discount > 0.08 THEN 'contradicted_claim' WHEN l_linenumber = 2 THEN 'boundary' WHEN l_linenumber = 3 OR l_tax > 0.07 THEN 'camera' WHEN l_linenumber = 4 THEN 'semantic' WHEN l_linenumber = 5 THEN 'confidence' WHEN l_returnflag = 'A' THEN 'accepted' ELSE 'other' END AS category FROM lineitem")
def failure_categories(spark, sf_dir):
    n = F.col("l_linenumber")
    code = _choice(n, (1, "human:rejected"), (2, "failed_check:timestamps"), (3, "failed_check:camera_motion_agreement"), (4, "semantic_verification:not_run"), (5, "confidence:review"))
    codes = F.array_compact(F.array(code))
    states = F.when(F.col("l_discount") > 0.08, F.array(F.lit("supported"), F.lit("contradicted"))).otherwise(F.array(F.lit("supported")))
    told = governance.failure_category(codes, F.when(F.col("l_returnflag") == "A", F.lit("accepted")).otherwise(F.lit("review")), states, F.col("l_tax") > 0.07)
    return _lines(spark, sf_dir).select(*KEY, told.alias("category"))


@query(f"WITH {SCENES} SELECT video_id, scene_id, (CASE WHEN l_suppkey % 4 > 0 AND l_discount <= 0.05 AND l_suppkey % 2 = 0 THEN 1 ELSE 0 END + len(objects) + CASE WHEN l_tax > 0.02 AND l_discount <= 0.07 THEN 1 ELSE 0 END)::INT AS supported, (CASE WHEN l_suppkey % 4 > 0 AND l_discount > 0.05 THEN 1 WHEN l_suppkey % 4 = 0 AND l_discount > 0.05 THEN 1 ELSE 0 END + CASE WHEN l_tax > 0.02 AND l_discount > 0.07 THEN 1 ELSE 0 END)::INT AS contradicted, (CASE WHEN l_suppkey % 4 > 0 AND l_discount <= 0.05 AND l_suppkey % 2 > 0 THEN 1 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::INT AS not_checked, CASE WHEN l_suppkey % 4 = 0 AND l_discount <= 0.05 THEN 1 ELSE 0 END AS \"unknown\" FROM scenes")
def scene_claims(spark, sf_dir):
    k = F.col("l_suppkey")
    moves = F.when(k % 4 > 0, F.lit("pan_left")).otherwise(F.lit("unknown"))
    source = F.when(k % 2 == 0, F.lit("measurement")).otherwise(F.lit("model"))
    wrong = F.array_compact(F.array(F.when(F.col("l_discount") > 0.05, F.lit("camera")), F.when(F.col("l_discount") > 0.07, F.lit("lighting"))))
    told = governance.claims(moves, source, F.col("objects"), F.when(F.col("l_tax") > 0.02, F.lit("dim")), F.when(F.col("l_linestatus") == "O", F.lit("indoor")).otherwise(F.lit("unknown")), wrong)
    made = scenes(spark, sf_dir).select("video_id", "scene_id", told.alias("c")).select("video_id", "scene_id", governance.claim_states(F.col("c")).alias("n"))
    return made.select("video_id", "scene_id", "n.*")


@query(f"WITH q AS (SELECT {_K}, CASE WHEN l_linenumber = 1 THEN 0.9 WHEN l_returnflag = 'A' THEN l_tax * 10 END AS g, CASE WHEN l_linestatus = 'O' THEN l_tax * 10 END AS t, CASE WHEN l_quantity > 5 THEN l_discount * 10 END AS d FROM lineitem) SELECT {_K}, round(g, 6) AS grounding, round(t, 6) AS temporal_accuracy, round(list_avg(list_filter([g, t, d], lambda x: x IS NOT NULL)), 6) AS overall FROM q")
def event_quality(spark, sf_dir):
    score = F.col("l_tax") * 10
    told = governance.event_quality(F.when(F.col("l_linenumber") == 1, 0.9), score, F.when(F.col("l_returnflag") == "A", F.lit("ocr_score")).otherwise(F.lit("model")), F.when(F.col("l_linestatus") == "O", F.lit("asr")).otherwise(F.lit("scene")), F.when(F.col("l_quantity") > 5, F.col("l_discount") * 10))
    return _lines(spark, sf_dir).select(*KEY, told.alias("q")).select(*KEY, *[F.round(f"q.{c}", 6).alias(c) for c in ("grounding", "temporal_accuracy", "overall")])


@query(f"SELECT {_K}, CASE WHEN l_linenumber = 7 THEN 'not_checked' WHEN l_quantity > 30.25 OR l_quantity + l_discount > 30.25 OR l_returnflag = 'R' THEN 'outside_audio' WHEN l_quantity + l_discount > 30 THEN 'clamped' ELSE 'within_audio' END AS state, CASE WHEN l_linenumber < 7 AND l_returnflag <> 'R' AND l_quantity <= 30.25 AND l_quantity + l_discount > 30 AND l_quantity + l_discount <= 30.25 THEN 30 WHEN l_returnflag = 'R' THEN l_quantity - 1 ELSE l_quantity + l_discount END AS until FROM lineitem")
def speech_alignment(spark, sf_dir):
    q = F.col("l_quantity")
    end = F.when(F.col("l_returnflag") == "R", q - 1).otherwise(q + F.col("l_discount"))
    told = governance.aligned_speech(q, end, F.when(F.col("l_linenumber") < 7, F.lit(30.0)))
    return _lines(spark, sf_dir).select(*KEY, told["state"].alias("state"), told["end"].alias("until"))


@query(f"SELECT {_K}, coalesce(l_tax - 0.02 < 0, false) OR coalesce(CASE WHEN l_linenumber <> 3 THEN l_discount END < l_tax - 0.02, false) AS bad FROM lineitem")
def impossible_times(spark, sf_dir):
    end = F.when(F.col("l_linenumber") != 3, F.col("l_discount"))
    return _lines(spark, sf_dir).select(*KEY, governance.impossible_time(F.col("l_tax") - 0.02, end).alias("bad"))


@query("WITH s AS (SELECT DISTINCT 'p' || l_partkey AS path FROM lineitem WHERE l_partkey % 50 <> 0 UNION SELECT 'gone'), f AS (SELECT 'p' || p_partkey AS path, p_size % 10 AS length FROM part), j AS (SELECT s.path AS a, f.path AS b, f.length FROM s FULL JOIN f ON s.path = f.path) SELECT CASE WHEN a IS NULL THEN 'unreferenced' WHEN b IS NULL THEN 'missing' WHEN length = 0 THEN 'empty' ELSE 'present' END AS state, count(*) AS n FROM j GROUP BY 1")
def media_states(spark, sf_dir):
    name = lambda c: F.concat(F.lit("p"), F.col(c).cast("string")).alias("path")
    stated = _lines(spark, sf_dir).filter("l_partkey % 50 <> 0").select(name("l_partkey")).unionByName(spark.createDataFrame([("gone",)], "path string"))
    found = read(spark, sf_dir, "part").select(name("p_partkey"), (F.col("p_size") % 10).alias("length"))
    return governance.media_report(found, stated)


@query("SELECT n_nationkey, n_nationkey % 4 IN (0, 1) AS usable FROM nation")
def usable_entities(spark, sf_dir):
    k = F.col("n_nationkey") % 4
    name = F.when(k == 0, F.col("n_name")).when(k == 1, F.lit("Zürich")).when(k == 2, F.lit("1999")).otherwise(F.lit("x"))
    return read(spark, sf_dir, "nation").select("n_nationkey", governance.usable_entity(name, F.lit("GPE")).alias("usable"))
