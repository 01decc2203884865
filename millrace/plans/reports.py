"""Queries of statistics, reports, validation and release gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import agreement, release, reports, stats, temporal, validation
from ..runtime import durable, read
from .registry import query
from .views import SCENES, TIMELINE, scenes, timeline


@query(f"WITH {SCENES}, {TIMELINE} SELECT 'scenes' AS record_type, count(*) AS records, count(DISTINCT video_id) AS videos, sum(end_time - start_time) AS seconds, min(end_time - start_time) AS shortest, max(end_time - start_time) AS longest FROM scenes UNION ALL SELECT 'events', count(*), count(DISTINCT video_id), round(sum(end_time - start_time), 3), round(min(end_time - start_time), 3), round(max(end_time - start_time), 3) FROM timeline UNION ALL SELECT 'turns', count(*), count(DISTINCT conv_id), NULL, NULL, NULL FROM conversations")
def dataset_statistics(spark, sf_dir):
    long = lambda t: t.withColumn("duration", F.col("end_time") - F.col("start_time"))
    turns = read(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "video_id")
    told = reports.dataset_statistics({"scenes": long(scenes(spark, sf_dir)), "events": long(timeline(spark, sf_dir)), "turns": turns})
    return told.select("record_type", "records", "videos", *[F.round(c, 3).alias(c) for c in ("seconds", "shortest", "longest")])


_STATUS = "CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'review' ELSE CASE WHEN l_linenumber = 3 THEN 'duplicate' ELSE 'rejected' END END"


def _status():
    flag = F.col("l_returnflag")
    return F.when(flag == "A", F.lit("accepted")).when(flag == "N", F.lit("review")).otherwise(F.when(F.col("l_linenumber") == 3, F.lit("duplicate")).otherwise(F.lit("rejected")))


@query(f"WITH r AS (SELECT l_linenumber % 4 AS kind, {_STATUS} AS status, CASE WHEN l_tax > 0.05 THEN l_tax END AS grounding, CASE WHEN l_discount > 0.02 THEN l_discount END AS accuracy FROM lineitem) SELECT kind, count(*) AS records, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'duplicate') AS duplicate, round(100 * count(*) FILTER (status = 'accepted') / count(*), 2) AS accepted_percent, count(*) FILTER (grounding IS NULL) AS null_grounding, count(*) FILTER (accuracy IS NULL) AS null_accuracy FROM r GROUP BY kind")
def validation_report(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumn("status", _status()).withColumn("kind", F.col("l_linenumber") % 4)
    return reports.validation_report(lines, "kind", "status", {"grounding": F.when(F.col("l_tax") > 0.05, F.col("l_tax")), "accuracy": F.when(F.col("l_discount") > 0.02, F.col("l_discount"))})


@query("SELECT CASE WHEN l_orderkey % 20 = 0 THEN 'test' WHEN l_orderkey % 20 = 1 THEN 'validation' ELSE 'train' END AS split, count(*) AS records, count(DISTINCT l_orderkey) AS videos, count(DISTINCT l_orderkey % 400) AS groups FROM lineitem GROUP BY 1")
def videos_per_split(spark, sf_dir):
    k = F.col("l_orderkey") % 20
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("video_id"), F.when(k == 0, F.lit("test")).when(k == 1, F.lit("validation")).otherwise(F.lit("train")).alias("split"), (F.col("l_orderkey") % 400).alias("grp"))
    return reports.videos_per_split(rows, group="grp")


@query("SELECT substr(p, 1, 9) AS value, count(*) AS n FROM (SELECT unnest([o_orderpriority || ':' || o_orderstatus, o_orderstatus]) AS p FROM orders) GROUP BY 1")
def code_counts(spark, sf_dir):
    codes = F.array(F.concat_ws(":", "o_orderpriority", "o_orderstatus"), F.col("o_orderstatus"))
    return stats.code_counts(read(spark, sf_dir, "orders").withColumn("codes", codes), "codes", 9)


@query("SELECT * FROM (SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ORDER BY n DESC, value LIMIT 3")
def top_priorities(spark, sf_dir):
    return stats.top(stats.count_by(read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'"), F.col("o_orderpriority")), 3)


@query("WITH m AS (SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS a, max_by(o_orderpriority, o_orderkey) AS b FROM orders GROUP BY 1), e AS (SELECT 'status' AS stage, a AS state FROM m UNION ALL SELECT 'priority', b FROM m) SELECT stage, state, count(*) AS videos FROM e GROUP BY ALL")
def stage_coverage(spark, sf_dir):
    blocks = read(spark, sf_dir, "orders").withColumn("coverage", F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority")))
    return reports.last_blocks(blocks, "o_custkey", "o_orderkey", "coverage")


@query("WITH c AS (SELECT unnest([{'kind': l_returnflag, 'status': CASE WHEN l_discount > 0.05 THEN 'contradicted' ELSE 'supported' END}, {'kind': 'line', 'status': l_linestatus}]) AS c FROM lineitem) SELECT c.kind AS kind, c.status AS status, count(*) AS n FROM c GROUP BY ALL")
def claim_counts(spark, sf_dir):
    claim = lambda kind, status: F.struct(kind.alias("kind"), status.alias("status"))
    first = claim(F.col("l_returnflag"), F.when(F.col("l_discount") > 0.05, F.lit("contradicted")).otherwise(F.lit("supported")))
    return reports.claim_counts(read(spark, sf_dir, "lineitem").withColumn("claims", F.array(first, claim(F.lit("line"), F.col("l_linestatus")))), "claims")


@query(f"WITH r AS (SELECT l_linenumber AS kind, {_STATUS} AS status FROM lineitem) SELECT kind, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'duplicate') AS duplicate FROM r GROUP BY kind")
def status_pivot(spark, sf_dir):
    return stats.status_pivot(read(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("kind"), _status().alias("status")), "kind", "status")


_CODES = "list_filter([CASE WHEN l_discount > 0.05 THEN 'discount' END, CASE WHEN l_tax > 0.04 THEN 'tax' END, CASE WHEN l_quantity > 40 THEN 'quantity' END], lambda x: x IS NOT NULL)"


def _coded(spark, sf_dir):
    codes = F.array_compact(F.array(F.when(F.col("l_discount") > 0.05, F.lit("discount")), F.when(F.col("l_tax") > 0.04, F.lit("tax")), F.when(F.col("l_quantity") > 40, F.lit("quantity"))))
    return read(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("kind"), _status().alias("status"), codes.alias("codes"))


@query(f"WITH r AS (SELECT l_linenumber AS kind, {_STATUS} AS status, unnest({_CODES}) AS code FROM lineitem), c AS (SELECT kind, code, count(*) AS n FROM r WHERE status <> 'accepted' GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, code) AS k FROM c) SELECT kind, code, n FROM o WHERE k <= 2")
def rejection_reasons(spark, sf_dir):
    return reports.rejection_reasons(_coded(spark, sf_dir), "kind", "status", "codes", 2)


@query(f"WITH r AS (SELECT {_STATUS} AS status, {_CODES} AS codes FROM lineitem), e AS (SELECT status, unnest(CASE WHEN len(codes) = 0 THEN ['selected'] ELSE codes END) AS reason FROM r) SELECT status, reason, count(*) AS n FROM e GROUP BY ALL")
def task_exclusions(spark, sf_dir):
    return reports.exclusions(_coded(spark, sf_dir), "codes", "status")


@query("WITH a AS (SELECT l_returnflag AS record_type, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT l_returnflag AS record_type, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' OR l_orderkey % 100 <> 3 GROUP BY 1), c AS (SELECT l_returnflag AS record_type, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1) SELECT record_type, coalesce(a.n, 0) AS n_jsonl, coalesce(b.n, 0) AS n_parquet, coalesce(c.n, 0) AS n_manifest FROM a FULL JOIN b USING (record_type) FULL JOIN c USING (record_type) WHERE NOT (coalesce(a.n, 0) = coalesce(b.n, 0) AND coalesce(b.n, 0) = coalesce(c.n, 0))")
def inconsistent_counts(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    count = lambda t: t.groupBy(F.col("l_returnflag").alias("record_type")).agg(F.count(F.lit(1)).alias("n"))
    return reports.inconsistent_counts({"jsonl": count(lines), "parquet": count(lines.filter("l_returnflag <> 'N' OR l_orderkey % 100 <> 3")), "manifest": count(lines.filter("l_returnflag <> 'R'"))})


@query(f"WITH r AS (SELECT CASE WHEN l_linenumber < 4 THEN 'scenes' ELSE 'clips' END AS t, {_STATUS} AS status, CASE WHEN l_tax > 0.02 THEN l_linestatus END AS tier FROM lineitem), d AS (SELECT unnest([t, 'all']) AS record_type, status, tier FROM r), e AS (SELECT record_type, 'status' AS dimension, status AS value FROM d UNION ALL SELECT record_type, 'tier', coalesce(tier, 'unknown') FROM d), c AS (SELECT record_type, dimension, value, count(*) AS n FROM e GROUP BY ALL) SELECT *, round(n / sum(n) OVER (PARTITION BY record_type, dimension), 6) AS share FROM c")
def release_metrics(spark, sf_dir):
    kind = F.when(F.col("l_linenumber") < 4, F.lit("scenes")).otherwise(F.lit("clips"))
    return reports.release_metrics(read(spark, sf_dir, "lineitem").withColumn("record_type", kind), {"status": _status(), "tier": F.when(F.col("l_tax") > 0.02, F.col("l_linestatus"))})


@query(f"WITH {TIMELINE}, r AS (SELECT video_id, greatest(0, count(*) - 1) AS k FROM timeline GROUP BY 1), l AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY start_time, event_id) AS rn, count(*) OVER (PARTITION BY video_id) AS n FROM timeline), s AS (SELECT video_id, sum(least(2, n - rn)) AS relations FROM l WHERE video_id % 3 > 0 GROUP BY 1) SELECT video_id, count(*) AS events, count(DISTINCT event_type) AS kinds, round(max(end_time) - min(start_time), 3) AS covered, coalesce(any_value(relations), 0)::BIGINT AS relations, round(count(*) / (max(end_time) - min(start_time)), 9) AS density FROM timeline LEFT JOIN s USING (video_id) GROUP BY video_id")
def timeline_statistics(spark, sf_dir):
    events = timeline(spark, sf_dir)
    numbered = events.select("video_id", "event_id", F.expr("row_number() OVER (PARTITION BY video_id ORDER BY start_time, event_id)").alias("rn"))
    links = numbered.alias("a").join(numbered.alias("b"), F.expr("a.video_id = b.video_id AND b.rn IN (a.rn + 1, a.rn + 2)")).filter("a.video_id % 3 > 0").select("a.video_id")
    return reports.timeline_statistics(events, links).withColumn("covered", F.round("covered", 3)).withColumn("density", F.round("density", 9))


@query("WITH p AS (SELECT l_returnflag AS t, l_linenumber % 2 AS b, CASE WHEN l_quantity > 25 THEN 'y' ELSE 'n' END AS x, CASE WHEN l_quantity > 22 + l_linenumber THEN 'y' ELSE 'n' END AS y FROM lineitem), c AS (SELECT t, count(*) AS n, count(*) FILTER (x = y) AS same, count(*) FILTER (x = 'y') * count(*) FILTER (y = 'y') + count(*) FILTER (x = 'n') * count(*) FILTER (y = 'n') AS xy FROM p GROUP BY 1) SELECT t, n, round(same / n, 9) AS agreement, round((same / n - xy / (n * n)) / (1 - xy / (n * n)), 9) AS kappa FROM c")
def kappa_by_type(spark, sf_dir):
    over = lambda limit: F.when(F.col("l_quantity") > limit, F.lit("y")).otherwise(F.lit("n"))
    pairs = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("t"), over(25).alias("x"), over(22 + F.col("l_linenumber")).alias("y"))
    return agreement.cohens_kappa(pairs, "x", "y", ["t"]).withColumn("agreement", F.round("agreement", 9)).withColumn("kappa", F.round("kappa", 9))


@query("WITH r AS (SELECT l_returnflag AS t, greatest(abs(l_discount - l_tax), abs(l_discount * 2 - l_tax * 3)) AS e FROM lineitem) SELECT t, count(*) AS n, round(avg(e), 9) AS mean_error, round(avg(CASE WHEN e <= 0.05 THEN 1 ELSE 0 END), 9) AS within FROM r GROUP BY 1")
def boundary_audit(spark, sf_dir):
    d, t = F.col("l_discount"), F.col("l_tax")
    reviews = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("t"), d.alias("start_time"), t.alias("true_start"), (d * 2).alias("end_time"), (t * 3).alias("true_end"))
    return reports.boundary_audit(reviews, "t", 0.05).withColumn("mean_error", F.round("mean_error", 9)).withColumn("within", F.round("within", 9))


@query("WITH r AS (SELECT l_orderkey AS record_id, CASE WHEN l_linenumber % 2 = 0 THEN 'a' ELSE 'b' END AS reviewer, l_returnflag AS label FROM lineitem WHERE l_linenumber <= 2), d AS (SELECT o_orderkey AS record_id, o_orderstatus AS label FROM orders WHERE o_orderkey % 10 = 0), g AS (SELECT record_id, count(DISTINCT label) AS kinds, min(label) AS l, count(DISTINCT reviewer) AS who, min(reviewer) AS w FROM r GROUP BY 1) SELECT record_id, coalesce(d.label, CASE WHEN kinds = 1 THEN l END) AS label, CASE WHEN d.label IS NOT NULL THEN 'adjudicated' WHEN kinds = 1 THEN CASE WHEN who = 1 THEN w ELSE 'consensus' END END AS reviewer, coalesce(d.label, CASE WHEN kinds = 1 THEN l END) IS NULL AS needs_adjudication FROM g FULL JOIN d USING (record_id)")
def adjudicated_labels(spark, sf_dir):
    reviews = read(spark, sf_dir, "lineitem").filter("l_linenumber <= 2").select(F.col("l_orderkey").alias("record_id"), F.when(F.col("l_linenumber") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("reviewer"), F.col("l_returnflag").alias("label"))
    decisions = read(spark, sf_dir, "orders").filter("o_orderkey % 10 = 0").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("label"))
    return agreement.adjudicate(reviews, decisions)


@query(f"WITH r AS (SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS c, l_tax, {_STATUS} AS status FROM lineitem) SELECT l_orderkey, CASE WHEN count(*) = count(c) THEN min(c) END AS confidence, CASE max(CASE status WHEN 'accepted' THEN 0 WHEN 'review' THEN 1 WHEN 'rejected' THEN 2 ELSE 3 END) WHEN 0 THEN 'accepted' WHEN 1 THEN 'review' WHEN 2 THEN 'rejected' ELSE 'duplicate' END AS status, min(l_tax) AS quality FROM r GROUP BY 1")
def derived_confidence(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_discount")).alias("c"), "l_tax", _status().alias("status"))
    return rows.groupBy("l_orderkey").agg(stats.strict_min(F.col("c")).alias("confidence"), stats.worst(F.col("status")).alias("status"), F.min("l_tax").alias("quality"))


@query("SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS parts, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_partkey, l_suppkey) AS flags FROM lineitem GROUP BY 1")
def ordered_lists(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")))
    told = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(rows.alias("r"))
    return told.select("l_orderkey", F.array_join(F.transform("r", lambda x: x["l_partkey"].cast("string")), ",").alias("parts"), F.array_join(F.transform("r", lambda x: x["l_returnflag"]), "").alias("flags"))


def _judged_sql(kind: str, ident: str, conf: str, caps: list[tuple[str, str]], hard: list[tuple[str, str]], source: str) -> str:
    """The policy of one kind: suggested by confidence, caps in order, hard rules first."""
    pick = lambda rules: "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{code}' END" for c, code in rules) + "]::VARCHAR[], lambda x: x IS NOT NULL)"
    return f"""(SELECT '{kind}' AS kind, record_id, CASE WHEN len(h) > 0 THEN 'rejected' WHEN s = 'accepted' AND len(c) > 0 THEN 'review' ELSE s END AS status, CASE WHEN len(h) > 0 THEN array_to_string(list_transform(h, lambda x: 'hard:' || x), ',') ELSE array_to_string(list_concat(CASE WHEN s <> 'accepted' THEN ['confidence:' || s] ELSE []::VARCHAR[] END, c), ',') END AS reasons
FROM (SELECT {ident} AS record_id, CASE WHEN {conf} IS NULL THEN 'review' WHEN {conf} >= 0.75 THEN 'accepted' WHEN {conf} >= 0.5 THEN 'review' ELSE 'rejected' END AS s, {pick(caps)} AS c, {pick(hard)} AS h FROM {source}))"""


_IN = "(start_time >= -0.05 AND end_time >= start_time AND end_time <= d + 0.05)"
_VALID = f"""WITH {SCENES}, dur AS (SELECT video_id, max(end_time) - CASE WHEN video_id % 23 = 0 THEN 1 ELSE 0 END AS d FROM scenes GROUP BY 1),
sc AS (SELECT s.*, d, CASE WHEN l_suppkey % 11 <> 0 THEN l_returnflag ELSE ' ' END AS summary, l_discount > 0.08 AS flagged, 1 - l_discount * 4 AS conf FROM scenes s JOIN dur USING (video_id)),
ev AS (SELECT video_id, 'e' || scene_id AS event_id, l_suppkey % 13 = 0 AS lost, l_suppkey % 29 = 0 AS bare, start_time, end_time, d, CASE WHEN l_linenumber = 6 THEN NULL ELSE 1 - l_tax * 5 END AS conf FROM sc),
rl AS (SELECT a.video_id, a.scene_id, 'e' || a.scene_id AS event_a, CASE WHEN a.video_id % 19 = 0 THEN 'x' ELSE 'e' END || (a.scene_id + 1) AS event_b, CASE WHEN (a.video_id + a.scene_id) % 17 = 0 THEN 'DURING' ELSE 'BEFORE' END AS relation, a.start_time AS s1, a.end_time AS e1, b.start_time AS s2, b.end_time AS e2 FROM scenes a JOIN scenes b ON a.video_id = b.video_id AND b.scene_id = a.scene_id + 1),
rj AS (SELECT *, video_id % 19 = 0 AS gone, CASE relation WHEN 'BEFORE' THEN e1 <= s2 + 0.3 AND s1 <= s2 + 0.3 ELSE s1 >= s2 - 0.3 AND e1 <= e2 + 0.3 AND e2 - s2 >= e1 - s1 - 0.3 END AS holds FROM rl),
qs AS (SELECT video_id, scene_id, l_suppkey % 31 = 0 AS lost, start_time, end_time, d, CASE WHEN l_suppkey % 37 = 0 THEN '' ELSE 'a' END AS answer FROM sc),
shots AS {_judged_sql("scene", "video_id || '/' || scene_id", "conf", [(f"NOT {_IN}", "failed_check:timestamps"), ("trim(summary) = ''", "failed_check:summary_present"), ("flagged", "failed_check:visual_quality")], [("end_time <= start_time", "no_length")], "sc")},
acts AS {_judged_sql("event", "video_id || '/' || event_id", "conf", [(f"NOT {_IN}", "failed_check:timestamps"), ("lost", "failed_check:scenes_exist")], [("bare", "no_evidence")], "(SELECT * REPLACE (lost AND NOT bare AS lost) FROM ev)")},
links AS {_judged_sql("relation", "video_id || '/' || event_a || '/' || relation || '/' || event_b", "0.8", [("gone", "failed_check:events_exist"), ("gone", "missing_check:interval_semantics"), ("NOT gone AND NOT holds", "failed_check:interval_semantics")], [("false", "")], "rj")},
asks AS {_judged_sql("qa", "video_id || '/q' || scene_id", "0.9", [(f"NOT {_IN}", "failed_check:timestamps_in_range"), ("lost", "failed_check:events_exist"), ("answer = ''", "failed_check:answer_grounded")], [("answer = ''", "no_answer")], "qs")},
sq AS (SELECT s.video_id, count(*) AS k, bool_and(a.status = 'accepted') AS fine FROM sc s JOIN shots a ON a.record_id = s.video_id || '/' || s.scene_id GROUP BY 1),
rows AS {_judged_sql("sequence", "video_id || '/seq1'", "0.9", [("video_id % 41 = 0", "failed_check:scene_membership"), ("NOT fine OR video_id % 41 = 0", "failed_check:all_shots_accepted")], [("k < 2 AND video_id % 41 > 0", "too_few_shots")], "sq")}
SELECT * FROM shots UNION ALL SELECT * FROM acts UNION ALL SELECT * FROM links UNION ALL SELECT * FROM asks UNION ALL SELECT * FROM rows"""


@query(_VALID)
def validation_driver(spark, sf_dir):
    """Records of five kinds, each judged by its policy against the others, with planted faults."""
    base = durable(scenes(spark, sf_dir).withColumn("scene_id", F.col("scene_id").cast("string")))  # read by all five kinds
    text = lambda c: F.col(c).cast("string")
    mod = lambda c, k: F.col(c) % k == 0
    shots = base.select("video_id", "scene_id", "start_time", "end_time", "l_suppkey", "l_linenumber", "l_tax", F.when(mod("l_suppkey", 11), F.lit(" ")).otherwise(F.col("l_returnflag")).alias("summary"), F.when(F.col("l_discount") > 0.08, F.array(F.lit("dark"))).otherwise(F.array().cast("array<string>")).alias("flags"), (1 - F.col("l_discount") * 4).alias("confidence"))
    lists = F.when(mod("l_suppkey", 29), F.array().cast("array<string>")).when(mod("l_suppkey", 13), F.array("scene_id", F.lit("99"))).otherwise(F.array("scene_id"))
    events = base.select("video_id", F.concat(F.lit("e"), "scene_id").alias("event_id"), lists.alias("scene_ids"), "start_time", "end_time", F.lit("d").alias("description"), F.when(F.col("l_linenumber") != 6, 1 - F.col("l_tax") * 5).alias("confidence"))
    n = F.col("scene_id").cast("bigint")
    nxt = F.concat(F.when(mod("video_id", 19), F.lit("x")).otherwise(F.lit("e")), (n + 1).cast("string"))
    last = base.groupBy("video_id").agg(F.max(n).alias("_last"))
    links = base.join(last, "video_id").filter(n < F.col("_last")).select("video_id", F.concat(F.lit("e"), "scene_id").alias("event_a"), nxt.alias("event_b"), F.when((F.col("video_id") + n) % 17 == 0, F.lit("DURING")).otherwise(F.lit("BEFORE")).alias("relation"), F.lit(0.8).alias("confidence"))
    ids = F.when(mod("l_suppkey", 31), F.array(F.lit("zz"))).otherwise(F.array(F.concat(F.lit("e"), "scene_id")))
    asked = base.select("video_id", F.concat(F.lit("q"), "scene_id").alias("question_id"), ids.alias("event_ids"), "start_time", "end_time", F.when(mod("l_suppkey", 37), F.lit("")).otherwise(F.lit("a")).alias("answer"), F.lit(0.9).alias("confidence"))
    runs = base.groupBy("video_id").agg(F.array_sort(F.collect_list("scene_id")).alias("scene_ids")).select("video_id", F.lit("seq1").alias("sequence_id"), F.when(mod("video_id", 41), F.concat("scene_ids", F.array(F.lit("98"), F.lit("99")))).otherwise(F.col("scene_ids")).alias("scene_ids"), F.lit(0.9).alias("confidence"))
    durations = base.groupBy("video_id").agg((F.max("end_time") - F.when(mod("video_id", 23), 1).otherwise(0)).alias("duration"))
    told = validation.validate(shots, events, links, asked, runs, durations)
    return told.select("kind", text("record_id").alias("record_id"), "status", F.array_join("reasons", ",").alias("reasons"))


_RECORDS = f"""{SCENES}, rec AS (SELECT video_id || '_' || scene_id AS record_id, CASE WHEN video_id % 500 <> 7 THEN 'scenes' END AS record_type, video_id, video_id % 200 AS group_id, 'src' || (video_id % 40) AS source,
CASE WHEN video_id % 200 < 5 OR (video_id % 200 = 50 AND scene_id = 2) THEN 'test' ELSE 'train' END AS split, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'review' ELSE 'rejected' END AS status, CASE WHEN l_discount <= 0.09 THEN 'silver' END AS tier, CASE WHEN l_tax > 0.07 THEN 'not_run' ELSE 'passed' END AS verification,
start_time, end_time, CASE WHEN video_id % 100 = 3 THEN end_time - 1 ELSE end_time END AS duration, CASE WHEN scene_id > 1 THEN video_id || '_' || (scene_id - CASE WHEN video_id % 300 = 9 THEN 100 ELSE 1 END) END AS parent_id, CASE WHEN video_id % 50 = 1 THEN '/home/u/' || scene_id ELSE 'clips/' || (l_suppkey % 30) END AS clip_path FROM scenes)"""
_GATES = f"""WITH {_RECORDS}, w AS (SELECT record_id FROM rec WHERE video_id % 400 <> 11 UNION ALL SELECT 'extra'),
v AS (SELECT 'schema' AS gate, count(*) AS n FROM rec WHERE record_type IS NULL UNION ALL SELECT 'references', count(*) FROM rec WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT record_id FROM rec)
UNION ALL SELECT 'ids', (SELECT count(*) FROM rec WHERE record_id NOT IN (SELECT record_id FROM w)) + 1 UNION ALL SELECT 'counts', 1 UNION ALL SELECT 'checksums', (SELECT count(*) FROM part WHERE p_partkey % 100 IN (5, 6))
UNION ALL SELECT 'split_leakage', count(*) FROM (SELECT group_id FROM rec GROUP BY 1 HAVING count(DISTINCT split) > 1) UNION ALL SELECT 'required_splits', 1 UNION ALL SELECT 'source_pool', 0
UNION ALL SELECT 'media', count(*) FROM rec WHERE clip_path NOT IN (SELECT 'clips/' || i FROM range(25) t(i)) UNION ALL SELECT 'timestamps', count(*) FROM rec WHERE end_time > duration + 0.05 UNION ALL SELECT 'rights', count(*) FROM rec WHERE status = 'accepted' AND source IN ('src3', 'src4')
UNION ALL SELECT 'strict', count(*) FROM rec WHERE status = 'accepted' AND tier IS NULL UNION ALL SELECT 'portable_paths', count(*) FROM rec WHERE clip_path LIKE '/home/%' UNION ALL SELECT 'accepted_verified', count(*) FROM rec WHERE status = 'accepted' AND verification <> 'passed' UNION ALL SELECT 'reproducibility', 1)
SELECT gate, CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END AS state, n::BIGINT AS n FROM v"""


@query(_GATES)
def release_gates(spark, sf_dir):
    """All fifteen gates over records with a planted defect for nearly each."""
    video, n = F.col("video_id"), F.col("scene_id")
    flag = F.col("l_returnflag")
    ident = lambda k: F.concat_ws("_", video.cast("string"), k.cast("string"))
    records = scenes(spark, sf_dir).select(
        ident(n).alias("record_id"),
        F.when(video % 500 != 7, F.lit("scenes")).alias("record_type"),
        "video_id",
        (video % 200).alias("group_id"),
        F.concat(F.lit("src"), (video % 40).cast("string")).alias("source"),
        F.when((video % 200 < 5) | ((video % 200 == 50) & (n == 2)), F.lit("test")).otherwise(F.lit("train")).alias("split"),
        F.when(flag == "A", F.lit("accepted")).when(flag == "N", F.lit("review")).otherwise(F.lit("rejected")).alias("status"),
        F.when(F.col("l_discount") <= 0.09, F.lit("silver")).alias("tier"),
        F.when(F.col("l_tax") > 0.07, F.lit("not_run")).otherwise(F.lit("passed")).alias("verification"),
        "start_time",
        "end_time",
        F.when(video % 100 == 3, F.col("end_time") - 1).otherwise(F.col("end_time")).alias("duration"),
        F.when(n > 1, ident(n - F.when(video % 300 == 9, 100).otherwise(1))).alias("parent_id"),
        F.when(video % 50 == 1, F.concat(F.lit("/home/u/"), n.cast("string"))).otherwise(F.concat(F.lit("clips/"), (F.col("l_suppkey") % 30).cast("string"))).alias("clip_path"),
    )
    records = durable(records)  # read by nearly every gate
    made = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    written = records.filter("video_id % 400 <> 11").select("record_id").unionByName(made([("extra",)], "record_id string"))
    by_type = records.groupBy(F.lit("scenes").alias("record_type")).agg(F.count(F.lit(1)).alias("n"))
    parts = read(spark, sf_dir, "part").select(F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("path"), F.sha2("p_name", 256).alias("sha256"), "p_partkey")
    stated = parts.filter("p_partkey % 100 <> 6").withColumn("sha256", F.when(F.col("p_partkey") % 100 == 5, F.lit("other")).otherwise(F.col("sha256")))
    media = spark.range(25).select(F.concat(F.lit("clips/"), F.col("id").cast("string")).alias("path"))
    rights = spark.range(40).select(F.concat(F.lit("src"), F.col("id").cast("string")).alias("source"), ((F.col("id") != 3) & (F.col("id") != 4)).alias("allowed"))
    manifest = made([("code", "abc"), ("config", "1"), ("seed", "")], "key string, value string")
    return validation.check_release(records, written, {"parquet": by_type, "jsonl": by_type.withColumn("n", F.col("n") + 1)}, parts.select("path", "sha256"), stated.select("path", "sha256"), media, rights, manifest, ("train", "test", "validation"))


@query("WITH o AS (SELECT o_orderkey AS record_id, o_orderstatus AS a, CASE WHEN o_orderkey % 7 = 0 THEN 'F' ELSE o_orderstatus END AS b FROM orders) SELECT record_id, a AS from_status, b AS to_status FROM o WHERE a <> b")
def status_lineage(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("status"))
    return release.lineage(orders, orders.withColumn("status", F.when(F.col("record_id") % 7 == 0, F.lit("F")).otherwise(F.col("status"))))


@query("WITH o AS (SELECT o_custkey, o_orderstatus AS s, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS p, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders), c AS (SELECT c_custkey, c_mktsegment AS s, c_acctbal AS p FROM customer) SELECT coalesce(c_custkey, o_custkey) AS k, coalesce(o.s, c.s) AS s, coalesce(o.p, c.p) AS p FROM c FULL JOIN (SELECT * FROM o WHERE n = 1) o ON c_custkey = o_custkey")
def keyed_upsert(spark, sf_dir):
    old = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("s"), F.col("c_acctbal").alias("p"))
    new = release.latest(read(spark, sf_dir, "orders"), "o_custkey", "o_orderkey").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("p"))
    return release.upsert(old, new, "k")


@query("SELECT DISTINCT user_id AS video_id, 1::BIGINT AS n FROM events WHERE user_id % 5 = 0")
def planted_cycles(spark, sf_dir):
    """Events in order have no cycle of BEFORE; three links that go round make one."""
    first = timeline(spark, sf_dir).groupBy("video_id").agg(F.min("event_id").alias("e"))
    links = first.select("video_id", F.explode(F.array(*[F.struct((F.col("e") + a).alias("event_a"), (F.col("e") + b).alias("event_b")) for a, b in ((0, 1), (1, 2), (2, 3))])).alias("x")).select("video_id", "x.*")
    back = first.filter("video_id % 5 = 0").select("video_id", (F.col("e") + 2).alias("event_a"), F.col("e").alias("event_b"))
    return temporal.before_cycles(links.unionByName(back).withColumn("relation", F.lit("BEFORE"))).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))
