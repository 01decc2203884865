"""Queries over the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import captions, interval, text
from ..functions.reasons import reasons
from ..operators import agreement, curation, dedup, motion, ocr, policy, questions, release, stats, temporal
from .. import schema
from ..runtime import durable, read, spread
from ..streaming import incremental
from .registry import ORACLES, QUERIES, query  # noqa: F401
from .views import SCENES, TIMELINE, norm_sql, scenes, timeline

def _hash_sql(salt: str, key: str) -> str:
    return f"('0x' || substr(sha1('{salt}|' || {key}), 1, 12))::BIGINT / 281474976710656.0"


def _split_sql(source: str, key: str) -> str:
    """The assignment with minimums of one, as CTEs that end in ``assigned``."""
    return f"""hashed AS (SELECT DISTINCT {key}, {_hash_sql("v1", f"{key}::VARCHAR")} AS u FROM {source} WHERE {key} IS NOT NULL),
fallen AS (SELECT *, CASE WHEN u < 0.05 THEN 'test' WHEN u < 0.1 THEN 'validation' ELSE 'train' END AS s FROM hashed),
have AS (SELECT count(*) FILTER (s = 'train') AS r, greatest(0, 1 - count(*) FILTER (s = 'test')) AS t, greatest(0, 1 - count(*) FILTER (s = 'validation')) AS v FROM fallen),
quota AS (SELECT least(r - 1, t) AS t, least(r - 1 - least(r - 1, t), v) AS v FROM have),
placed AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY u, {key}) AS rn FROM fallen),
assigned AS (SELECT {key}, CASE WHEN s = 'train' AND rn <= quota.t THEN 'test' WHEN s = 'train' AND rn <= quota.t + quota.v THEN 'validation' ELSE s END AS split FROM placed, quota)"""


@query(f"WITH {_split_sql('documents', 'source')} SELECT source, split FROM assigned")
def split_assignment(spark, sf_dir):
    return curation.assign_splits(read(spark, sf_dir, "documents"), "source")


@query(f"WITH {_split_sql('customer', 'c_custkey')}, told AS (SELECT c_nationkey, split FROM customer JOIN assigned USING (c_custkey)) SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits FROM told GROUP BY ALL HAVING count(DISTINCT split) > 1")
def split_leaks(spark, sf_dir):
    customers = read(spark, sf_dir, "customer")
    leaks = curation.split_leaks(customers.join(curation.assign_splits(customers, "c_custkey"), "c_custkey"), "c_nationkey")
    return leaks.select("c_nationkey", F.array_join("splits", ",").alias("splits"))


_TIER_INPUT = "tiered AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'review' ELSE 'rejected' END AS status, 1 - l_discount * 5 AS overall, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_tax * 10 END AS confidence, CASE l_linestatus WHEN 'O' THEN 'human' ELSE 'heuristic' END AS source, l_linenumber % 2 = 0 AS grounded FROM lineitem)"
_TIER_SQL = f"""{_TIER_INPUT},
blocked AS (SELECT *, list_filter([CASE WHEN NOT grounded THEN 'no_grounding_component' END, CASE WHEN confidence IS NULL THEN 'confidence_unavailable' WHEN confidence < 0.7 THEN 'confidence_below_0.7' WHEN source <> 'human' THEN 'confidence_source_' || source END], lambda x: x IS NOT NULL) AS block FROM tiered),
tiers AS (SELECT l_orderkey, l_linenumber, l_partkey, status, CASE WHEN status = 'rejected' THEN NULL WHEN status = 'accepted' AND overall >= 0.8 AND len(block) = 0 THEN 'gold' WHEN status = 'accepted' AND overall >= 0.6 THEN 'silver' ELSE 'bronze' END AS tier,
  array_to_string(CASE WHEN status = 'rejected' THEN ['status_rejected'] WHEN status = 'accepted' AND overall >= 0.8 THEN block WHEN status = 'accepted' AND overall >= 0.6 THEN ['overall_below_0.8'] WHEN status <> 'accepted' THEN ['status_' || status] ELSE ['overall_below_0.6'] END, ',') AS reasons FROM blocked)"""


def _tiered(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "A", F.lit("accepted")).when(F.col("l_returnflag") == "N", F.lit("review")).otherwise(F.lit("rejected"))
    told = curation.tier(status, 1 - F.col("l_discount") * 5, F.when(F.col("l_linenumber") != 7, F.col("l_tax") * 10), F.when(F.col("l_linestatus") == "O", F.lit("human")).otherwise(F.lit("heuristic")), F.when(F.col("l_linenumber") % 2 == 0, F.array(F.lit("grounding"))).otherwise(F.array().cast("array<string>")))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", status.alias("status"), told.alias("t")).select("l_orderkey", "l_linenumber", "l_partkey", "status", "t.tier", F.array_join("t.reasons", ",").alias("reasons"))


@query(f"WITH {_TIER_SQL} SELECT l_orderkey, l_linenumber, l_partkey, tier, reasons FROM tiers")
def tier_assignment(spark, sf_dir):
    return _tiered(spark, sf_dir).drop("status")


@query(f"WITH {_TIER_SQL} SELECT coalesce(tier, 'unknown') AS value, count(*) AS n FROM tiers GROUP BY ALL")
def tier_counts(spark, sf_dir):
    return stats.count_by(_tiered(spark, sf_dir), F.col("tier"))


@query(f"WITH k AS (SELECT doc_id, sha256({norm_sql('text')}) AS h FROM documents), g AS (SELECT h, min(doc_id) AS canonical FROM k GROUP BY h HAVING count(*) > 1) SELECT doc_id, canonical FROM k JOIN g USING (h) WHERE doc_id <> canonical")
def exact_duplicates(spark, sf_dir):
    return dedup.exact_duplicates(spread(read(spark, sf_dir, "documents")), "doc_id", F.sha2(text.normalize_text(F.col("text")), 256))


_SETS = "sets AS (SELECT doc_id AS id, list_sort(list_distinct(list_filter(string_split(" + norm_sql("text") + ", ' '), lambda x: x <> ''))) AS s FROM documents)"


@query(f"WITH {_SETS}, c AS (SELECT s, min(id) AS rep FROM sets WHERE len(s) >= 4 GROUP BY s), near AS (SELECT a.rep AS a, b.rep AS b, len(list_intersect(a.s, b.s)) AS i, len(a.s) AS n, len(b.s) AS m FROM c a JOIN c b ON a.rep < b.rep AND least(len(a.s), len(b.s)) >= 0.8 * greatest(len(a.s), len(b.s))) SELECT a, b, i / (n + m - i) AS similarity FROM near WHERE i / (n + m - i) >= 0.8 UNION ALL SELECT rep, id, 1.0 FROM sets JOIN c USING (s) WHERE id <> rep")
def set_similarity(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "documents")).select("doc_id", text.tokens(F.col("text")).alias("words"))
    return dedup.set_similarity_join(docs, "doc_id", "words", 0.8, least=4)


@query()
def near_duplicates_minhash(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "documents")).select("doc_id", text.tokens(F.col("text")).alias("words"))
    return dedup.minhash_join(docs, "doc_id", F.col("words"), 0.8, rows=64)


@query("WITH q AS (SELECT vec_id AS query, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query, vec_id AS id, list_cosine_similarity(q.e, embedding::DOUBLE[]) AS c FROM q, embeddings WHERE query <> vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY c DESC, id) AS rank FROM s) SELECT query, id, round(c, 6) AS cosine, rank FROM r WHERE rank <= 5")
def cosine_top_k(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    found = dedup.nearest_vectors(vectors.filter("vec_id % 20 = 0"), vectors, "vec_id", "embedding", 5)
    return found.withColumn("cosine", F.round("cosine", 6))


_REL = f"""{TIMELINE},
ranked AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start_time, end_time, event_id) AS rn FROM timeline),
pairs AS (SELECT a.video_id, a.event_id AS a, b.event_id AS b, a.start_time AS s1, a.end_time AS e1, b.start_time AS s2, b.end_time AS e2 FROM ranked a JOIN ranked b ON a.video_id = b.video_id AND b.rn - a.rn BETWEEN 1 AND 6),
named AS (SELECT *, CASE WHEN e1 <= s2 + 0.25 AND NOT (abs(s1 - s2) <= 0.25 AND abs(e1 - e2) <= 0.25) THEN 'BEFORE' WHEN abs(s1 - s2) <= 0.25 AND abs(e1 - e2) <= 0.25 THEN NULL WHEN abs(s1 - s2) <= 0.25 THEN 'STARTS' WHEN abs(e1 - e2) <= 0.25 THEN 'ENDS' WHEN s2 >= s1 - 0.25 AND e2 <= e1 + 0.25 THEN 'DURING_B' WHEN s1 >= s2 - 0.25 AND e1 <= e2 + 0.25 THEN 'DURING' WHEN s1 < s2 AND s2 < e1 AND e1 < e2 THEN 'OVERLAPS' END AS r FROM pairs),
relations AS (SELECT video_id, CASE WHEN r = 'DURING_B' OR (r IN ('STARTS', 'ENDS') AND NOT (e1 - s1 < e2 - s2)) THEN b ELSE a END AS event_a, CASE WHEN r = 'DURING_B' OR (r IN ('STARTS', 'ENDS') AND NOT (e1 - s1 < e2 - s2)) THEN a ELSE b END AS event_b, replace(r, '_B', '') AS relation, CASE WHEN r = 'BEFORE' THEN round(s2 - e1, 3) END AS gap_seconds FROM named WHERE r IS NOT NULL)"""


@query(f"WITH {_REL} SELECT * FROM relations")
def interval_relations(spark, sf_dir):
    return temporal.neighbour_relations(timeline(spark, sf_dir))


@query(f"WITH {_REL}, near AS (SELECT * FROM relations WHERE relation = 'BEFORE' AND gap_seconds <= 20000), onward AS (SELECT video_id, event_a AS event_b, min(event_b) AS event_c FROM near GROUP BY ALL) SELECT video_id, event_a, event_b, event_c FROM near JOIN onward USING (video_id, event_b)")
def multi_event_paths(spark, sf_dir):
    return temporal.paths_of_two(temporal.neighbour_relations(timeline(spark, sf_dir)), 20000)


_BAD = "stated AS (SELECT video_id, event_a, event_b, CASE WHEN (event_a + event_b) % 5 = 0 THEN 'DURING' ELSE relation END AS relation FROM relations)"


@query(f"WITH {_REL}, {_BAD}, j AS (SELECT r.*, a.start_time AS s1, a.end_time AS e1, b.start_time AS s2, b.end_time AS e2 FROM stated r JOIN timeline a ON r.event_a = a.event_id JOIN timeline b ON r.event_b = b.event_id) SELECT video_id, event_a, event_b, relation, 'interval_semantics' AS reason FROM j WHERE NOT CASE relation WHEN 'BEFORE' THEN e1 <= s2 + 0.3 AND s1 <= s2 + 0.3 WHEN 'DURING' THEN s1 >= s2 - 0.3 AND e1 <= e2 + 0.3 AND e2 - s2 >= e1 - s1 - 0.3 WHEN 'OVERLAPS' THEN s1 < s2 + 0.3 AND e1 > s2 - 0.3 AND e1 < e2 + 0.3 WHEN 'STARTS' THEN abs(s1 - s2) <= 0.3 AND e1 <= e2 + 0.3 WHEN 'ENDS' THEN abs(e1 - e2) <= 0.3 AND s1 >= s2 - 0.3 END")
def relation_violations(spark, sf_dir):
    events = timeline(spark, sf_dir)
    stated = temporal.neighbour_relations(events).withColumn("relation", F.when((F.col("event_a") + F.col("event_b")) % 5 == 0, F.lit("DURING")).otherwise(F.col("relation")))
    return temporal.relation_violations(stated, events)


@query(f"WITH {TIMELINE}, c AS (SELECT a.video_id, a.event_id AS event_a, b.event_id AS event_b, b.start_time - a.end_time AS gap_seconds, row_number() OVER (PARTITION BY a.event_id ORDER BY b.start_time, b.event_id) AS n FROM timeline a JOIN timeline b ON a.video_id = b.video_id AND a.event_type = b.event_type AND b.start_time >= a.end_time + 20) SELECT video_id, event_a, event_b, gap_seconds FROM c WHERE n <= 3")
def long_range_links(spark, sf_dir):
    return temporal.long_range_links(timeline(spark, sf_dir), "event_type")


@query(f"WITH {TIMELINE}, asks AS (SELECT video_id, event_id, start_time AS t FROM timeline WHERE event_type = 'purchase'), views AS (SELECT video_id, event_id AS last_view, start_time AS t FROM timeline WHERE event_type = 'view') SELECT asks.video_id, asks.event_id, last_view FROM asks ASOF LEFT JOIN views ON asks.video_id = views.video_id AND asks.t >= views.t")
def as_of_latest(spark, sf_dir):
    events = timeline(spark, sf_dir).withColumnRenamed("start_time", "t")
    asks = events.filter("event_type = 'purchase'").select("video_id", "event_id", "t")
    views = events.filter("event_type = 'view'").select("video_id", F.col("event_id").alias("last_view"), "t")
    return temporal.as_of(asks, views, "last_view").select("video_id", "event_id", "last_view")


@query(f"WITH {TIMELINE}, asks AS (SELECT video_id, event_id, start_time AS t FROM timeline WHERE event_type = 'purchase'), views AS (SELECT video_id, event_id AS v, start_time AS t FROM timeline WHERE event_type = 'view'), r AS (SELECT asks.video_id, asks.event_id, v, row_number() OVER (PARTITION BY asks.event_id ORDER BY abs(asks.t - views.t), views.t) AS n FROM asks LEFT JOIN views ON asks.video_id = views.video_id) SELECT video_id, event_id, v AS nearest_view FROM r WHERE n = 1")
def nearest_in_time(spark, sf_dir):
    events = timeline(spark, sf_dir).withColumnRenamed("start_time", "t")
    asks = events.filter("event_type = 'purchase'").select("video_id", "event_id", "t")
    views = events.filter("event_type = 'view'").select("video_id", F.col("event_id").alias("nearest_view"), "t")
    return temporal.nearest(asks, views, "nearest_view").select("video_id", "event_id", "nearest_view")


@query(f"WITH {TIMELINE}, w AS (SELECT * FROM timeline WHERE event_type = 'signup'), s AS (SELECT * FROM timeline WHERE event_type = 'view') SELECT s.video_id, s.event_id, w.event_id AS window_id, greatest(s.start_time, w.start_time) - w.start_time AS clip_start, least(s.end_time, w.end_time) - w.start_time AS clip_end, s.start_time < w.start_time AS partial_start, s.end_time > w.end_time AS partial_end FROM s JOIN w ON s.video_id = w.video_id AND s.start_time < w.end_time AND s.end_time > w.start_time")
def window_clip(spark, sf_dir):
    events = timeline(spark, sf_dir)
    cut = temporal.clip_to_window(events.filter("event_type = 'view'"), events.filter("event_type = 'signup'"), width=36000.0)
    return cut.select("video_id", "event_id", F.col("r_event_id").alias("window_id"), "clip_start", "clip_end", "partial_start", "partial_end")


@query(f"WITH {TIMELINE}, p AS (SELECT video_id, event_id, start_time AS t FROM timeline WHERE event_type = 'error'), s AS (SELECT * FROM timeline WHERE event_type = 'click') SELECT p.video_id, p.event_id, s.event_id AS active_id FROM p JOIN s ON p.video_id = s.video_id AND p.t BETWEEN s.start_time AND s.end_time")
def active_events(spark, sf_dir):
    events = timeline(spark, sf_dir)
    points = events.filter("event_type = 'error'").select("video_id", "event_id", F.col("start_time").alias("t"))
    return temporal.points_in_intervals(points, events.filter("event_type = 'click'"), width=36000.0).select("video_id", "event_id", F.col("r_event_id").alias("active_id"))


@query(f"WITH {SCENES} SELECT video_id, scene_id, lag(scene_id) OVER w AS prev_scene_id, lead(scene_id) OVER w AS next_scene_id, coalesce(abs(lead(start_time) OVER w - end_time) <= 0.5, false) AS temporal_adjacency, list_has_any(objects, lead(objects) OVER w) AS subject_continuity FROM scenes WINDOW w AS (PARTITION BY video_id ORDER BY start_time, scene_id)")
def continuity_links(spark, sf_dir):
    return temporal.continuity(scenes(spark, sf_dir)).select("video_id", "scene_id", "prev_scene_id", "next_scene_id", "temporal_adjacency", "subject_continuity")


@query(f"WITH {SCENES}, p AS (SELECT video_id, scene_id, l_returnflag, l_linestatus, lag(l_returnflag) OVER w AS f, lag(l_linestatus) OVER w AS s FROM scenes WINDOW w AS (PARTITION BY video_id ORDER BY scene_id)) SELECT video_id, scene_id, 'l_returnflag' AS attribute, f AS before, l_returnflag AS after FROM p WHERE f <> l_returnflag UNION ALL SELECT video_id, scene_id, 'l_linestatus', s, l_linestatus FROM p WHERE s <> l_linestatus")
def state_changes(spark, sf_dir):
    return temporal.state_changes(scenes(spark, sf_dir), ["l_returnflag", "l_linestatus"], order="scene_id")


@query(f"WITH {SCENES}, p AS (SELECT video_id, scene_id, objects, lag(objects) OVER (PARTITION BY video_id ORDER BY scene_id) AS was FROM scenes) SELECT video_id, scene_id, coalesce(array_to_string(list_sort(list_distinct(list_filter(objects, lambda x: NOT list_contains(was, x)))), ','), '') AS appeared FROM p WHERE was IS NOT NULL UNION ALL SELECT video_id, scene_id, '' FROM p WHERE was IS NULL")
def new_entities(spark, sf_dir):
    return temporal.new_entities(scenes(spark, sf_dir), order="scene_id").select("video_id", "scene_id", F.array_join(F.array_sort("appeared"), ",").alias("appeared"))


@query(f"WITH {TIMELINE}, m AS (SELECT *, max(end_time) OVER (PARTITION BY video_id, event_type ORDER BY start_time, end_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM timeline), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_time > reach + 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id, event_type ORDER BY start_time, end_time ROWS UNBOUNDED PRECEDING) AS island FROM m) SELECT video_id, event_type, island, min(start_time) AS start_time, max(end_time) AS end_time, count(*) AS n FROM g GROUP BY ALL")
def gap_islands(spark, sf_dir):
    return temporal.gap_islands(timeline(spark, sf_dir), ["video_id", "event_type"], 3600.0)


@query(f"WITH {SCENES}, n AS (SELECT *, greatest(1, ceil((end_time - start_time) / 10))::BIGINT AS k FROM scenes), p AS (SELECT *, unnest(range(k)) AS part FROM n) SELECT video_id, scene_id, part, start_time + (end_time - start_time) / k * part AS start_time, CASE WHEN part = k - 1 THEN end_time ELSE start_time + (end_time - start_time) / k * (part + 1) END AS end_time FROM p")
def split_scenes(spark, sf_dir):
    return temporal.split_long(scenes(spark, sf_dir), 10.0).select("video_id", "scene_id", "part", "start_time", "end_time")


@query(f"WITH {SCENES}, g AS (SELECT *, greatest(1, sum(CASE WHEN end_time - start_time >= 15 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY start_time, scene_id ROWS UNBOUNDED PRECEDING)) AS g FROM scenes) SELECT video_id, min(scene_id) AS scene_id, min(start_time) AS start_time, max(end_time) AS end_time, count(*) AS merged FROM g GROUP BY video_id, g")
def merge_short_scenes(spark, sf_dir):
    return temporal.merge_short(scenes(spark, sf_dir), 15.0)


@query("SELECT o_orderkey AS record_id, o_custkey AS missing, o_orderstatus AS video_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)")
def reference_violations(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("video_id"), F.array("o_custkey").alias("refs"))
    parents = read(spark, sf_dir, "customer").filter("c_custkey % 7 <> 0").select("c_custkey")
    return release.dangling(orders, "refs", parents, "c_custkey", within=False)


@query("WITH chosen AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_discount >= 0.02) SELECT l_orderkey AS video_id, min(l_orderkey) AS record FROM lineitem l LEFT JOIN chosen c USING (l_orderkey, l_linenumber) GROUP BY l_orderkey HAVING count(*) = count(c.l_linenumber)")
def evidence_coverage(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    records = lines.groupBy(F.col("l_orderkey").alias("video_id")).agg(F.min("l_orderkey").alias("record"), F.collect_set("l_linenumber").alias("members"))
    chosen = lines.filter("l_discount >= 0.02").select(F.col("l_orderkey").alias("video_id"), F.col("l_linenumber").alias("member"))
    return curation.all_members(records, "record", "members", chosen, "member").select("video_id", "record")


_OLD, _NEW = "o_orderkey % 10 <> 3", "o_orderkey % 10 <> 7"


@query(f"WITH o AS (SELECT * FROM orders WHERE {_OLD}), n AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE {_NEW}) SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'removed' WHEN o.o_totalprice <> n.o_totalprice THEN 'changed' ELSE 'kept' END AS change, CASE WHEN o.o_totalprice <> n.o_totalprice THEN 'o_totalprice' ELSE '' END AS changed FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey")
def release_diff(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    new = orders.filter(_NEW).withColumn("o_totalprice", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    found = release.diff(orders.filter(_OLD), new, "o_orderkey", ["o_orderstatus", "o_totalprice"])
    return found.withColumn("changed", F.array_join("changed", ","))


@query("SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS finished FROM orders GROUP BY ROLLUP (o_orderpriority)")
def rollup_report(spark, sf_dir):
    return stats.rolled_up(read(spark, sf_dir, "orders"), "o_orderpriority", F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"))


@query("WITH v AS (SELECT l_linestatus, l_discount * 10 AS c FROM lineitem) SELECT l_linestatus, least(9, floor(c * 10))::INT AS bin, count(*) AS n, round(avg(c), 9) AS mean FROM v GROUP BY ALL")
def confidence_histogram(spark, sf_dir):
    return stats.histogram(read(spark, sf_dir, "lineitem"), F.col("l_discount") * 10, by=["l_linestatus"]).withColumn("mean", F.round("mean", 9))


@query("WITH s AS (SELECT l_shipmode, list_sort(list(q)) AS v FROM (SELECT l_returnflag AS l_shipmode, l_quantity AS q FROM lineitem) GROUP BY ALL) SELECT l_shipmode AS l_returnflag, len(v) AS n, round(list_avg(v), 9) AS mean, v[least(len(v) - 1, floor(0.1 * len(v)))::BIGINT + 1] AS q10, v[least(len(v) - 1, floor(0.5 * len(v)))::BIGINT + 1] AS q50, v[least(len(v) - 1, floor(0.95 * len(v)))::BIGINT + 1] AS q95 FROM s")
def duration_quantiles(spark, sf_dir):
    return stats.index_quantiles(read(spark, sf_dir, "lineitem"), "l_quantity", [0.1, 0.5, 0.95], ["l_returnflag"]).withColumn("mean", F.round("mean", 9))


_DIST = "d AS (SELECT 'lang' AS dimension, coalesce(lang, 'unknown') AS value FROM documents UNION ALL SELECT 'source', coalesce(source, 'unknown') FROM documents UNION ALL SELECT 'size', CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'medium' WHEN n_chars < 10000 THEN 'long' ELSE 'unknown' END FROM documents), c AS (SELECT dimension, value, count(*) AS n FROM d GROUP BY ALL)"


def _diversity(spark, sf_dir):
    size = curation.duration_band(F.col("n_chars"), {"short": (float("-inf"), 500), "medium": (500, 3000), "long": (3000, 10000)})
    return stats.distributions(read(spark, sf_dir, "documents"), {"lang": F.col("lang"), "source": F.col("source"), "size": size})


@query(f"WITH {_DIST}, t AS (SELECT *, sum(n) OVER (PARTITION BY dimension) AS total, count(*) OVER (PARTITION BY dimension) AS kinds FROM c WHERE value <> 'unknown') SELECT dimension, value, n, n / total AS share FROM t WHERE kinds >= 2 AND n / total < 0.9 / kinds")
def diversity_underrepresented(spark, sf_dir):
    return stats.underrepresented(_diversity(spark, sf_dir), 0.9)


@query(f"WITH {_DIST} SELECT dimension, coalesce(sum(n) FILTER (value = 'unknown'), 0) / sum(n) AS unknown_fraction FROM c GROUP BY dimension")
def unknown_fractions(spark, sf_dir):
    return stats.unknown_share(_diversity(spark, sf_dir))


_CAL = "p AS (SELECT l_linestatus AS source, l_tax * 12 AS c, CASE WHEN l_discount > 0.03 THEN 1.0 ELSE 0.0 END AS y FROM lineitem)"


@query(f"WITH {_CAL}, b AS (SELECT source, least(9, floor(c * 10)) AS bin, count(*) AS m, avg(y) AS acc, avg(c) AS conf FROM p GROUP BY ALL), e AS (SELECT source, sum(m * abs(acc - conf)) / sum(m) AS ece FROM b GROUP BY ALL), s AS (SELECT source, round(c, 3) AS t, count(*) AS m, sum(1 - y) AS bad FROM p GROUP BY ALL), w AS (SELECT source, t, sum(bad) OVER (PARTITION BY source ORDER BY t DESC) / sum(m) OVER (PARTITION BY source ORDER BY t DESC) AS share FROM s), g AS (SELECT source, min(t) AS recommended FROM w WHERE share <= 0.4 GROUP BY ALL) SELECT p.source, count(*) AS n, round(avg(y), 6) AS accuracy, round(avg((c - y) * (c - y)), 6) AS brier, round(avg(y) FILTER (c >= 0.75), 6) AS precision, round(avg(1 - y) FILTER (c >= 0.75), 6) AS false_accept, round(avg(y) FILTER (c < 0.75), 6) AS false_reject, round(any_value(ece), 6) AS ece, any_value(recommended) AS recommended FROM p JOIN e USING (source) LEFT JOIN g USING (source) GROUP BY p.source")
def calibration_metrics(spark, sf_dir):
    pairs = read(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("source"), (F.col("l_tax") * 12).alias("confidence"), (F.col("l_discount") > 0.03).cast("int").alias("correct"))
    told = agreement.calibration(pairs, "source", target=0.4)
    return told.select("source", "n", *[F.round(c, 6).alias(c) for c in ("accuracy", "brier", "precision", "false_accept", "false_reject", "ece")], "recommended")


_LABELS = "j AS (SELECT CASE WHEN n_chars < 200 THEN 'low' WHEN n_chars > 8000 THEN 'long' ELSE 'fine' END AS predicted, CASE WHEN quality = 0 THEN 'low' WHEN toxic = 1 THEN 'toxic' ELSE 'fine' END AS actual FROM documents JOIN labels USING (doc_id))"


def _labelled(spark, sf_dir):
    n = F.col("n_chars")
    joined = read(spark, sf_dir, "documents").select("doc_id", "n_chars").join(read(spark, sf_dir, "labels"), "doc_id")
    return joined.select(F.when(n < 200, F.lit("low")).when(n > 8000, F.lit("long")).otherwise(F.lit("fine")).alias("predicted"), F.when(F.col("quality") == 0, F.lit("low")).when(F.col("toxic") == 1, F.lit("toxic")).otherwise(F.lit("fine")).alias("actual"))


@query(f"WITH {_LABELS} SELECT predicted, actual, count(*) AS n FROM j GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return agreement.confusion(_labelled(spark, sf_dir), "predicted", "actual")


@query(f"WITH {_LABELS}, l AS (SELECT DISTINCT predicted AS label FROM j UNION SELECT DISTINCT actual FROM j), s AS (SELECT label, (SELECT count(*) FROM j WHERE predicted = label AND actual = label) AS tp, (SELECT count(*) FROM j WHERE actual = label) AS support, (SELECT count(*) FROM j WHERE predicted = label) AS predicted_n FROM l) SELECT label, tp::BIGINT AS tp, support::BIGINT AS support, predicted_n::BIGINT AS predicted_n, round(CASE WHEN predicted_n > 0 THEN tp / predicted_n END, 9) AS precision, round(CASE WHEN support > 0 THEN tp / support END, 9) AS recall, round(CASE WHEN tp > 0 THEN 2 * (tp / predicted_n) * (tp / support) / (tp / predicted_n + tp / support) ELSE 0 END, 9) AS f1 FROM s")
def class_scores(spark, sf_dir):
    told = agreement.class_scores(agreement.confusion(_labelled(spark, sf_dir), "predicted", "actual"), "predicted", "actual")
    return told.select("label", "tp", "support", "predicted_n", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(f"WITH {_LABELS}, t AS (SELECT count(*) AS n, count(*) FILTER (predicted = actual) AS same FROM j), m AS (SELECT sum(a.x * b.y) AS xy FROM (SELECT predicted AS l, count(*) AS x FROM j GROUP BY 1) a JOIN (SELECT actual AS l, count(*) AS y FROM j GROUP BY 1) b USING (l)) SELECT n, round(same / n, 9) AS agreement, round((same / n - xy / (n * n)) / (1 - xy / (n * n)), 9) AS kappa FROM t, m")
def cohens_kappa(spark, sf_dir):
    return agreement.cohens_kappa(_labelled(spark, sf_dir), "predicted", "actual").select("n", F.round("agreement", 9).alias("agreement"), F.round("kappa", 9).alias("kappa"))


@query("""WITH z AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1), h AS (SELECT *, least(60, sum(n) OVER ()) * n / sum(n) OVER () AS share FROM z), s AS (SELECT *, unnest(range(1, least(n, ceil(share) + 1)::BIGINT + 1)) AS seat FROM h),
r AS (SELECT *, row_number() OVER (ORDER BY seat > 1, CASE WHEN seat > 1 THEN round(share - seat + 1, 9) END DESC NULLS LAST, n DESC, lang) AS r FROM s), p AS (SELECT lang, count(*) AS places FROM r WHERE r <= 60 GROUP BY 1),
d AS (SELECT doc_id, lang, source, sha1('1234|' || doc_id) AS u FROM documents), q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY u, doc_id) AS k FROM d WHERE lang IS NOT NULL), c AS (SELECT q.*, row_number() OVER (ORDER BY u, doc_id) - 1 AS t, count(*) OVER () AS m FROM q JOIN p USING (lang) WHERE k <= places)
SELECT doc_id, lang, source, CASE WHEN t < round(0.2 * m) THEN 'reviewer_a,reviewer_b' WHEN t % 2 = 0 THEN 'reviewer_a' ELSE 'reviewer_b' END AS assigned_to FROM c""")
def stratified_sample(spark, sf_dir):
    return agreement.stratified_sample(read(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "lang", "doc_id", 60).withColumn("assigned_to", F.array_join("assigned_to", ","))


_CHECKS = "c AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax IS NULL THEN 'review' WHEN l_tax * 12 >= 0.75 THEN 'accepted' WHEN l_tax * 12 >= 0.5 THEN 'review' ELSE 'rejected' END AS suggested, CASE WHEN l_linenumber = 1 THEN 'not_run' WHEN l_returnflag = 'R' THEN 'failed' ELSE 'passed' END AS events_exist, CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linestatus = 'O' THEN 'passed' ELSE 'failed' END AS interval_semantics, l_quantity > 49 AS hard FROM lineitem)"


@query(f"WITH {_CHECKS}, r AS (SELECT *, list_filter([CASE WHEN events_exist = 'not_run' THEN 'missing_check:events_exist' WHEN events_exist = 'failed' THEN 'failed_check:events_exist' END, CASE WHEN interval_semantics IS NULL THEN 'missing_check:interval_semantics' WHEN interval_semantics = 'failed' THEN 'failed_check:interval_semantics' END], lambda x: x IS NOT NULL) AS caps FROM c) SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN hard THEN 'rejected' WHEN suggested = 'accepted' AND len(caps) > 0 THEN 'review' ELSE suggested END AS status, CASE WHEN hard THEN 'hard:too_long' ELSE array_to_string(list_concat(CASE WHEN suggested <> 'accepted' THEN ['confidence:' || suggested] ELSE [] END, caps), ',') END AS reasons FROM r")
def policy_status(spark, sf_dir):
    lines = spread(read(spark, sf_dir, "lineitem"))
    exist = F.when(F.col("l_linenumber") == 1, F.lit("not_run")).when(F.col("l_returnflag") == "R", F.lit("false")).otherwise(F.lit("true"))
    checks = F.map_filter(F.create_map(F.lit("events_exist"), exist, F.lit("interval_semantics"), (F.col("l_linestatus") == "O").cast("string")), lambda k, _: (k != "interval_semantics") | (F.col("l_linenumber") != 2))
    hard = F.when(F.col("l_quantity") > 49, F.array(F.lit("too_long"))).otherwise(F.array().cast("array<string>"))
    stored = lines.select("l_orderkey", "l_linenumber", "l_partkey", checks.alias("checks"), hard.alias("hard"), policy.threshold_status(F.col("l_tax") * 12).alias("suggested"))
    looked = stored.withColumn("caps", policy.caps("relation", F.col("checks")))
    told = policy.decide("relation", checks, F.col("hard"), F.col("suggested"), held=F.col("caps"))
    return looked.select("l_orderkey", "l_linenumber", "l_partkey", told.alias("t")).select("l_orderkey", "l_linenumber", "l_partkey", "t.status", F.array_join("t.reasons", ",").alias("reasons"))


@query("SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size < 5 THEN 'status:review' END, CASE WHEN p_type = 'ECONOMY' THEN 'not_in_subset:cinematic' END, CASE WHEN p_name LIKE '%red%' THEN 'camera:unknown' WHEN p_size % 9 = 0 THEN 'camera:ambiguous' END], lambda x: x IS NOT NULL), ',') AS reasons FROM part")
def task_eligibility(spark, sf_dir):
    status = F.when(F.col("p_size") < 5, F.lit("review")).otherwise(F.lit("accepted"))
    subsets = F.when(F.col("p_type") == "ECONOMY", F.array().cast("array<string>")).otherwise(F.array(F.lit("cinematic")))
    camera = F.when(F.col("p_name").contains("red"), F.lit("unknown")).otherwise(F.lit("pan"))
    why = curation.ineligible(curation.TASKS["cinematic"], F.lit("scenes"), status, subsets, camera=camera, ambiguous=F.col("p_size") % 9 == 0)
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(why, ",").alias("reasons"))


@query("SELECT o_orderkey AS record_id, unnest(list_filter([CASE WHEN o_totalprice < 20000 THEN 'low_value' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN o_orderpriority LIKE '%NOT%' THEN 'unspecified' END], lambda x: x IS NOT NULL)) AS queue FROM orders")
def repair_queues(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "record_id")
    return release.queues(orders, {"low_value": F.col("o_totalprice") < 20000, "pending": F.col("o_orderstatus") == "P", "unspecified": F.col("o_orderpriority").contains("NOT")})


@query("WITH fresh AS (SELECT o_orderkey, o_custkey, o_totalprice * 2 AS price FROM orders WHERE o_custkey % 10 = 0), old AS (SELECT o_orderkey, o_custkey, o_totalprice AS price FROM orders WHERE o_custkey % 10 <> 0 AND o_custkey % 13 <> 0 UNION ALL SELECT * FROM fresh WHERE o_custkey % 13 <> 0) SELECT o_orderkey, o_custkey, price FROM old")
def takedown_merge(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"))
    fresh = orders.filter("o_custkey % 10 = 0").withColumn("price", F.col("price") * 2)
    removed = read(spark, sf_dir, "orders").filter("o_custkey % 13 = 0").select("o_custkey")
    return release.takedown(release.merge_release(orders, fresh, "o_custkey", "o_orderkey"), removed, "o_custkey")


_WORDS = "list_distinct(list_filter(string_split(" + norm_sql("{0}") + ", ' '), lambda x: length(x) > 1 AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN (" + ", ".join(f"'{w}'" for w in text.STOPWORDS) + ")))"


@query("WITH w AS (SELECT a.conv_id, a.turn, " + _WORDS.replace("{0}", "a.text") + " AS x, " + _WORDS.replace("{0}", "b.text") + " AS y FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1) SELECT conv_id, turn, CASE WHEN len(x) = 0 THEN 1.0 ELSE len(list_intersect(x, y)) / len(x) END AS grounding FROM w")
def lexical_grounding(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("evidence"))
    return turns.join(before, ["conv_id", "turn"]).select("conv_id", "turn", text.lexical_grounding(F.col("text"), F.col("evidence")).alias("grounding"))


@query("WITH d AS (SELECT doc_id, text, " + norm_sql("text") + " AS n FROM documents), k AS (SELECT doc_id, text, count(*) OVER (PARTITION BY sha256(n)) AS copies FROM d) SELECT doc_id, array_to_string(list_filter([CASE WHEN length(text) < 60 THEN 'too_short' END, CASE WHEN regexp_matches(text, '[#$%&*]{3}') THEN 'residue' END, CASE WHEN copies > 1 THEN 'duplicate' END], lambda x: x IS NOT NULL), ',') AS reasons FROM k")
def caption_rules(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "documents")).select("doc_id", F.length("text").alias("n"), F.col("text").rlike("[#$%&*]{3}").alias("residue"), F.sha2(text.normalize_text(F.col("text")), 256).alias("h"))
    docs = durable(docs)  # hashed once, read twice
    copies = docs.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    told = docs.join(copies, "h", "left")
    return told.select("doc_id", F.array_join(reasons((F.col("n") < 60, "too_short"), (F.col("residue"), "residue"), (F.col("c") > 1, "duplicate")), ",").alias("reasons"))


@query("WITH d AS (SELECT 'brand' AS dimension, p_brand AS value, p_retailprice AS h FROM part UNION ALL SELECT 'type', p_type, p_retailprice FROM part) SELECT dimension, value, count(*) AS clips, round(sum(h) / 3600, 6) AS hours FROM d GROUP BY ALL")
def cinematic_coverage(spark, sf_dir):
    told = stats.coverage(read(spark, sf_dir, "part"), {"brand": F.col("p_brand"), "type": F.col("p_type")}, F.col("p_retailprice"))
    return told.withColumn("hours", F.round(F.col("hours") / 3600, 6))


@query("SELECT 'customer' AS record_type, c_custkey::VARCHAR AS record_id, c_name AS name, c_nationkey::VARCHAR AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey::VARCHAR, s_name, s_nationkey::VARCHAR FROM supplier UNION ALL SELECT 'region', r_regionkey::VARCHAR, r_name, NULL FROM region")
def normalised_export(spark, sf_dir):
    from ..sources.writers import normalised

    tables = {t: read(spark, sf_dir, t) for t in ("customer", "supplier", "region")}
    aliases = {"record_id": ["c_custkey", "s_suppkey", "r_regionkey"], "name": ["c_name", "s_name", "r_name"], "nation": ["c_nationkey", "s_nationkey"]}
    return normalised(tables, ["record_id", "name", "nation"], aliases).drop("payload")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'new' WHEN o_orderkey % 11 = 0 THEN 'changed' ELSE 'unchanged' END AS change FROM orders")
def incremental_ingest(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    known = incremental.hashed(orders.filter("o_orderkey % 10 <> 3"), "o_orderkey")
    fresh = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return incremental.ingest(known, fresh, "o_orderkey")


@query("WITH o AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), g AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 6 HOURS THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM o) SELECT user_id, epoch_us(min(ts)) AS started, epoch_us(max(ts) + INTERVAL 6 HOURS) AS ended, count(*) AS n FROM g GROUP BY user_id, s")
def session_islands(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    told = incremental.sessions(events, "user_id", "ts", "6 hours")
    return told.select("user_id", F.unix_micros("start").alias("started"), F.unix_micros("end").alias("ended"), "n")


@query("WITH w AS (SELECT event_type, value, unnest([time_bucket(INTERVAL 6 HOURS, ts), time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS]) AS b FROM events) SELECT event_type, epoch_us(b) AS started, count(*) AS n, round(sum(value), 6) AS total FROM w GROUP BY ALL")
def sliding_windows(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    told = incremental.sliding_counts(events, "event_type", "ts", "12 hours", "6 hours", "value")
    return told.select("event_type", F.unix_micros("start").alias("started"), "n", F.round("total", 6).alias("total"))


@query("SELECT sha256(string_agg(k, chr(10) ORDER BY k)) AS frozen, count(*) AS n FROM (SELECT DISTINCT p_partkey::VARCHAR AS k FROM part)")
def frozen_hash(spark, sf_dir):
    return stats.frozen_hash(read(spark, sf_dir, "part"), "p_partkey")


@query("SELECT s_suppkey, CASE WHEN s_nationkey % 5 = 0 THEN 'rights_status is pending' WHEN s_nationkey > 23 THEN 'rights_status is not known' ELSE array_to_string(list_filter([CASE WHEN s_acctbal < 0 THEN 'training_allowed is not true' END, CASE WHEN s_suppkey % 4 = 0 THEN 'license is empty' END], lambda x: x IS NOT NULL), ',') END AS problems FROM supplier")
def rights_gate(spark, sf_dir):
    nation = F.col("s_nationkey")
    status = F.when(nation % 5 == 0, F.lit("pending")).when(nation > 23, F.lit("odd")).otherwise(F.lit("approved"))
    problems = policy.rights_problems(status, {"training_allowed": F.col("s_acctbal") >= 0}, {"license": F.when(F.col("s_suppkey") % 4 != 0, F.lit("cc0"))}, F.lit(None).cast("date"), F.lit("2026-01-01").cast("date"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(problems, ",").alias("problems"))


@query("SELECT o_orderkey AS record_id, 720 AS target, CASE WHEN short >= 720 THEN '720p' WHEN short >= 576 THEN 'native_576' WHEN short >= 480 THEN 'native_480_576' WHEN short >= 360 THEN 'lowres_360' ELSE 'excluded_lowres' END AS bucket FROM (SELECT o_orderkey, least(300 + o_custkey % 900, 400 + o_orderkey % 700) AS short FROM orders)")
def resolution_buckets(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    told = curation.resolution((300 + F.col("o_custkey") % 900).cast("int"), (400 + F.col("o_orderkey") % 700).cast("int"))
    return orders.select(F.col("o_orderkey").alias("record_id"), F.lit(720).alias("target"), told["bucket"].alias("bucket"))


@query(f"WITH {TIMELINE} SELECT a.event_id AS a, b.event_id AS b, greatest(0, least(a.end_time, b.end_time) - greatest(a.start_time, b.start_time)) / (greatest(a.end_time, b.end_time) - least(a.start_time, b.start_time)) AS iou FROM timeline a JOIN timeline b ON a.video_id = b.video_id AND a.event_id < b.event_id AND a.start_time < b.end_time AND a.end_time > b.start_time")
def overlap_iou(spark, sf_dir):
    events = timeline(spark, sf_dir)
    pairs = temporal.interval_join(events, events, width=36000.0).filter("event_id < r_event_id")
    return pairs.select(F.col("event_id").alias("a"), F.col("r_event_id").alias("b"), interval.iou(F.col("start_time"), F.col("end_time"), F.col("r_start_time"), F.col("r_end_time")).alias("iou"))


_FLAG = f"""WITH {_split_sql('documents', 'source')},
n AS (SELECT doc_id, source, lang, n_chars, sha256({norm_sql('text')}) AS h FROM documents),
c AS (SELECT *, min(doc_id) OVER (PARTITION BY h) AS canonical FROM n),
t AS (SELECT c.*, split, CASE WHEN canonical <> doc_id THEN 'duplicate' WHEN n_chars < 100 THEN 'rejected' WHEN n_chars < 400 THEN 'review' ELSE 'accepted' END AS status FROM c JOIN assigned USING (source)),
g AS (SELECT *, CASE WHEN status IN ('duplicate', 'rejected') THEN 'none' WHEN status = 'accepted' AND n_chars >= 1500 THEN 'silver' ELSE 'bronze' END AS tier FROM t)
SELECT split, lang, status, tier, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM g GROUP BY ALL"""


@query(_FLAG)
def annotate_pipeline(spark, sf_dir):
    """Duplicates, groups, splits, policy and tiers of all documents, as counts."""
    docs = spread(read(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "n_chars", F.sha2(text.normalize_text(F.col("text")), 256).alias("h"))
    docs = durable(docs)  # hashed once, read thrice
    copies = docs.groupBy("h").agg(F.min("doc_id").alias("canonical"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    splits = curation.assign_splits(docs, "source")
    told = docs.join(copies, "h", "left").join(splits, "source")
    size = F.col("n_chars")
    status = F.when(F.col("canonical") != F.col("doc_id"), F.lit("duplicate")).otherwise(policy.threshold_status(size.cast("double"), 400.0, 100.0))
    tier = curation.tier(F.col("status"), F.when(size >= 1500, F.lit(0.7)).otherwise(0.0), F.lit(None).cast("double"), F.lit(None).cast("string"), F.array().cast("array<string>"))["tier"]
    return told.withColumn("status", status).withColumn("tier", F.coalesce(tier, F.lit("none"))).groupBy("split", "lang", "status", "tier").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query(r"WITH d AS (SELECT doc_id, lower(trim(text, ' ')) AS t FROM documents), w AS (SELECT doc_id, t, regexp_split_to_array(t, '\s+') AS w FROM d) SELECT doc_id, array_to_string(list_filter([CASE WHEN t = '' THEN 'empty' END, CASE WHEN t <> '' AND length(t) < 12 THEN 'too_short' END, CASE WHEN length(t) > 1200 THEN 'too_long' END, CASE WHEN t IN ('unknown', 'unmeasured', 'n/a', 'null', 'none') THEN 'placeholder' END, CASE WHEN regexp_matches(t, '[{}<>]|```|\bas an ai\b') THEN 'residue' END, CASE WHEN len(w) >= 6 AND len(list_distinct(w)) * 2 < len(w) THEN 'repetitive' END], lambda x: x IS NOT NULL), ',') AS faults FROM w")
def caption_faults(spark, sf_dir):
    return spread(read(spark, sf_dir, "documents")).select("doc_id", F.array_join(captions.caption_faults(F.col("text")), ",").alias("faults"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_filter([CASE WHEN l_quantity < 10 THEN 'blurry' END, CASE WHEN l_discount > 0.08 THEN 'underexposed' END, CASE WHEN l_tax > 0.07 THEN 'overexposed' END], lambda x: x IS NOT NULL), ',') AS flags FROM lineitem")
def visual_flags(spark, sf_dir):
    limits = (captions.Limit("sharpness", "blurry", least=10), captions.Limit("dark", "underexposed", most=0.08), captions.Limit("bright", "overexposed", most=0.07))
    flags = captions.outside(limits, sharpness=F.col("l_quantity"), dark=F.col("l_discount"), bright=F.col("l_tax"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(flags, ",").alias("flags"))


@query(f"WITH {TIMELINE}, r AS (SELECT video_id, event_id, row_number() OVER (PARTITION BY video_id ORDER BY start_time) - 1 AS rn, count(*) OVER (PARTITION BY video_id) AS n FROM timeline) SELECT video_id, event_id FROM r WHERE n <= 5 OR list_contains(list_transform(range(5), lambda i: round_even(i * (n - 1) / 4, 0)::BIGINT), rn)")
def evenly_spaced(spark, sf_dir):
    return temporal.evenly_spaced(timeline(spark, sf_dir), 5, order="start_time").select("video_id", "event_id")


@query("WITH n AS (SELECT *, lag(value) OVER w AS l, lead(value) OVER w AS r FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) SELECT user_id, event_id, value FROM n WHERE value > 50 AND value > coalesce(l, -1) AND value >= coalesce(r, -1)")
def motion_peaks(spark, sf_dir):
    return temporal.motion_peaks(read(spark, sf_dir, "events"), "value", 50.0, "user_id", "ts").select("user_id", "event_id", "value")


@query(f"WITH {TIMELINE}, q AS (SELECT video_id, event_type, start_time, end_time FROM timeline WHERE end_time - start_time >= 1) SELECT video_id, 'Approximately how long does the following last: ' || event_type || '?' AS question, count(*) AS n FROM q GROUP BY ALL")
def duration_questions(spark, sf_dir):
    return questions.durations(timeline(spark, sf_dir), "event_type").groupBy("video_id", "question").agg(F.count(F.lit(1)).alias("n"))


@query()
def question_generation(spark, sf_dir):
    return questions.generate(timeline(spark, sf_dir), "event_type", entity="event_type", attributes=["event_type"]).withColumn("event_ids", F.array_join("event_ids", ","))


@query()
def answer_recompute(spark, sf_dir):
    events = timeline(spark, sf_dir)
    return questions.recompute(questions.generate(events, "event_type", entity="event_type", attributes=["event_type"]), events).groupBy("type", "recomputed").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, CASE WHEN NOT regexp_matches(lower(url), '^https?://') THEN 'invalid' WHEN regexp_matches(url, '[?&]v=') THEN 'video' WHEN regexp_matches(url, '[?&]list=') THEN 'playlist' ELSE 'other' END AS kind FROM pages")
def url_kinds(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", captions.url_kind(F.col("url")).alias("kind"))


@query(f"WITH {TIMELINE}, m AS (SELECT *, lag(start_time) OVER (PARTITION BY video_id, event_type ORDER BY start_time) AS p FROM timeline), g AS (SELECT *, sum(CASE WHEN p IS NULL OR start_time > p + 30000 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id, event_type ORDER BY start_time ROWS UNBOUNDED PRECEDING) AS i FROM m) SELECT video_id, event_type AS text, min(start_time) AS start_time, max(start_time) AS end_time, count(*) AS n FROM g GROUP BY video_id, event_type, i")
def text_tracks(spark, sf_dir):
    return ocr.tracks(timeline(spark, sf_dir).select("video_id", F.col("event_type").alias("text"), F.col("start_time").alias("t")), 30000.0)


@query("SELECT c_custkey::VARCHAR AS record_id, c_acctbal AS start_time, '2.3.0' AS schema_version, c_mktsegment AS segment FROM customer")
def migrate_records(spark, sf_dir):
    old = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").alias("start"), F.lit("0.0.0").alias("schema_version"), F.col("c_mktsegment").alias("segment"))
    return schema.migrate(old, ["record_id", "start_time"]).withColumn("segment", F.col("extensions")["segment"]).drop("extensions")


@query("WITH e AS (SELECT user_id AS source_id, event_id AS seq, CASE event_type WHEN 'view' THEN 'acquired' WHEN 'click' THEN 'decoded' WHEN 'purchase' THEN 'published' WHEN 'error' THEN 'failed' ELSE 'blocked' END AS state FROM events), m AS (SELECT source_id, max_by(state, seq) FILTER (state NOT IN ('failed', 'blocked')) AS good, max(seq) FILTER (state NOT IN ('failed', 'blocked')) AS g, max_by(state, seq) FILTER (state IN ('failed', 'blocked')) AS bad, max(seq) FILTER (state IN ('failed', 'blocked')) AS b FROM e GROUP BY ALL) SELECT source_id, coalesce(good, 'registered') AS state, CASE WHEN b > coalesce(g, -1) THEN bad END AS error FROM m")
def job_states(spark, sf_dir):
    names = {"view": "acquired", "click": "decoded", "purchase": "published", "error": "failed"}
    state = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in names.items()], F.lit("blocked"))
    events = read(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), F.col("event_id").alias("seq"), state.alias("state"))
    return incremental.advance(events.select("source_id").distinct(), events)


@query(f"WITH {SCENES}, b AS (SELECT *, lag(l_returnflag) OVER w AS p, lead(l_returnflag) OVER w AS q FROM scenes WINDOW w AS (PARTITION BY video_id ORDER BY scene_id)), s AS (SELECT video_id, scene_id, CASE WHEN p = q AND l_returnflag <> p THEN p ELSE l_returnflag END AS label FROM b), f AS (SELECT *, CASE WHEN label = lag(label) OVER (PARTITION BY video_id ORDER BY scene_id) THEN 0 ELSE 1 END AS fresh FROM s), i AS (SELECT *, sum(fresh) OVER (PARTITION BY video_id ORDER BY scene_id ROWS UNBOUNDED PRECEDING) AS island FROM f) SELECT video_id, island, any_value(label) AS label, min(scene_id) AS first, max(scene_id) AS last, count(*) AS n FROM i GROUP BY video_id, island")
def label_islands(spark, sf_dir):
    return motion.label_islands(scenes(spark, sf_dir), "l_returnflag", order="scene_id")


@query("WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events), c AS (SELECT user_id, avg(value) FILTER (r > n - greatest(1, n // 4)) - avg(value) FILTER (r <= greatest(1, n // 4)) AS change FROM r GROUP BY ALL) SELECT user_id, round(change, 6) AS change, CASE WHEN change >= 20 THEN 'rising' WHEN change <= -20 THEN 'falling' ELSE 'steady' END AS trend FROM c")
def brightness_trend(spark, sf_dir):
    return motion.trend(read(spark, sf_dir, "events"), "value", "user_id", "ts").withColumn("change", F.round("change", 6))
