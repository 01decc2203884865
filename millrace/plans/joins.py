"""Queries of joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import curation, dedup, graph, relational, release, temporal
from ..runtime import read, spread
from .catalog import _split_sql
from .registry import query
from .views import SCENES, TIMELINE, norm_sql, scenes, timeline

_CLIPS = "clips AS (SELECT video_id, scene_id, 'c' || (l_suppkey * 37 % 1009) AS clip_id FROM scenes WHERE l_suppkey % 4 <> 0 UNION ALL SELECT video_id, scene_id, 'clip' || l_suppkey FROM scenes WHERE l_suppkey % 3 <> 0)"


@query(f"WITH {SCENES}, {_CLIPS}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id, scene_id ORDER BY length(clip_id), clip_id) AS n FROM clips) SELECT s.video_id, s.scene_id, r.clip_id FROM scenes s LEFT JOIN r ON s.video_id = r.video_id AND s.scene_id = r.scene_id AND r.n = 1")
def shortest_clip(spark, sf_dir):
    shots = scenes(spark, sf_dir)
    keys = ["video_id", "scene_id"]
    number = F.col("l_suppkey") * 37 % 1009
    clips = shots.filter("l_suppkey % 4 <> 0").select(*keys, F.concat(F.lit("c"), number.cast("string")).alias("clip_id")).unionByName(shots.filter("l_suppkey % 3 <> 0").select(*keys, F.concat(F.lit("clip"), F.col("l_suppkey").cast("string")).alias("clip_id")))
    return relational.shortest_named(shots.select(*keys), clips, keys, "clip_id")


@query("SELECT o_orderkey, o_custkey, c_mktsegment AS segment, CASE WHEN o_orderkey % 3 = 0 THEN c_acctbal ELSE o_totalprice END AS price FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) c ON o_custkey = c_custkey")
def record_facts(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"))
    facts = read(spark, sf_dir, "customer").filter("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("price"))
    return relational.with_facts(orders, facts, "o_custkey", ["segment", "price"])


@query(f"WITH {_split_sql('customer', 'c_custkey')} SELECT o_orderkey, o_custkey, coalesce(split, 'unassigned') AS split FROM orders LEFT JOIN (SELECT * FROM assigned WHERE c_custkey % 11 <> 0) a ON o_custkey = c_custkey")
def record_splits(spark, sf_dir):
    splits = curation.assign_splits(read(spark, sf_dir, "customer"), "c_custkey").filter("c_custkey % 11 <> 0").withColumnRenamed("c_custkey", "o_custkey")
    return relational.with_split(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), splits, "o_custkey")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN CASE WHEN n_chars < 400 THEN 'review' ELSE 'accepted' END WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 THEN 'accepted' ELSE CASE WHEN n_chars < 400 THEN 'review' ELSE 'accepted' END END AS status, CASE WHEN l.doc_id IS NOT NULL THEN 'r' || l.doc_id % 3 END AS labelled_by FROM documents d LEFT JOIN labels l USING (doc_id)")
def label_override(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") < 400, F.lit("review")).otherwise(F.lit("accepted")).alias("status"))
    label = F.when(F.col("toxic") == 1, F.lit("reject")).when(F.col("quality") == 1, F.lit(" Accept")).otherwise(F.lit("unsure"))
    labels = read(spark, sf_dir, "labels").select("doc_id", label.alias("label"), F.concat(F.lit("r"), (F.col("doc_id") % 3).cast("string")).alias("reviewer"))
    return relational.with_labels(docs, labels, "doc_id")


@query("WITH c AS (SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS nation, count(*) AS n FROM supplier WHERE s_nationkey % 2 = 0 GROUP BY 1), r AS (SELECT n_nationkey + 3 AS nation, count(*) AS n FROM nation GROUP BY 1) SELECT nation, coalesce(c.n, 0) AS n_customers, coalesce(s.n, 0) AS n_suppliers, coalesce(r.n, 0) AS n_nations, concat_ws(',', CASE WHEN c.n IS NOT NULL THEN 'customers' END, CASE WHEN s.n IS NOT NULL THEN 'suppliers' END, CASE WHEN r.n IS NOT NULL THEN 'nations' END) AS kinds FROM c FULL JOIN s USING (nation) FULL JOIN r USING (nation)")
def source_index(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = read(spark, sf_dir, "supplier").filter("s_nationkey % 2 = 0").select(F.col("s_nationkey").alias("nation"))
    nations = read(spark, sf_dir, "nation").select((F.col("n_nationkey") + 3).alias("nation"))
    return relational.source_index(("customers", customers), ("suppliers", suppliers), ("nations", nations), key="nation")


@query("WITH a AS (SELECT l_orderkey AS record, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ids FROM lineitem GROUP BY 1), e AS (SELECT record, unnest(ids) AS id, generate_subscripts(ids, 1) AS p FROM a), m AS (SELECT record, CASE WHEN id % 10 = 1 THEN id - 1 ELSE id END AS v, min(p) AS p FROM e GROUP BY ALL) SELECT record, string_agg(v::VARCHAR, ',' ORDER BY p) AS ids FROM m GROUP BY record")
def rewritten_ids(spark, sf_dir):
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")))
    records = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("record")).agg(F.transform(ordered, lambda x: x["l_partkey"]).alias("ids"))
    canonical = read(spark, sf_dir, "part").filter("p_partkey % 10 = 1").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") - 1).alias("canonical"))
    return relational.rewritten(records, "record", "ids", canonical).withColumn("ids", F.array_join("ids", ","))


_TURNS = "t AS (SELECT conv_id, turn, list_filter(string_split(" + norm_sql("text") + ", ' '), lambda x: x <> '') AS w FROM conversations), g AS (SELECT conv_id, turn, CASE WHEN len(w) <= 2 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(len(w) - 1), lambda i: w[i + 1] || ' ' || w[i + 2])) END AS g FROM t)"


@query(f"WITH {_TURNS}, p AS (SELECT a.conv_id, a.turn, count(*) AS alike FROM g a JOIN g b ON a.conv_id = b.conv_id AND a.turn <> b.turn AND len(list_intersect(a.g, b.g)) > 0 AND len(list_intersect(a.g, b.g)) >= 0.02 * len(a.g) GROUP BY ALL) SELECT conv_id, turn, coalesce(alike, 0) AS alike FROM g LEFT JOIN p USING (conv_id, turn)")
def lookalike_counts(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations")
    return relational.lookalikes(turns, "conv_id", "turn", F.filter(text.tokens(F.col("text")), lambda w: w != ""), share=0.02)


@query("WITH v AS (SELECT vec_id, vec_id % 60 AS video_id, embedding::DOUBLE[] AS e FROM embeddings), s AS (SELECT a.video_id, a.vec_id AS caption_id, b.vec_id AS frame_id, list_inner_product(a.e, list_concat(b.e[2:], [b.e[1]])) + CASE WHEN a.vec_id = b.vec_id AND a.vec_id % 3 > 0 THEN 0.5 ELSE 0 END AS score FROM v a JOIN v b USING (video_id)), g AS (SELECT video_id, caption_id, max(score) FILTER (caption_id = frame_id) AS own, count(*) AS candidates FROM s GROUP BY ALL), o AS (SELECT video_id, caption_id, any_value(own) AS own, any_value(candidates) AS candidates, count(*) FILTER (score < own) / count(*) AS rank_fraction, any_value(own) - max(score) AS margin FROM s JOIN g USING (video_id, caption_id) WHERE caption_id <> frame_id GROUP BY ALL) SELECT video_id, caption_id, round(own, 6) AS own, candidates, rank_fraction, round(margin, 6) AS margin, CASE WHEN candidates < 4 THEN 'not_run' WHEN rank_fraction >= 0.75 AND margin >= -0.05 THEN 'passed' ELSE 'failed' END AS state FROM o")
def caption_alignment(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings").select("vec_id", (F.col("vec_id") % 60).alias("video_id"), F.col("embedding").cast("array<double>").alias("e"))
    frames = v.select("video_id", F.col("vec_id").alias("frame_id"), F.concat(F.slice("e", 2, 4096), F.slice("e", 1, 1)).alias("f"))
    captions = v.withColumnRenamed("vec_id", "caption_id").withColumn("bonus", F.when(F.col("caption_id") % 3 > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
    told = relational.aligned_vectors(captions, frames.withColumnRenamed("f", "e"), "video_id", "caption_id", "frame_id", "e", "bonus")
    return told.withColumn("own", F.round("own", 6)).withColumn("margin", F.round("margin", 6))


@query("WITH r AS (SELECT c_nationkey AS grp, CASE WHEN c_custkey % 40 = 0 THEN 'test' ELSE 'train' END AS split, 'customers' AS source FROM customer UNION ALL SELECT s_nationkey, 'train', 'suppliers' FROM supplier) SELECT grp, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM r GROUP BY grp HAVING count(DISTINCT split) > 1 AND count(DISTINCT source) > 1")
def split_conflicts(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("grp"), F.when(F.col("c_custkey") % 40 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"), F.lit("customers").alias("source"))
    b = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("grp"), F.lit("train").alias("split"), F.lit("suppliers").alias("source"))
    return relational.split_conflicts(a.unionByName(b), "grp", "split", "source").select("grp", F.array_join("splits", ",").alias("splits"), F.array_join("sources", ",").alias("sources"))


_CODED = f"{TIMELINE}, coded AS (SELECT video_id, event_id, event_type, start_time AS t, event_id * 2654435761 % 4294967296 AS code FROM timeline)"


@query(f"WITH {_CODED}, m AS (SELECT p.video_id, p.event_id AS point_id, f.event_id AS frame_id, bit_count(xor(p.code, f.code))::INT AS bits, abs(p.t - f.t) AS gap FROM coded p JOIN coded f ON p.video_id = f.video_id AND p.event_type = 'purchase' AND f.event_type = 'view' AND abs(p.t - f.t) <= 200000), r AS (SELECT *, row_number() OVER (PARTITION BY video_id, point_id ORDER BY bits, gap, frame_id) AS n FROM m) SELECT video_id, point_id, frame_id, bits, round(gap, 6) AS gap FROM r WHERE n = 1")
def boundary_location(spark, sf_dir):
    coded = timeline(spark, sf_dir).select("video_id", "event_id", "event_type", F.col("start_time").alias("t"), (F.col("event_id") * 2654435761 % 4294967296).alias("code"))
    points = coded.filter("event_type = 'purchase'").withColumnRenamed("event_id", "point_id")
    frames = coded.filter("event_type = 'view'").withColumnRenamed("event_id", "frame_id")
    return relational.near_boundary(points, frames, 200000.0).withColumn("gap", F.round("gap", 6))


@query(f"WITH {TIMELINE}, w AS (SELECT * FROM timeline WHERE event_type = 'signup'), j AS (SELECT w.video_id, w.event_id AS window_id, t.event_type AS txt FROM w LEFT JOIN timeline t ON t.video_id = w.video_id AND t.event_type IN ('view', 'click') AND t.start_time < w.end_time AND t.end_time > w.start_time) SELECT video_id, window_id, coalesce(array_to_string(list_sort(list(DISTINCT txt) FILTER (txt IS NOT NULL)), ','), '') AS texts FROM j GROUP BY ALL")
def window_texts(spark, sf_dir):
    events = timeline(spark, sf_dir)
    windows = events.filter("event_type = 'signup'").withColumnRenamed("event_id", "window_id")
    tracks = events.filter("event_type IN ('view', 'click')")
    met = temporal.interval_join(tracks, windows, width=36000.0).select("video_id", F.col("r_window_id").alias("window_id"), F.col("event_type").alias("text"))
    return relational.windowed_texts(windows, tracks, met).withColumn("texts", F.array_join("texts", ","))


_PLANTED = "base AS (SELECT vec_id, list_sum(list_transform(range(63), lambda i: CASE WHEN embedding[i + 1] > 0 THEN (1::UBIGINT << i)::HUGEINT ELSE 0 END)) + CASE WHEN embedding[64] > 0 THEN 9223372036854775808::HUGEINT ELSE 0 END AS code FROM embeddings), codes AS (SELECT vec_id, code::UBIGINT AS code FROM base UNION ALL SELECT vec_id + 1000000, xor(code::UBIGINT, (1::UBIGINT << (vec_id % 60)) | (1::UBIGINT << (vec_id % 7 + 1))) FROM base WHERE vec_id % 5 = 0 UNION ALL SELECT vec_id + 2000000, xor(code::UBIGINT, 14::UBIGINT) FROM base WHERE vec_id % 10 = 0)"
_NEAR = f"{_PLANTED}, near AS (SELECT a.vec_id AS a, b.vec_id AS b, bit_count(xor(a.code, b.code))::INT AS distance FROM codes a JOIN codes b ON a.vec_id < b.vec_id WHERE bit_count(xor(a.code, b.code)) <= 4)"


def _planted(spark, sf_dir):
    """Sign codes of the vectors, and copies of some with a few bits turned."""
    base = read(spark, sf_dir, "embeddings").select("vec_id", ids.sign_bits(F.col("embedding")).alias("code"))
    bit = lambda c: F.expr(f"shiftleft(1L, cast({c} as int))")
    near = base.filter("vec_id % 5 = 0").select((F.col("vec_id") + 1000000).alias("vec_id"), F.col("code").bitwiseXOR(bit("vec_id % 60").bitwiseOR(bit("vec_id % 7 + 1"))).alias("code"))
    more = base.filter("vec_id % 10 = 0").select((F.col("vec_id") + 2000000).alias("vec_id"), F.col("code").bitwiseXOR(F.lit(14).cast("bigint")).alias("code"))
    return base.unionByName(near).unionByName(more)


@query(f"WITH {_NEAR} SELECT a, b, distance FROM near")
def hamming_neighbours(spark, sf_dir):
    return dedup.hamming_pairs(_planted(spark, sf_dir), "vec_id", "code", distance=4)


@query(f"WITH RECURSIVE {_NEAR}, e AS (SELECT a, b FROM near UNION SELECT b, a FROM near), r AS (SELECT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a) SELECT node, min(reach) AS root FROM r GROUP BY node")
def duplicate_components(spark, sf_dir):
    return graph.connected_components(dedup.hamming_pairs(_planted(spark, sf_dir), "vec_id", "code", distance=4), "a", "b")


@query(f"WITH {_PLANTED}, l AS (SELECT vec_id % 1000000 AS v, vec_id // 1000000 AS kind, code FROM codes), lists AS (SELECT v * 10 + kind AS id, CASE WHEN v % 20 = 0 THEN [code, code] ELSE [code] END AS c FROM l) SELECT a.id AS a, b.id AS b FROM lists a JOIN lists b ON a.id < b.id AND len(a.c) = len(b.c) AND bit_count(xor(a.c[1], b.c[1])) <= 4")
def hash_list_duplicates(spark, sf_dir):
    v, kind = F.col("vec_id") % 1000000, F.floor(F.col("vec_id") / 1000000)
    lists = _planted(spark, sf_dir).select((v * 10 + kind).alias("id"), F.when(v % 20 == 0, F.array("code", "code")).otherwise(F.array("code")).alias("codes"))
    return dedup.hash_list_pairs(lists, "id", "codes")


_NEAR_VECTORS = "v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings UNION ALL SELECT vec_id + 1000000, list_concat([embedding[1]::DOUBLE + 0.2], embedding[2:]::DOUBLE[]) FROM embeddings WHERE vec_id % 5 = 0)"


@query(f"WITH {_NEAR_VECTORS} SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.e, b.e), 6) AS cosine FROM v a JOIN v b ON a.id < b.id WHERE list_cosine_similarity(a.e, b.e) >= 0.92")
def cosine_near_pairs(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("e"))
    moved = v.filter("id % 5 = 0").select((F.col("id") + 1000000).alias("id"), F.concat(F.array(F.get("e", 0) + 0.2), F.slice("e", 2, 4096)).alias("e"))
    return dedup.cosine_pairs(v.unionByName(moved), "id", "e").withColumn("cosine", F.round("cosine", 6))


_SETS = "sets AS (SELECT doc_id AS id, source, list_sort(list_distinct(list_filter(string_split(" + norm_sql("text") + ", ' '), lambda x: x <> ''))) AS s FROM documents)"


@query(f"WITH {_SETS}, c AS (SELECT s, source, min(id) AS id FROM sets WHERE len(s) >= 1 GROUP BY ALL), f AS (SELECT s, min(id) AS least FROM c GROUP BY s), near AS (SELECT a.least AS a, b.least AS b, len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) AS similarity FROM f a JOIN f b ON a.least < b.least AND least(len(a.s), len(b.s)) >= 0.8 * greatest(len(a.s), len(b.s))), told AS (SELECT * FROM near WHERE similarity >= 0.8 UNION ALL SELECT least, id, 1.0 FROM c JOIN f USING (s) WHERE id <> least) SELECT told.a, told.b, similarity FROM told JOIN c x ON told.a = x.id JOIN c y ON told.b = y.id WHERE x.source <> y.source")
def pairs_across_sources(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "documents")).select("doc_id", "source", F.filter(text.tokens(F.col("text")), lambda w: w != "").alias("words"))
    return dedup.pairs_across(docs, "doc_id", "words", "source", 0.8)


@query("SELECT 'part/' || l_partkey AS path, 'clip' AS kind, count(*) AS n, count(DISTINCT l_orderkey) AS videos FROM lineitem WHERE l_partkey % 9 <> 0 GROUP BY l_partkey")
def asset_registry(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("video_id"), F.lit("clip").alias("kind"), F.when(F.col("l_partkey") % 9 != 0, F.concat(F.lit("part/"), F.col("l_partkey").cast("string"))).alias("clip_path"))
    return release.asset_registry(lines, "clip_path").withColumnRenamed("references", "n")


@query(f"WITH {TIMELINE} SELECT video_id, event_id, row_number() OVER (PARTITION BY video_id ORDER BY start_time, end_time, event_type, event_id) - 1 AS position FROM timeline")
def timeline_order(spark, sf_dir):
    return relational.total_order(timeline(spark, sf_dir), ["start_time", "end_time", "event_type", "event_id"], "video_id").select("video_id", "event_id", F.col("position").cast("bigint").alias("position"))
