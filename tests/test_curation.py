from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace import schema
from millrace.operators import agreement, curation, dedup, graph, policy, release, stats
from millrace.streaming import incremental


@pytest.mark.parametrize(("n", "kinds"), [(1, {"train"}), (2, {"train", "test"}), (3, {"train", "test", "validation"})])
def test_small_pools_fill_test_first(spark, n, kinds):
    groups = spark.createDataFrame([(f"vid_{i:03d}",) for i in range(n)], "g string")
    assert {r.split for r in curation.assign_splits(groups, "g").collect()} == kinds


def test_minimums_and_stability(spark):
    groups = spark.createDataFrame([(f"vid_{i:03d}",) for i in range(12)], "g string")
    cfg = curation.SplitConfig(min_test=3, min_validation=3)
    first = {r.g: r.split for r in curation.assign_splits(groups, "g", cfg).collect()}
    again = {r.g: r.split for r in curation.assign_splits(groups.orderBy(F.desc("g")), "g", cfg).collect()}
    assert first == again
    assert sorted(first.values()).count("test") == 3 and sorted(first.values()).count("validation") == 3


def test_threshold_status(spark):
    got = spark.createDataFrame([(None,), (0.8,), (0.6,), (0.2,)], "c double").select(policy.threshold_status(F.col("c")).alias("s")).collect()
    assert [r.s for r in got] == ["review", "accepted", "review", "rejected"]


def test_missing_check_is_never_a_pass(spark):
    rows = spark.createDataFrame([({"events_exist": "true"},), ({"events_exist": "true", "interval_semantics": "passed"},)], "c map<string,string>")
    told = rows.select(policy.decide("relation", F.col("c"), F.array().cast("array<string>"), F.lit("accepted")).alias("d")).collect()
    assert [(r.d.status, r.d.reasons) for r in told] == [("review", ["missing_check:interval_semantics"]), ("accepted", [])]


def test_export_downgrades_but_not_humans(spark):
    args = [(None, "passed", None), ("p1", None, None), ("p1", "passed", None), (None, None, "human")]
    rows = spark.createDataFrame([("accepted", *a) for a in args], "s string, p string, b string, m string")
    assert [r[0] for r in rows.select(policy.enforced(*[F.col(c) for c in "spbm"])).collect()] == ["review", "review", "accepted", "accepted"]


def test_tier_and_cap(spark):
    none = F.lit(None)
    told = curation.tier(F.lit("accepted"), F.lit(0.9), F.lit(0.9), F.lit("human"), F.array(F.lit("grounding")))
    low = curation.tier(F.lit("accepted"), F.lit(0.9), none.cast("double"), none.cast("string"), F.array(F.lit("grounding")))
    row = spark.range(1).select(told.alias("a"), low.alias("b"), curation.cap_tier(told, "silver", F.lit(True), "flagged").alias("c")).first()
    assert row.a.tier == "gold" and row.b.tier == "silver" and row.b.reasons == ["confidence_unavailable"] and (row.c.tier, row.c.reasons) == ("silver", ["flagged"])


def test_kappa_of_a_known_table(spark):
    pairs = spark.createDataFrame([("y", "y")] * 20 + [("y", "n")] * 5 + [("n", "y")] * 10 + [("n", "n")] * 15, "a string, b string")
    row = agreement.cohens_kappa(pairs, "a", "b").first()
    assert (round(row.agreement, 4), round(row.kappa, 4)) == (0.7, 0.4)
    assert agreement.cohens_kappa(spark.createDataFrame([("y", "y")] * 3, "a string, b string"), "a", "b").first().kappa == 1.0


def test_sample_sizes():
    assert [agreement.sample_size(n) for n in (100000, 500, 50, 10)] == [383, 218, 45, 10]


def test_sample_covers_strata_and_repeats(spark):
    rows = spark.createDataFrame([(f"r{i}", "abc"[i % 3] if i % 7 else "rare", f"v{i % 8}") for i in range(70)], "record_id string, s string, video_id string")
    draw = lambda **k: sorted((r.record_id, tuple(r.assigned_to)) for r in agreement.stratified_sample(rows, "s", "record_id", 25, **k).collect())
    assert draw() == draw() and len(draw()) == 25
    assert len(draw(scope="video_id", cap=2)) == 16


def test_places_are_in_proportion(spark):
    import random

    rng = random.Random(3)
    for _ in range(6):
        sizes = {k: rng.randint(0, 60) for k in "abcdefg"[: rng.randint(1, 7)]}
        n, total = rng.randint(0, 90), sum(sizes.values())
        got = {r.s: r.places for r in agreement.allocate(spark.createDataFrame(list(sizes.items()), "s string, n long"), "s", n).collect()}
        full = [k for k in sizes if sizes[k]]
        assert sum(got.values()) == min(n, total) and all(got[k] <= sizes[k] for k in got)
        if full and n >= len(full):
            assert set(got) == set(full)
            free = [k for k in full if min(n, total) * sizes[k] / total >= 1]
            assert all(got[k] - min(n, total) * sizes[k] / total < 1 for k in free)


def test_vectors_against_all_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    v = rng.normal(size=(60, 8))
    v[30:40] = v[:10] + rng.normal(size=(10, 8)) * 0.05
    v[41], v[42] = v[40], 0
    rows = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(60)], "id long, v array<double>").repartition(3)
    unit = np.nan_to_num(v / np.sqrt((v * v).sum(1, keepdims=True)))
    cosine = unit @ unit.T
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if cosine[i, j] >= 0.92}
    assert {(r.a, r.b) for r in dedup.cosine_pairs(rows, "id", "v", 0.92, block=7).collect()} == want and len(want) > 9
    best = {(r["query"], r["rank"]): r["id"] for r in dedup.nearest_vectors(rows.filter("id % 20 = 0"), rows, "id", "v", 3, block=2).collect()}
    for q in (0, 20, 40):
        order = sorted((k for k in range(60) if k not in (q, 42)), key=lambda k: (-cosine[q, k], k))
        assert [best[q, r] for r in (1, 2, 3)] == order[:3]


def test_hash_lists_agree_at_every_place(spark):
    rows = spark.createDataFrame([(1, [0, 255]), (2, [1, 254]), (3, [1, 0]), (4, [1]), (5, []), (6, [0, 255, 7])], "id long, codes array<bigint>")
    assert [(r.a, r.b) for r in dedup.hash_list_pairs(rows, "id", "codes").collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        dedup.hamming_pairs(rows.withColumn("c", F.get("codes", 0)), "id", "c", 12)


def test_adjudication(spark):
    reviews = spark.createDataFrame([("r1", "a", "accept"), ("r1", "b", "accept"), ("r2", "a", "accept"), ("r2", "b", "reject"), ("r3", "a", "reject")], "record_id string, reviewer string, label string")
    decisions = spark.createDataFrame([("r2", "reject"), ("r9", "accept")], "record_id string, label string")
    got = {r.record_id: (r.label, r.reviewer) for r in agreement.adjudicate(reviews, decisions).collect()}
    assert got == {"r1": ("accept", "consensus"), "r2": ("reject", "adjudicated"), "r3": ("reject", "a"), "r9": ("accept", "adjudicated")}


def test_components_and_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "src long, dst long")
    got = {r.node: r.root for r in graph.connected_components(edges).collect()}
    assert set(got.values()) == {0, 100} and got[40] == 0
    chain = spark.createDataFrame([(3, 2), (2, 1), (5, 5)], "id long, canonical long")
    assert {(r.id, r.canonical) for r in dedup.resolve_chains(chain).collect()} == {(3, 1), (2, 1)}


def test_set_similarity_against_all_pairs(spark):
    import random

    random.seed(3)
    sets = [(i, [f"w{random.randrange(12)}" for _ in range(random.randint(1, 9))]) for i in range(60)]
    got = {(r.a, r.b) for r in dedup.set_similarity_join(spark.createDataFrame(sets, "id long, s array<string>"), "id", "s", 0.6).collect()}
    least: dict = {}
    for i, s in sets:
        least.setdefault(frozenset(s), i)
    want = {(least[frozenset(s)], i) for i, s in sets if least[frozenset(s)] != i}
    reps = [(i, s) for s, i in least.items()]
    want |= {(min(i, j), max(i, j)) for i, s in reps for j, t in reps if i < j and len(s & t) / len(s | t) >= 0.6}
    assert got == want


@pytest.mark.parametrize(("crowd", "together", "sent"), [(32, 1024, 500_000), (2, 3, 500_000), (3, 2, 0)])
def test_set_similarity_of_near_copies(spark, monkeypatch, crowd, together, sent):
    import random

    for name, value in (("CROWD", crowd), ("TOGETHER", together), ("SENT", sent)):
        monkeypatch.setattr(dedup, name, value)
    rng = random.Random(7)
    rows = []
    for group in range(4):
        base = [f"g{group}w{k}" for k in range(40)] + [f"c{k}" for k in range(10)]
        for _ in range(14):
            words = [w for w in base if rng.random() > 0.06] + [f"own{rng.randrange(60)}" for _ in range(rng.randrange(4))]
            rows.append((len(rows), words, "ab"[len(rows) % 2]))
        rows.append((len(rows), rows[-1][1], "a"))
    docs = spark.createDataFrame(rows, "id long, w array<string>, source string")
    sets = {i: frozenset(w) for i, w, _ in rows}
    least: dict = {}
    for i, s in sets.items():
        least.setdefault(s, i)
    near = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    want = {(i, j): near(i, j) for i in least.values() for j in least.values() if i < j and near(i, j) >= 0.8} | {(least[s], i): 1.0 for i, s in sets.items() if least[s] != i}
    got = dedup.set_similarity_join(docs, "id", "w", 0.8)
    assert len(want) > 50
    told = got.collect()
    assert len(told) == len(want) and {(r.a, r.b): r.similarity for r in told} == want
    across = dedup.pairs_across(docs, "id", "w", "source", 0.8).collect()
    assert {(r.a, r.b) for r in across} == {(a, b) for a, b in want if rows[a][2] != rows[b][2]}


@pytest.mark.parametrize("few", [1, 2, 32])
def test_minhash_links_all_near_members_of_a_bucket(spark, few):
    import random

    random.seed(5)
    word = lambda n: [f"w{random.randrange(1000)}" for _ in range(n)]
    head, rows = word(30), []
    for group in range(6):
        tail = word(25)
        for _ in range(8):
            tail[random.randrange(25)] = f"x{random.randrange(1000)}"
            rows.append((len(rows), head + tail))
        rows.append((len(rows), rows[-1][1]))
    docs = spark.createDataFrame(rows, "id long, w array<string>")
    got = dedup.minhash_join(docs, "id", F.col("w"), 0.8, rows=1, bands=1, few=few).collect()
    least = {r.id: r.g[0] for r in docs.select("id", dedup.minhash(F.col("w"), rows=1).alias("g")).collect()}
    sets = {i: frozenset(zip(w, w[1:], w[2:], strict=False)) for i, w in rows}
    rep: dict = {}
    for i, s in sets.items():
        rep.setdefault(s, i)
    near = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    want = {(rep[s], i): 1.0 for i, s in sets.items() if rep[s] != i}
    want |= {(i, j): near(i, j) for i in rep.values() for j in rep.values() if i < j and least[i] == least[j] and near(i, j) >= 0.8}
    first = {g: min(i for i in least if least[i] == g) for g in least.values()}
    assert any(max(near(first[least[i]], i), near(first[least[j]], j)) < 0.8 for i, j in want)
    assert len(got) == len(want) and {(r.a, r.b): r.similarity for r in got} == want


def test_timed_and_question_duplicates(spark):
    items = spark.createDataFrame([("v", "a", "A red car.", 0.0, 3.0), ("v", "b", "a red car", 0.1, 3.1), ("v", "c", "a red car", 50.0, 53.0)], "video_id string, id string, text string, start_time double, end_time double")
    assert [(r.id, r.canonical) for r in dedup.timed_duplicates(items).collect()] == [("b", "a")]


def test_timed_duplicates_of_near_texts(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [("v", "a", long, 0.0, 4.0), ("v", "b", long + " more", 0.2, 4.0), ("v", "c", long + " more", 60.0, 64.0), ("v", "d", "another text altogether", 0.1, 4.0), ("u", "e", long + " more", 0.2, 4.0), ("v", "f", "", 9.0, 9.5), ("v", "g", "...", 9.0, 9.6)]
    items = spark.createDataFrame(rows, "video_id string, id string, text string, start_time double, end_time double")
    told = lambda **k: sorted((r.id, r.canonical) for r in dedup.timed_duplicates(items, **k).collect())
    assert told() == [("b", "a"), ("g", "f")]
    assert told(require_overlap=False) == [("b", "a"), ("c", "a"), ("g", "f")]
    assert told(threshold=0.99) == [("g", "f")]


def test_diff_merge_and_upsert(spark):
    old = spark.createDataFrame([("a", "v1", 1), ("b", "v1", 2), ("c", "v2", 3)], "record_id string, video_id string, x int")
    new = spark.createDataFrame([("a", "v1", 9), ("d", "v3", 4)], "record_id string, video_id string, x int")
    assert {(r.record_id, r.change) for r in release.diff(old, new, "record_id", ["x"]).collect()} == {("a", "changed"), ("b", "removed"), ("c", "removed"), ("d", "added")}
    assert sorted(r.record_id for r in release.merge_release(old, new).collect()) == ["a", "c", "d"]
    patch = spark.createDataFrame([("a", None, 7)], "record_id string, video_id string, x int")
    assert {r.record_id: (r.video_id, r.x) for r in release.upsert(old, patch, "record_id").collect()}["a"] == ("v1", 7)


def test_gates_fail_closed(spark):
    bad, good = spark.range(3), spark.range(0)
    told = release.gates(bad=bad, good=good)
    assert {(r.gate, r.state, r.n) for r in told.collect()} == {("bad", "failed", 3), ("good", "passed", 0)}
    assert release.release_status(told).first().status == "failed"


def test_migration_keeps_every_row(spark):
    rows = spark.createDataFrame([("a", None, 1.0, "odd"), ("b", "9.0.0", 2.0, None)], "id string, schema_version string, start double, extra string")
    got = schema.migrate(rows.withColumn("record_id", F.col("id")), ["record_id", "start_time"]).collect()
    assert [(r.record_id, r.schema_version, r.extensions) for r in got] == [("a", schema.VERSION, {"extra": "odd"}), ("b", "9.0.0", {})]
    assert schema.path("2.0.0") == ["2.1.0", "2.2.0", "2.3.0"]


def test_index_quantiles(spark):
    rows = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "v double")
    row = stats.index_quantiles(rows, "v", [0.5, 1.0]).first()
    assert (row.q50, row.q100, row.n, row["mean"]) == (3.0, 4.0, 4, 2.5)


def test_ingest_and_job_states(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 4)], "k string, v int")
    assert {(r.k, r.change) for r in incremental.ingest(incremental.hashed(a, "k"), b, "k").collect()} == {("x", "unchanged"), ("y", "changed"), ("z", "new")}
    events = spark.createDataFrame([("x", 1, "acquired"), ("x", 2, "failed"), ("y", 1, "failed"), ("y", 2, "acquired")], "source_id string, seq int, state string")
    jobs = spark.createDataFrame([("x",), ("y",), ("z",)], "source_id string")
    assert {r.source_id: (r.state, r.error) for r in incremental.advance(jobs, events).collect()} == {"x": ("acquired", "failed"), "y": ("acquired", None), "z": ("registered", None)}


def test_batches_are_numbered_across_ranges(spark):
    from millrace.operators import factory

    rows = spark.createDataFrame([(i % 37, i) for i in range(300)], "k long, id long").repartition(7)
    got = {r.id: r.place for r in factory.numbered(rows, ["k", "id"], "place").collect()}
    assert got == {i: n for n, (_, i) in enumerate(sorted((i % 37, i) for i in range(300)))}
    assert factory.numbered(rows.limit(0), ["k"], "place").count() == 0
    drawn = factory.drawn_batches(rows.select(F.lit("t").alias("task"), "id"), "task", "id", {"t": 1.0}, {"t": 7})
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and sorted({r.turn for r in drawn.collect()}) == list(range(1, 44))


def test_words_of_lookalikes_are_made_once(spark):
    from millrace.plans import QUERIES

    plan = QUERIES["lookalike_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "regexp_replace" in line]
    assert made and all("Generate" in line or "Project" in line and "transform" not in line for line in made)


def test_cosine_blocks_are_few(spark):
    rows = spark.createDataFrame([(i, [float((i * 7 + k * k) % 11 - 5) for k in range(4)]) for i in range(1500)], "id long, v array<double>")
    plan = dedup.cosine_pairs(rows, "id", "v", 0.999)
    assert {(r.a, r.b) for r in plan.select("a", "b").distinct().collect()} == {(r.a, r.b) for r in dedup.cosine_pairs(rows, "id", "v", 0.999, block=100).collect()}


@pytest.mark.parametrize("block", [3, 2048])
def test_alignment_by_blocks_equals_scores(spark, block):
    from millrace.operators import relational

    rows = [(i % 2, i, [float((i * k * k) % 7 - 3) / 3 for k in range(1, 6)] if i % 5 else [0.1, 0.7, 0.3, 0.2, 0.9]) for i in range(30)]
    v = spark.createDataFrame(rows, "s long, c long, v array<double>")
    captions, frames = v.withColumn("bonus", F.when(F.col("c") % 3 > 0, 0.5).otherwise(0.0)), v.withColumnRenamed("c", "f").filter("f <> 7")
    dot = F.aggregate(F.zip_with("v", "w", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    scores = captions.join(frames.select("s", "f", F.col("v").alias("w")), "s").select("s", "c", "f", (dot + F.when(F.col("c") == F.col("f"), F.col("bonus")).otherwise(0.0)).alias("x"))
    want = relational.aligned(scores, "s", "c", "f", "x")
    got = relational.aligned_vectors(captions, frames, "s", "c", "f", "v", "bonus", block=block).select(want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
