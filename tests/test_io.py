from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import ids, text
from millrace.functions.reasons import reasons
from millrace.sources import exports, readers, writers
from millrace.streaming import incremental


def test_typed_tables_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("r1", "v1", 1.0, 2.0)], "record_id string, video_id string, start_time double, end_time double")
    writers.write_typed(rows, "events", f"{tmp_path}/events.parquet")
    writers.write_typed(rows.limit(0), "clips", f"{tmp_path}/clips.parquet")
    tables = readers.read_all(spark, str(tmp_path))
    assert tables["events"].first().record_id == "r1" and tables["clips"].count() == 0 and set(tables) == set(schema.RECORD_TYPES)


def test_jsonl_fails_on_bad_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert readers.read_jsonl(spark, f"{tmp_path}/x.jsonl", "a int").count() == 2
    (tmp_path / "y.jsonl").write_text("{oops\n")
    with pytest.raises(Exception, match="(?i)malformed|fail"):
        readers.read_jsonl(spark, f"{tmp_path}/y.jsonl", "a int").collect()


def test_inputs_keep_first_and_drop_comments(spark, tmp_path):
    (tmp_path / "in.txt").write_text("# list\nhttp://b/x\nhttp://a/y  # note\n\nhttp://b/x\n")
    assert [r.input for r in readers.read_inputs(spark, f"{tmp_path}/in.txt").collect()] == ["http://b/x", "http://a/y"]


def test_checksums_tell_changes(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"1")
    (tmp_path / "b.bin").write_bytes(b"2")
    stated = spark.createDataFrame(readers.inventory(spark, f"{tmp_path}/*.bin").collect())
    (tmp_path / "a.bin").write_bytes(b"3")
    (tmp_path / "b.bin").unlink()
    assert sorted(r.fault for r in readers.stale_checksums(readers.inventory(spark, f"{tmp_path}/*.bin"), stated).collect()) == ["changed", "missing"]


def test_promote_refuses_to_replace(spark, tmp_path):
    writers.write_shards(spark.range(10).repartition(1), f"{tmp_path}/staged", 4)
    writers.promote(spark, f"{tmp_path}/staged", f"{tmp_path}/final")
    assert spark.read.parquet(f"{tmp_path}/final").count() == 10
    with pytest.raises(FileExistsError):
        writers.promote(spark, f"{tmp_path}/final", f"{tmp_path}/final")


def test_stream_upserts_count_once(spark, tmp_path):
    src, table, ddl = f"{tmp_path}/src", f"{tmp_path}/table", "k string, v int, at int"
    batches = [[("a", 1, 1), ("b", 2, 1), ("b", 9, 0)], [("a", 5, 2), ("c", 3, 1)], [("a", 7, 1)]]
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(src)
        incremental.stream_upserts(spark.readStream.schema(ddl).parquet(src), table, "k", f"{tmp_path}/ck", "at", parts=4).awaitTermination()
    want = {("a", 5, 2), ("b", 2, 1), ("c", 3, 1)}
    assert {(r.k, r.v, r["at"]) for r in incremental.upserted(spark, table).collect()} == want
    # Another checkpoint starts from its first batch, but not without the table's past.
    other = f"{tmp_path}/other"
    spark.createDataFrame([("d", 4, 1)], ddl).write.parquet(other)
    for _ in range(2):
        incremental.stream_upserts(spark.readStream.schema(ddl).parquet(other), table, "k", f"{tmp_path}/ck2", "at", parts=4).awaitTermination()
    assert {(r.k, r.v, r["at"]) for r in incremental.upserted(spark, table).collect()} == want | {("d", 4, 1)}


def test_shards_go_by_number(spark, tmp_path):
    for n, folder in ((9, "shard_9"), (10, "shard_10"), (11, "uploaded/shard_11")):
        rows = [("r", str(n)), (f"only{n}", str(n))]
        writers.write_typed(spark.createDataFrame(rows, "record_id string, video_id string"), "events", f"{tmp_path}/{folder}/events.parquet")
    got = {r.record_id: r.video_id for r in readers.read_shards(spark, str(tmp_path), "events").collect()}
    assert got == {"r": "11", "only9": "9", "only10": "10", "only11": "11"}
    assert readers.read_shards(spark, str(tmp_path), "clips").count() == 0
    counts = readers.footer_counts(spark, f"{tmp_path}/shard_*/events.parquet").agg(F.sum("rows")).first()[0]
    assert counts == 4


def test_only_finished_videos_are_read(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "events.jsonl").write_text(f'{{"record_id": "{name}"}}\n')
    (tmp_path / "a" / "manifest.json").write_text("{}")
    assert [r.record_id for r in readers.read_videos(spark, str(tmp_path), "events").collect()] == ["a"]


def test_labels_and_inputs_of_each_form(spark, tmp_path):
    (tmp_path / "l.csv").write_text("record_id,label\nr1,Yes\nr2,maybe\nr3,0\n")
    (tmp_path / "l.jsonl").write_text('{"record_id": "r1", "label": "accept"}\n')
    (tmp_path / "c.csv").write_text("record_id,label\nr1,Pan Left\nr2,\n")
    (tmp_path / "in.csv").write_text('url,title\n"http://a/x, y",t\nhttp://b,u\nhttp://b,v\n')
    (tmp_path / "dir").mkdir()
    (tmp_path / "dir" / "b.mp4").write_text("1")
    (tmp_path / "dir" / "a.mp4").write_text("2")
    assert [(r.record_id, r.label) for r in readers.read_labels(spark, f"{tmp_path}/l.csv").collect()] == [("r1", True), ("r3", False)]
    assert readers.read_labels(spark, f"{tmp_path}/l.jsonl").first().label is True
    assert [tuple(r) for r in readers.read_camera_labels(spark, f"{tmp_path}/c.csv").collect()] == [("r1", "pan_left")]
    assert [r.input for r in readers.read_inputs(spark, f"{tmp_path}/in.csv").collect()] == ["http://a/x, y", "http://b"]
    assert [r.input.rsplit("/", 1)[1] for r in readers.read_inputs(spark, f"{tmp_path}/dir").collect()] == ["a.mp4", "b.mp4"]
    assert [r.path.rsplit("/", 1)[1] for r in readers.listed(spark, str(tmp_path), without=("dir", "l.csv", "l.jsonl")).collect()] == ["c.csv", "in.csv"]


def test_text_functions(spark):
    row = spark.range(1).select(
        text.normalize_text(F.lit("  Héllo,  WORLD! 5% it's ")).alias("n"),
        text.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("j"),
        text.hash_jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("h"),
        text.about(F.lit(6.2)).alias("a"),
        text.clock(F.lit(3725.0)).alias("c"),
        text.joined_and(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("and"),
        ids.hamming(F.lit("ffffffffffffffff"), F.lit("0fffffffffffffff")).alias("d"),
        ids.hamming(F.lit("ff"), F.lit("0fffffffffffffff")).alias("e"),
    ).first()
    assert (row.n, row.j, row.h, row.a, row.c, row["and"], row.d, row.e) == ("héllo world 5% it's", 1.0, 0.0, "about 6 seconds", "1:02:05", "a, b and c", 4, 64)


def test_json_schema_and_documents(spark, tmp_path):
    exports.write_json_schema(spark, f"{tmp_path}/events.json", "events")
    told = json.loads((tmp_path / "events.json").read_text())
    assert told["type"] == "object" and told["properties"]["start_time"] == {"type": ["number", "null"]} and told["properties"]["entities"]["items"] == {"type": ["string", "null"]}
    exports.write_document(spark, f"{tmp_path}/events.json", {"a": 1})
    assert json.loads((tmp_path / "events.json").read_text()) == {"a": 1} and not list(tmp_path.glob("*.part"))


def test_task_benchmark_and_target_folders(spark, tmp_path):
    rows = spark.createDataFrame([(f"r{i}", "accepted" if i % 3 else "review", ["cinematic"] if i % 2 else [], f"clips/{i % 2}/{i}.mp4", "train" if i % 4 else "test", float(i)) for i in range(12)], "record_id string, status string, subsets array<string>, clip_path string, split string, duration double")
    why = reasons((F.col("status") != "accepted", "status"), (F.col("duration") > 8, "too_long"))
    exports.write_tasks(rows, f"{tmp_path}/tasks", {"t2v": why}, rows.select("record_id"))
    counts = json.loads((tmp_path / "tasks" / "t2v.filters.json").read_text())["counts"]
    assert sum(c["n"] for c in counts if c["reason"] == "selected") == spark.read.json(f"{tmp_path}/tasks/t2v").count() == 6
    assert spark.read.json(f"{tmp_path}/tasks/pairs").count() == 12
    exports.write_subsets(rows, str(tmp_path), ("cinematic",))
    assert spark.read.parquet(f"{tmp_path}/cinematic").count() == 6
    skipped = exports.write_target(rows, f"{tmp_path}/target", why)
    assert skipped == {"status": 4, "too_long": 3} and [r.record_id for r in spark.read.json(f"{tmp_path}/target/records").orderBy("record_id").collect()] == sorted(f"r{i}" for i in (1, 2, 4, 5, 7, 8))
    items = rows.select(F.col("record_id").alias("item_id"), F.lit("captioning").alias("task"))
    exports.write_benchmark(items, f"{tmp_path}/bench", {"captioning": ["cider"]})
    told = json.loads((tmp_path / "bench" / "benchmark.json").read_text())["captioning"]
    assert told["items"] == 12 and told["frozen"] == hashlib.sha256("\n".join(sorted(f"r{i}" for i in range(12))).encode()).hexdigest()
    exports.stage_splits(rows, f"{tmp_path}/staged")
    assert json.loads((tmp_path / "staged" / "manifest.json").read_text()) == {"splits": {"train": 9, "test": 3}}
    assert exports.read_split(spark, f"{tmp_path}/staged", "train", "record_id string, status string", F.col("status") == "accepted").count() == 6
    exports.write_media_metadata(rows, f"{tmp_path}/media")
    assert {r.folder: r.n for r in spark.read.json(f"{tmp_path}/media").groupBy("folder").agg(F.count(F.lit(1)).alias("n")).collect()} == {"clips/0": 6, "clips/1": 6}


def test_inventories_shards_bundles_and_caches(spark, tmp_path):
    root = tmp_path / "rel"
    (root / "a").mkdir(parents=True)
    (root / "a" / "x.txt").write_text("x" * 10)
    (root / "y.txt").write_text("y")
    found = exports.write_inventory(spark, str(root))
    stated = exports.stated_checksums(spark, f"{root}/checksums.sha256")
    assert sorted(r.path for r in stated.collect()) == ["a/x.txt", "y.txt"] and readers.stale_checksums(found, stated).count() == 0
    assert json.loads((root / "inventory.json").read_text())["bytes"] == 11
    names = exports.bundle(str(root), f"{tmp_path}/one.zip")
    exports.bundle(str(root), f"{tmp_path}/two.zip")
    assert names == ["a/x.txt", "checksums.sha256", "inventory.json", "y.txt"] and (tmp_path / "one.zip").read_bytes() == (tmp_path / "two.zip").read_bytes()
    files = spark.createDataFrame([("v1", 60), ("v1", 30), ("v2", 50), ("v3", 20), ("v4", 90)], "video_id string, length long")
    plan = exports.shard_plan(files, 100)
    assert {r.video_id: r.shard for r in plan.collect()} == {"v1": 0, "v2": 0, "v3": 1, "v4": 1}
    passed = spark.createDataFrame([("g", "passed", 0)], "gate string, state string, n long")
    assert exports.write_ready_shards(files, plan, f"{tmp_path}/shards", passed) == 5
    with pytest.raises(ValueError):
        exports.write_ready_shards(files, plan, f"{tmp_path}/shards", passed.withColumn("state", F.lit("failed")))
    known, missing = exports.cached(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), spark.createDataFrame([("b",), ("c",)], "k string"), "k")
    assert [r.k for r in known.collect()] == ["b"] and [r.k for r in missing.collect()] == ["c"]
