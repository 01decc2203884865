"""Sinks of whole releases: documents, task and benchmark folders, inventories, bundles, shards, target files."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, MapType, StructType

from .. import schema
from ..operators import release, reports, stats
from . import readers, writers


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and moved there: it is whole or it isn't."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    files = to.getFileSystem(conf)
    out = files.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files.delete(to, False)
    if not files.rename(beside, to):
        raise OSError(f"{path} could not be written")


def write_document(spark: SparkSession, path: str, document: dict) -> None:
    write_text(spark, path, json.dumps(document, sort_keys=True, indent=2) + "\n")


def as_json_schema(kind: DataType) -> dict:
    """A Spark type as JSON Schema; every value may be null."""
    if isinstance(kind, StructType):
        return {"type": ["object", "null"], "properties": {f.name: as_json_schema(f.dataType) for f in kind.fields}, "additionalProperties": False}
    if isinstance(kind, ArrayType):
        return {"type": ["array", "null"], "items": as_json_schema(kind.elementType)}
    if isinstance(kind, MapType):
        return {"type": ["object", "null"], "additionalProperties": as_json_schema(kind.valueType)}
    names = {IntegerType: "integer", LongType: "integer", DoubleType: "number", FloatType: "number", BooleanType: "boolean"}
    return {"type": [names.get(type(kind), "string"), "null"]}


def write_json_schema(spark: SparkSession, path: str, kind: str) -> None:
    """The schema of a record type as a JSON-Schema file."""
    told = as_json_schema(StructType.fromDDL(schema.SCHEMAS[kind]))
    write_document(spark, path, {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": kind, "version": schema.VERSION} | told | {"type": "object"})


def write_subsets(records: DataFrame, root: str, names: tuple[str, ...] = ("cinematic", "strict")) -> None:
    """A folder for each subset, with the records that are in it."""
    for name in names:
        records.filter(F.array_contains("subsets", name)).write.mode("overwrite").parquet(f"{root}/{name}")


def write_tasks(records: DataFrame, root: str, reasons: dict[str, Column], pairs: DataFrame | None = None, status: str = "status") -> None:
    """For each task its eligible records, and what kept the others out, counted by reason and status; pairs beside them."""
    spark = records.sparkSession
    for task, why in reasons.items():
        judged = records.withColumn("_why", why)
        judged.filter(F.size("_why") == 0).drop("_why").write.mode("overwrite").json(f"{root}/{task}")
        told = reports.exclusions(judged, "_why", status).collect()  # one row a reason and status
        write_document(spark, f"{root}/{task}.filters.json", {"task": task, "counts": [{"status": r[status], "reason": r["reason"], "n": r["n"]} for r in sorted(told, key=lambda r: (str(r[status]), r["reason"]))]})
    if pairs is not None:
        writers.write_jsonl(pairs, f"{root}/pairs")


def write_benchmark(items: DataFrame, root: str, metrics: dict[str, list[str]]) -> None:
    """A folder for each task's items, and a document of their metrics, sizes and frozen hashes."""
    spark = items.sparkSession
    items.write.mode("overwrite").partitionBy("task").json(f"{root}/items")
    told = {}
    for task, names in sorted(metrics.items()):
        row = stats.frozen_hash(items.filter(F.col("task") == task), "item_id").first()
        told[task] = {"metrics": names, "items": row["n"], "frozen": row["frozen"]}
    write_document(spark, f"{root}/benchmark.json", told)


def write_inventory(spark: SparkSession, root: str, without: tuple[str, ...] = ("inventory.json", "checksums.sha256")) -> DataFrame:
    """Sizes and checksums of a release's files, as inventory.json and checksums.sha256; returns (path, length, sha256), paths within the release."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.regexp_extract("path", r"^.*?" + Path(root).name + r"/(.*)$", 1).alias("path"), "length", F.sha2("content", 256).alias("sha256"))
    kept = found.filter(~F.col("path").isin(*without) & ~F.col("path").rlike(r"(^|/)[._]"))
    rows = kept.orderBy("path").collect()  # one row a file
    write_document(spark, f"{root}/inventory.json", {"files": [{"path": r["path"], "bytes": r["length"]} for r in rows], "n": len(rows), "bytes": sum(r["length"] for r in rows)})
    write_text(spark, f"{root}/checksums.sha256", "".join(f"{r['sha256']}  {r['path']}\n" for r in rows))
    return kept


def stated_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of a checksums file."""
    return spark.read.text(path).select(F.regexp_extract("value", r"^[0-9a-f]{64}  (.*)$", 1).alias("path"), F.substring("value", 1, 64).alias("sha256")).filter("path <> ''")


def bundle(folder: str, to: str) -> list[str]:
    """A zip of a local release's files, with names in order and one date, so that equal releases make equal bundles."""
    root = Path(folder)
    names = sorted(p.relative_to(root).as_posix() for p in root.rglob("*") if p.is_file() and not p.name.startswith((".", "_")))
    beside = Path(f"{to}.part")
    with zipfile.ZipFile(beside, "w", zipfile.ZIP_DEFLATED) as out:
        for name in names:
            out.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), (root / name).read_bytes(), zipfile.ZIP_DEFLATED)
    beside.rename(to)
    return names


def shard_plan(files: DataFrame, most_bytes: int, scope: str = "video_id") -> DataFrame:
    """(scope, bytes, shard): whole sources in order, a new shard where the next would pass a multiple of ``most_bytes``.

    The running sum is over one row a source.
    """
    sized = files.groupBy(scope).agg(F.sum("length").alias("bytes")).withColumn("_all", F.lit(1))
    before = F.coalesce(F.sum("bytes").over(Window.partitionBy("_all").orderBy(scope).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sized.withColumn("shard", F.floor(before / most_bytes)).drop("_all")


def write_ready_shards(records: DataFrame, plan: DataFrame, root: str, gate: DataFrame, scope: str = "video_id") -> int:
    """Shards of a plan as folders, if the gates let the release pass, each verified by its row count; returns the rows."""
    if release.release_status(gate).first()["status"] == "failed":
        raise ValueError("a gate failed: nothing is written")
    placed = records.join(plan.select(scope, "shard"), scope)
    placed.write.mode("overwrite").partitionBy("shard").parquet(root)
    wrote, meant = records.sparkSession.read.parquet(root).count(), placed.count()
    if wrote != meant:
        raise OSError(f"{wrote} of {meant} rows were written")
    return wrote


def write_media_metadata(records: DataFrame, root: str, path: str = "clip_path") -> None:
    """metadata rows next to the media: file_name within its folder and all else, one folder of rows for each folder of files."""
    named = records.filter(F.col(path).isNotNull()).withColumn("file_name", F.substring_index(path, "/", -1)).withColumn("folder", F.regexp_replace(path, r"/?[^/]*$", ""))
    named.drop(path).write.mode("overwrite").partitionBy("folder").json(root)


def write_target(records: DataFrame, root: str, misfits: Column, key: str = "record_id") -> dict[str, int]:
    """Records that fit a target, in order of their id, and how many were left out for each reason."""
    judged = records.withColumn("_why", misfits)
    judged.filter(F.size("_why") == 0).drop("_why").orderBy(key).write.mode("overwrite").json(f"{root}/records")
    skipped = {r["value"]: r["n"] for r in stats.code_counts(judged, "_why").collect()}  # one row a reason
    write_document(records.sparkSession, f"{root}/skipped.json", skipped)
    return skipped


def stage_splits(records: DataFrame, root: str, key: str = "record_id") -> None:
    """A folder of JSON lines for each split, and a manifest of their sizes."""
    records.orderBy("split", key).write.mode("overwrite").partitionBy("split").json(f"{root}/data")
    sizes = {r["split"]: r["n"] for r in records.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    write_document(records.sparkSession, f"{root}/manifest.json", {"splits": sizes})


def cached(known: DataFrame, asked: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """A provider's answers that are known for the asked keys, and the keys that aren't."""
    return known.join(asked.select(key).distinct(), key, "left_semi"), asked.join(known.select(key), key, "left_anti")


def read_split(spark: SparkSession, root: str, split: str, ddl: str, keep: Column | None = None) -> DataFrame:
    """One split of staged JSON lines, filtered by quality or task."""
    rows = readers.read_jsonl(spark, f"{root}/data/split={split}", ddl)
    return rows if keep is None else rows.filter(keep)
