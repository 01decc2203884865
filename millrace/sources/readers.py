"""Sources: record exports, shards, labels, manifests and inputs, all by Spark's own readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema


def read_jsonl(spark: SparkSession, path: str | list[str], ddl: str, tolerant: bool = False) -> DataFrame:
    """Objects, one a line, by a stated schema; blank lines are skipped and bad JSON fails, unless tolerant."""
    return spark.read.schema(ddl).option("mode", "PERMISSIVE" if tolerant else "FAILFAST").json(path)


def read_document(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).option("multiLine", True).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob has a match, by Hadoop's file systems."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return bool(found)


def read_records(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """One record type of an export: Parquet before JSON lines, the root before per-video folders, else empty."""
    for path, parquet in ((f"{root}/{kind}.parquet", True), (f"{root}/{kind}.jsonl", False), (f"{root}/per_video/*/{kind}.jsonl", False)):
        if exists(spark, path):
            return spark.read.schema(schema.SCHEMAS[kind]).parquet(path) if parquet else read_jsonl(spark, path, schema.SCHEMAS[kind])
    return spark.createDataFrame([], schema.SCHEMAS[kind])


def read_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {kind: read_records(spark, root, kind) for kind in schema.RECORD_TYPES}


def read_combined(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One type out of a combined stream tagged ``record_type``."""
    return read_jsonl(spark, path, schema.SCHEMAS[kind]).filter(F.col("record_type") == kind)


def shard_roots(spark: SparkSession, root: str) -> list[str]:
    """Globs of a collection's shards, uploaded ones too, that match something."""
    return [g for g in (f"{root}/shard_*", f"{root}/uploaded/shard_*") if exists(spark, g)]


def read_shards(spark: SparkSession, root: str, kind: str, key: str = "record_id") -> DataFrame:
    """All shards of one type; of one id the copy of the shard of the highest number, of equal ones the last path."""
    globs = [f"{g}/{kind}.parquet" for g in shard_roots(spark, root)]
    globs = [g for g in globs if exists(spark, g)]
    if not globs:
        return spark.createDataFrame([], schema.SCHEMAS[kind])
    rows = spark.read.schema(schema.SCHEMAS[kind]).parquet(*globs).withColumn("_shard", F.input_file_name())
    number = F.regexp_extract("_shard", r"shard_(\d+)", 1).try_cast("bigint")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(number.desc_nulls_last(), F.col("_shard").desc()))).filter("_n = 1").drop("_n", "_shard")


def read_videos(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """One record type of the finished videos of a run: per-video folders that hold a manifest."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]+$", 1)
    if not exists(spark, f"{root}/*/{kind}.jsonl"):
        return spark.createDataFrame([], schema.SCHEMAS[kind])
    rows = read_jsonl(spark, f"{root}/*/{kind}.jsonl", schema.SCHEMAS[kind]).withColumn("_folder", folder)
    done = spark.read.format("binaryFile").load(f"{root}/*/manifest.json").select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("_folder")) if exists(spark, f"{root}/*/manifest.json") else rows.select("_folder").limit(0)
    return rows.join(done, "_folder", "left_semi").select(*[f.name for f in rows.schema if f.name != "_folder"])


def footer_counts(spark: SparkSession, glob: str) -> DataFrame:
    """(path, rows, columns) of Parquet files; the rows are those of the footers, no column is read."""
    told = spark.read.parquet(glob)
    return told.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(told.columns)))


def listed(spark: SparkSession, glob: str, without: tuple[str, ...] = ()) -> DataFrame:
    """(path, length) of files, sorted by path, but those of which a part of the path is in ``without``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(glob).select("path", "length")
    return files.filter(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, without)))).orderBy("path") if without else files.orderBy("path")


def tolerant_boolean(value: Column) -> Column:
    v = F.lower(F.trim(value.cast("string")))
    return F.when(v.isin("1", "true", "yes", "y", "accept", "correct"), True).when(v.isin("0", "false", "no", "n", "reject"), False)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, label) from a CSV with a header or from JSON lines; unreadable labels are dropped."""
    ddl = "record_id string, label string"
    rows = read_jsonl(spark, path, ddl, tolerant=True) if path.endswith((".jsonl", ".json")) else spark.read.option("header", True).option("enforceSchema", False).csv(path).select("record_id", "label")
    return rows.select("record_id", tolerant_boolean(F.col("label")).alias("label")).dropna()


def read_camera_labels(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, label) of camera movements: words in lower case, blanks as underscores; empty ones are dropped."""
    rows = read_jsonl(spark, path, "record_id string, label string", tolerant=True) if path.endswith((".jsonl", ".json")) else spark.read.option("header", True).csv(path).select("record_id", "label")
    word = F.regexp_replace(F.lower(F.trim("label")), r"[\s-]+", "_")
    return rows.select("record_id", word.alias("label")).filter("record_id IS NOT NULL AND label <> ''")


def read_inputs(spark: SparkSession, path: str) -> DataFrame:
    """Distinct inputs, in order of where each stands first.

    A folder gives its files; a CSV its first column, without a header that names it; any other
    file its lines, in which # starts a comment.
    """
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(files).isDirectory():
        return listed(spark, path).select(F.col("path").alias("input"))
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    if path.endswith(".csv"):
        cell = F.trim(F.from_csv(F.col("value"), F.lit("c string"))["c"])
        told = lines.withColumn("input", cell).filter(~((F.col("line") == 0) & F.lower("input").isin("url", "input", "video", "path", "link")))
    else:
        told = lines.withColumn("input", F.trim(F.regexp_replace("value", r"(^|\s)#.*$", "")))
    return told.filter("input <> ''").groupBy("input").agg(F.min("line").alias("line")).orderBy("line").select("input")


def last_of_each(rows: DataFrame, key: str) -> DataFrame:
    """Small tables of rights, tombstones or review labels: of one key the row that was read last."""
    return rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col("_at").desc()))).filter("_n = 1").drop("_n", "_at")


def video_facts(manifests: DataFrame, provenance: DataFrame, key: str = "video_id") -> DataFrame:
    """Manifests with provenance; where both know a column, provenance's non-null value wins."""
    shared = [c for c in manifests.columns if c in provenance.columns and c != key]
    other = provenance.select(key, *[F.col(c).alias(f"_p_{c}") if c in shared else F.col(c) for c in provenance.columns if c != key])
    joined = manifests.join(other, key, "full_outer")
    for c in shared:
        joined = joined.withColumn(c, F.coalesce(f"_p_{c}", c)).drop(f"_p_{c}")
    return joined


def inventory(spark: SparkSession, glob: str) -> DataFrame:
    """(path, length, sha256) of files; their contents are read by the executors."""
    return spark.read.format("binaryFile").load(glob).select("path", "length", F.sha2("content", 256).alias("sha256"))


def stale_checksums(found: DataFrame, stated: DataFrame) -> DataFrame:
    """(path, fault): files that changed, went missing or aren't stated."""
    both = found.select("path", F.col("sha256").alias("now")).join(stated.select("path", F.col("sha256").alias("then")), "path", "full_outer")
    fault = F.when(F.col("now").isNull(), F.lit("missing")).when(F.col("then").isNull(), F.lit("unlisted")).when(F.col("now") != F.col("then"), F.lit("changed"))
    return both.select("path", fault.alias("fault")).filter("fault IS NOT NULL")


def sliding_windows(recordings: DataFrame, length: float = 1.0, hop: float = 0.5, duration: str = "duration") -> DataFrame:
    """(…, t, until): the start and end of each window that begins within a recording."""
    steps = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col(duration) / hop).cast("int") - 1))
    return recordings.withColumn("t", F.explode(F.transform(steps, lambda i: i * hop))).withColumn("until", F.least(F.col("t") + length, F.col(duration)))
