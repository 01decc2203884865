"""Sinks: typed Parquet, JSON lines, combined and normalised streams, queues and shards.

Every write is one job, committed as a whole by Spark's committers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema


def write_jsonl(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    records.write.mode(mode).option("ignoreNullFields", False).json(path)


def typed(records: DataFrame, kind: str) -> DataFrame:
    """Columns of the type's schema, in its order; missing ones are null."""
    fields = records.sparkSession.createDataFrame([], schema.SCHEMAS[kind]).schema
    return records.select(*[(F.col(f.name) if f.name in records.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def write_typed(records: DataFrame, kind: str, path: str) -> None:
    """Typed Parquet; an empty type makes an empty, typed table."""
    typed(records, kind).write.mode("overwrite").parquet(path)


def combined(tables: dict[str, DataFrame]) -> DataFrame:
    """(record_type, payload) of all types as JSON."""
    return reduce(DataFrame.unionByName, [t.select(F.lit(kind).alias("record_type"), F.to_json(F.struct("*")).alias("payload")) for kind, t in tables.items()])


def normalised(tables: dict[str, DataFrame], columns: list[str], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """All types with the same columns, the first known alias each, and the whole row as ``payload``."""
    aliases = aliases or {}

    def one(kind: str, t: DataFrame) -> DataFrame:
        pick = lambda c: F.coalesce(*[F.col(a).cast("string") for a in (c, *aliases.get(c, ())) if a in t.columns], F.lit(None).cast("string")).alias(c)
        return t.select(F.lit(kind).alias("record_type"), *[pick(c) for c in columns], F.to_json(F.struct("*")).alias("payload"))

    return reduce(DataFrame.unionByName, [one(k, t) for k, t in tables.items()])


def write_buckets(records: DataFrame, path: str, column: str = "bucket") -> None:
    records.write.mode("overwrite").partitionBy(column).parquet(path)


def write_shards(records: DataFrame, path: str, rows: int) -> None:
    """Files of ``rows`` rows at most."""
    records.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


def append_history(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def promote(spark, staged: str, final: str) -> None:
    """Moves a staged release into place; refuses to replace one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(final)
    files = b.getFileSystem(conf)
    if files.exists(b):
        raise FileExistsError(final)
    if not files.rename(a, b):
        raise OSError(f"{staged} could not be moved to {final}")


def json_schema(kind: str, spark) -> str:
    return spark.createDataFrame([], schema.SCHEMAS[kind]).schema.json()
