"""Release governance: gates as violation tables, diffs, repair queues, takedowns, registries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reasons import reasons


def dangling(records: DataFrame, refs: str, parents: DataFrame, parent: str, scope: str = "video_id", key: str = "record_id", within: bool = True) -> DataFrame:
    """(scope, key, missing): references that no parent of the same scope answers, or none at all if not ``within``."""
    each = records.select(scope, key, F.explode(refs).alias("missing"))
    by = [scope, "missing"] if within else ["missing"]
    known = parents.withColumn("missing", F.col(parent)).select(*by).distinct()
    return each.join(known, by, "left_anti").select(scope, key, "missing")


def repeated_ids(records: DataFrame, key: str = "record_id") -> DataFrame:
    return records.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def gates(**violations: DataFrame) -> DataFrame:
    """(gate, state, n): a gate passes if its violation table is empty. One pass over each table."""
    parts = [v.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("gate"), F.when(F.col("n") == 0, F.lit("passed")).otherwise(F.lit("failed")).alias("state"), "n") for name, v in violations.items()]
    return reduce(DataFrame.unionByName, parts)


def examples(violations: DataFrame, gate: str, key: str, most: int = 20) -> DataFrame:
    """The first ``most`` violations of a gate by key, as the report shows them."""
    return violations.select(F.lit(gate).alias("gate"), F.col(key).cast("string").alias("example")).orderBy("example").limit(most)


def release_status(told: DataFrame) -> DataFrame:
    """One row: failed if a gate failed, unverified if one could not run, else passed."""
    has = lambda s: F.max(F.when(F.col("state") == s, 1).otherwise(0)) == 1
    return told.agg(F.when(has("failed"), F.lit("failed")).when(has("not_run"), F.lit("unverified")).otherwise(F.lit("passed")).alias("status"))


def diff(old: DataFrame, new: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """(key, change, changed): added, removed, changed or kept; ``changed`` names the columns that differ."""
    a, b = (d.select(key, F.struct(*compared).alias(n), F.lit(True).alias(f"_{n}")) for d, n in ((old, "o"), (new, "n")))
    both = a.join(b, key, "full_outer")
    changed = reasons(*[(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) & F.col("_o").isNotNull() & F.col("_n").isNotNull(), c) for c in compared])
    what = F.when(F.col("_o").isNull(), F.lit("added")).when(F.col("_n").isNull(), F.lit("removed")).when(F.size("changed") > 0, F.lit("changed")).otherwise(F.lit("kept"))
    return both.withColumn("changed", changed).select(key, what.alias("change"), "changed")


def queues(records: DataFrame, rules: dict[str, Column], key: str = "record_id") -> DataFrame:
    """(key, queue): each record in each queue whose rule holds; one pass."""
    return records.select(key, F.explode(reasons(*[(cond, name) for name, cond in rules.items()])).alias("queue"))


def takedown(records: DataFrame, removed: DataFrame, key: str = "video_id") -> DataFrame:
    """Records but those of removed sources."""
    return records.join(removed.select(key).distinct(), key, "left_anti")


def merge_release(existing: DataFrame, fresh: DataFrame, scope: str = "video_id", key: str = "record_id") -> DataFrame:
    """Existing records of sources that weren't exported again, and the fresh ones; of one id the fresh one."""
    kept = existing.join(fresh.select(scope).distinct(), scope, "left_anti").withColumn("_age", F.lit(1))
    merged = fresh.withColumn("_age", F.lit(0)).unionByName(kept, allowMissingColumns=True)
    return merged.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_age", scope))).filter("_n = 1").drop("_n", "_age")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows over old ones by key; a null in a new row keeps the old value."""
    columns = [c for c in old.columns if c != key]
    n = new.select(key, F.struct(*[c for c in columns]).alias("_n"), F.lit(True).alias("_in"))
    return old.withColumn("_o", F.struct(*columns)).select(key, "_o").join(n, key, "full_outer").select(key, *[F.coalesce(F.col(f"_n.{c}"), F.col(f"_o.{c}")).alias(c) for c in columns])


def latest(records: DataFrame, key: str, by: str) -> DataFrame:
    """One row a key: the one of the greatest ``by``."""
    return records.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(by).desc()))).filter("_n = 1").drop("_n")


def asset_registry(records: DataFrame, path: str) -> DataFrame:
    """(path, kind, references, videos): one row for each asset that records point to."""
    told = records.filter(F.col(path).isNotNull())
    return told.groupBy(F.col(path).alias("path")).agg(F.min("kind").alias("kind"), F.count(F.lit(1)).alias("references"), F.count_distinct("video_id").alias("videos"))


def lineage(before: DataFrame, after: DataFrame, key: str = "record_id", status: str = "status") -> DataFrame:
    """(key, from_status, to_status) of records whose status changed."""
    return before.select(key, F.col(status).alias("from_status")).join(after.select(key, F.col(status).alias("to_status")), key).filter(~F.col("from_status").eqNullSafe(F.col("to_status")))


def machine_paths(records: DataFrame) -> DataFrame:
    """Records that hold a path of one machine anywhere."""
    return records.filter(F.to_json(F.struct("*")).rlike(r'"(?:/(?:home|Users|root|tmp|mnt)/|[A-Za-z]:\\\\)'))


def bucketed(records: DataFrame, status: Column) -> DataFrame:
    """Records with their export bucket: approved, review or rejected."""
    return records.withColumn("bucket", F.when(status == "accepted", F.lit("approved")).when(status == "review", F.lit("review")).otherwise(F.lit("rejected")))
