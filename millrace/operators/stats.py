"""Counts, histograms, quantiles and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(records: DataFrame, key: Column, label: str = "unknown", name: str = "value") -> DataFrame:
    return records.groupBy(F.coalesce(key.cast("string"), F.lit(label)).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def histogram(records: DataFrame, value: Column, bins: int = 10, by: list[str] | None = None) -> DataFrame:
    """Counts and means of values in [0, 1] in equal bins, 1 in the last; nulls as bin null."""
    bin_of = F.least(F.lit(bins - 1), F.floor(value * bins).cast("int"))
    return records.withColumn("bin", bin_of).withColumn("_v", value).groupBy(*(by or []), "bin").agg(F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"))


def index_quantiles(records: DataFrame, value: str, fractions: list[float], by: list[str] | None = None) -> DataFrame:
    """The value at index min(n - 1, int(f n)) of the sorted values, for each fraction, and the mean.

    Values are first counted, so that what a key's window sorts is its distinct values.
    """
    by = by or []
    counted = records.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("c"))
    if by:
        w, whole = Window.partitionBy(*by).orderBy(value), Window.partitionBy(*by)
    else:
        counted = counted.withColumn("_all", F.lit(1))
        w, whole = Window.partitionBy("_all").orderBy(value), Window.partitionBy("_all")
    placed = counted.withColumn("upto", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(whole))
    at = [F.min(F.when(F.col("upto") > F.least(F.col("n") - 1, F.floor(F.lit(f) * F.col("n"))), F.col(value))).alias(f"q{round(f * 100):02d}") for f in fractions]
    return placed.groupBy(*by).agg(F.max("n").alias("n"), (F.sum(F.col(value) * F.col("c")) / F.sum("c")).alias("mean"), *at)


def distributions(records: DataFrame, dimensions: dict[str, Column], label: str = "unknown") -> DataFrame:
    """(dimension, value, n) of several dimensions in one pass."""
    each = F.array(*[F.struct(F.lit(k).alias("dimension"), F.coalesce(c.cast("string"), F.lit(label)).alias("value")) for k, c in dimensions.items()])
    return records.select(F.explode(each).alias("d")).groupBy("d.dimension", "d.value").agg(F.count(F.lit(1)).alias("n"))


def underrepresented(dist: DataFrame, floor: float = 0.5, label: str = "unknown") -> DataFrame:
    """Known values whose share is below ``floor`` of an even share, of dimensions with two known values."""
    whole = Window.partitionBy("dimension")
    known = dist.filter(F.col("value") != label).withColumn("total", F.sum("n").over(whole)).withColumn("kinds", F.count(F.lit(1)).over(whole))
    share = F.col("n") / F.col("total")
    return known.filter((F.col("kinds") >= 2) & (share < F.lit(floor) / F.col("kinds"))).select("dimension", "value", "n", share.alias("share"))


def unknown_share(dist: DataFrame, label: str = "unknown") -> DataFrame:
    return dist.groupBy("dimension").agg((F.sum(F.when(F.col("value") == label, F.col("n")).otherwise(0)) / F.sum("n")).alias("unknown_fraction"))


def top(counts: DataFrame, k: int, key: str = "value") -> DataFrame:
    """The k greatest counts, equal ones by key."""
    return counts.orderBy(F.col("n").desc(), key).limit(k)


def code_counts(records: DataFrame, codes: str, length: int = 60) -> DataFrame:
    """Counts of the codes in an array column, cut to ``length`` characters."""
    return records.select(F.explode(codes).alias("code")).groupBy(F.substring("code", 1, length).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def coverage(records: DataFrame, dims: dict[str, Column], hours: Column) -> DataFrame:
    """(dimension, value, clips, hours)."""
    each = F.array(*[F.struct(F.lit(k).alias("dimension"), F.coalesce(c.cast("string"), F.lit("unknown")).alias("value")) for k, c in dims.items()])
    return records.select(F.explode(each).alias("d"), hours.alias("h")).groupBy("d.dimension", "d.value").agg(F.count(F.lit(1)).alias("clips"), F.sum("h").alias("hours"))


def status_pivot(records: DataFrame, kind: str, status: str, statuses: tuple[str, ...] = ("accepted", "review", "rejected", "duplicate")) -> DataFrame:
    return records.groupBy(kind).pivot(status, list(statuses)).agg(F.count(F.lit(1))).na.fill(0)


def rolled_up(records: DataFrame, key: str, *measures: Column) -> DataFrame:
    """Measures for each key and, under a null key, for all: one pass by grouping sets."""
    return records.rollup(key).agg(*measures)


def slope(samples: DataFrame, by: list[str], y: str, x: str) -> DataFrame:
    """Least-squares slope of y over x."""
    return samples.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"))


def strict_min(value: Column) -> Column:
    """The least value, null if any is null."""
    return F.when(F.count(F.lit(1)) == F.count(value), F.min(value))


def worst(status: Column, order: tuple[str, ...] = ("accepted", "review", "rejected", "duplicate")) -> Column:
    rank = F.coalesce(*[F.when(status == s, F.lit(i)) for i, s in enumerate(order)], F.lit(1))
    return F.max_by(status, rank)


def frozen_hash(records: DataFrame, key: str, most: int = 5_000_000) -> DataFrame:
    """The SHA-256 of the distinct keys, sorted and joined by line ends: one row.

    The hash of one sorted list has to meet in one task; more than ``most`` keys are refused
    (``ranged_hash`` is for those).
    """
    keys = records.select(F.col(key).cast("string").alias("k")).dropna().distinct()
    n = F.count(F.lit(1))
    checked = F.when(n <= most, F.sha2(F.array_join(F.array_sort(F.collect_list("k")), "\n"), 256)).otherwise(F.raise_error(F.lit(f"more than {most} keys in one list")))
    return keys.agg(checked.alias("frozen"), n.alias("n"))


def ranged_hash(records: DataFrame, key: str, prefix: int = 2) -> DataFrame:
    """One row that changes if any distinct key does, for sets of any size: (frozen, n).

    Keys are dealt by the first ``prefix`` hex digits of their own hash, each part's sorted
    hashes are hashed in its own task, and the parts' hashes, in order, once more.
    """
    hashes = records.select(F.sha2(F.col(key).cast("string"), 256).alias("h")).dropna().distinct()
    parts = hashes.groupBy(F.substring("h", 1, prefix).alias("part")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"), F.count(F.lit(1)).alias("n"))
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "h"))), lambda x: x["h"]), ""), 256).alias("frozen"), F.sum("n").alias("n"))
