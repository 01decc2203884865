"""Reports as tables: statistics, validation, splits, coverage, counts, metrics, and their text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dataset_statistics(tables: dict[str, DataFrame], video: str = "video_id", duration: str = "duration") -> DataFrame:
    """(record_type, records, videos, seconds, shortest, longest): one row a type, one pass each; types without a duration have null."""

    def one(kind: str, t: DataFrame) -> DataFrame:
        d = F.col(duration) if duration in t.columns else F.lit(None).cast("double")
        return t.agg(F.count(F.lit(1)).alias("records"), F.count_distinct(video).alias("videos"), F.sum(d).alias("seconds"), F.min(d).alias("shortest"), F.max(d).alias("longest")).select(F.lit(kind).alias("record_type"), "*")

    return reduce(DataFrame.unionByName, [one(k, t) for k, t in tables.items()])


def validation_report(records: DataFrame, by: str, status: str, components: dict[str, Column]) -> DataFrame:
    """(by, records, accepted, review, rejected, duplicate, accepted_percent, null_<component> …) of each kind of record."""
    count = lambda s: F.count_if(F.col(status) == s).alias(s)
    percent = F.round(100 * F.count_if(F.col(status) == "accepted") / F.count(F.lit(1)), 2)
    nulls = [F.count_if(c.isNull()).alias(f"null_{name}") for name, c in components.items()]
    return records.groupBy(by).agg(F.count(F.lit(1)).alias("records"), *[count(s) for s in ("accepted", "review", "rejected", "duplicate")], percent.alias("accepted_percent"), *nulls)


def videos_per_split(records: DataFrame, split: str = "split", video: str = "video_id", group: str | None = None) -> DataFrame:
    """(split, records, videos, groups)."""
    groups = F.count_distinct(group) if group else F.lit(0).cast("bigint")
    return records.groupBy(split).agg(F.count(F.lit(1)).alias("records"), F.count_distinct(video).alias("videos"), groups.alias("groups"))


def last_blocks(blocks: DataFrame, key: str, order: str, coverage: str) -> DataFrame:
    """(stage, state, videos): of each source its last coverage block (a map of stage to state), counted by stage and state."""
    last = blocks.groupBy(key).agg(F.max_by(coverage, order).alias("_c"))
    return last.select(F.explode("_c").alias("stage", "state")).groupBy("stage", "state").agg(F.count(F.lit(1)).alias("videos"))


def claim_counts(records: DataFrame, claims: str) -> DataFrame:
    """(kind, status, n) of an array of claims (kind, status)."""
    return records.select(F.explode(claims).alias("c")).groupBy("c.kind", "c.status").agg(F.count(F.lit(1)).alias("n"))


def inconsistent_counts(counts: dict[str, DataFrame], key: str = "record_type") -> DataFrame:
    """(key, n_<artefact> …): kinds of which the artefacts (each key, n) state different numbers; an absent one states none."""
    out = reduce(lambda a, b: a.join(b, key, "full_outer"), [c.select(key, F.col("n").cast("bigint").alias(f"n_{name}")) for name, c in counts.items()])
    columns = [F.coalesce(f"n_{name}", F.lit(0).cast("bigint")).alias(f"n_{name}") for name in counts]
    told = out.select(key, *columns)
    return told.filter(F.greatest(*[F.col(f"n_{n}") for n in counts]) != F.least(*[F.col(f"n_{n}") for n in counts]))


def release_metrics(records: DataFrame, dimensions: dict[str, Column], by: str = "record_type") -> DataFrame:
    """(record_type, dimension, value, n, share) of every dimension, and of all types together under ``all``."""
    each = F.array(*[F.struct(F.lit(k).alias("dimension"), F.coalesce(c.cast("string"), F.lit("unknown")).alias("value")) for k, c in dimensions.items()])
    told = records.select(F.explode(F.array(F.col(by), F.lit("all"))).alias(by), each.alias("_d")).select(by, F.explode("_d").alias("d"))
    counted = told.groupBy(by, "d.dimension", "d.value").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(by, "dimension")), 6))


def timeline_statistics(events: DataFrame, relations: DataFrame, key: str = "video_id") -> DataFrame:
    """(key, events, relations, kinds, covered, density): how much of a timeline is described, and how densely."""
    per = events.groupBy(key).agg(F.count(F.lit(1)).alias("events"), F.count_distinct("event_type").alias("kinds"), (F.max("end_time") - F.min("start_time")).alias("covered"))
    links = relations.groupBy(key).agg(F.count(F.lit(1)).alias("relations"))
    joined = per.join(links, key, "left").withColumn("relations", F.coalesce("relations", F.lit(0).cast("bigint")))
    return joined.withColumn("density", F.when(F.col("covered") > 0, F.col("events") / F.col("covered")))


def rejection_reasons(records: DataFrame, kind: str, status: str, codes: str, k: int = 5) -> DataFrame:
    """(kind, code, n): of each kind the ``k`` codes that most often keep a record from being accepted, equals by code."""
    counted = records.filter(F.col(status) != "accepted").select(kind, F.explode(codes).alias("code")).groupBy(kind, "code").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("_r", F.row_number().over(Window.partitionBy(kind).orderBy(F.col("n").desc(), "code"))).filter(F.col("_r") <= k).drop("_r")


def exclusions(records: DataFrame, reasons: str, status: str) -> DataFrame:
    """(status, reason, n): task selection by reason and status; records without a reason count as ``selected``."""
    told = F.when(F.size(reasons) == 0, F.array(F.lit("selected"))).otherwise(F.col(reasons))
    return records.select(status, F.explode(told).alias("reason")).groupBy(status, "reason").agg(F.count(F.lit(1)).alias("n"))


def boundary_audit(reviews: DataFrame, by: str, tolerance: float = 0.5) -> DataFrame:
    """(by, n, mean_error, within): how far reviewed boundaries lie from the stated ones, and the share within a tolerance."""
    error = F.greatest(F.abs(F.col("start_time") - F.col("true_start")), F.abs(F.col("end_time") - F.col("true_end")))
    return reviews.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(error).alias("mean_error"), F.avg((error <= tolerance).cast("int")).alias("within"))


def rendered(table: DataFrame, columns: list[str], order: list[str], most: int = 1000) -> str:
    """A small report table as lines of text, for people; more than ``most`` rows are refused."""
    rows = table.select(*columns).orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    cells = [columns, *[["" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v) for v in r] for r in rows]]
    widths = [max(len(row[k]) for row in cells) for k in range(len(columns))]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(row, widths, strict=True)).rstrip() for row in cells)
