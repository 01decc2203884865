"""Calibration, confusion, agreement of reviewers, and samples for review."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Z = {0.9: 1.645, 0.95: 1.96, 0.99: 2.576}


def calibration(pairs: DataFrame, by: str, confidence: str = "confidence", correct: str = "correct", threshold: float = 0.75, target: float = 0.05, bins: int = 10) -> DataFrame:
    """Of each source: n, accuracy, brier, ece, precision, false accepts and rejects at the threshold, and
    the smallest threshold (to 3 digits) whose false-accept share meets the target."""
    known = pairs.dropna(subset=[confidence]).select(by, F.col(confidence).alias("c"), F.col(correct).cast("double").alias("y"))
    share = lambda hit, of: F.sum(F.when(hit & of, 1.0).otherwise(0.0)) / F.nullif(F.sum(F.when(of, 1.0).otherwise(0.0)), F.lit(0.0))
    over = F.col("c") >= threshold
    right = F.col("y") == 1
    base = known.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("accuracy"), F.avg((F.col("c") - F.col("y")) ** 2).alias("brier"), share(right, over).alias("precision"), share(~right, over).alias("false_accept"), share(right, ~over).alias("false_reject"))
    binned = known.withColumn("bin", F.least(F.lit(bins - 1), F.floor(F.col("c") * bins))).groupBy(by, "bin").agg(F.count(F.lit(1)).alias("m"), F.avg("y").alias("acc"), F.avg("c").alias("conf"))
    ece = binned.groupBy(by).agg((F.sum(F.col("m") * F.abs(F.col("acc") - F.col("conf"))) / F.sum("m")).alias("ece"))
    steps = known.groupBy(by, F.round("c", 3).alias("t")).agg(F.count(F.lit(1)).alias("m"), F.sum(1 - F.col("y")).alias("bad"))
    tail = Window.partitionBy(by).orderBy(F.col("t").desc()).rowsBetween(Window.unboundedPreceding, 0)
    good = steps.withColumn("share", F.sum("bad").over(tail) / F.sum("m").over(tail)).filter(F.col("share") <= target).groupBy(by).agg(F.min("t").alias("recommended"))
    return base.join(ece, by).join(good, by, "left")


def confusion(pairs: DataFrame, predicted: str, actual: str) -> DataFrame:
    return pairs.groupBy(predicted, actual).agg(F.count(F.lit(1)).alias("n"))


def class_scores(matrix: DataFrame, predicted: str, actual: str) -> DataFrame:
    """(label, tp, support, predicted_n, precision, recall, f1)."""
    cells = matrix.select(F.col(predicted).alias("p"), F.col(actual).alias("a"), "n")
    sides = cells.select(F.explode(F.array(F.struct(F.col("p").alias("label"), F.col("n").alias("pn"), F.lit(0).cast("bigint").alias("an"), F.when(F.col("p") == F.col("a"), F.col("n")).otherwise(0).alias("tp")), F.struct(F.col("a").alias("label"), F.lit(0).cast("bigint").alias("pn"), F.col("n").alias("an"), F.lit(0).cast("bigint").alias("tp")))).alias("x")).select("x.*")
    out = sides.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("an").alias("support"), F.sum("pn").alias("predicted_n"))
    p, r = F.col("tp") / F.nullif("predicted_n", F.lit(0)), F.col("tp") / F.nullif("support", F.lit(0))
    return out.withColumn("precision", p).withColumn("recall", r).withColumn("f1", F.when(F.col("tp") > 0, 2 * p * r / (p + r)).otherwise(0.0))


def cohens_kappa(pairs: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """(n, agreement, kappa): chance-corrected agreement of two raters, 1 or 0 where chance agrees always."""
    by = by or []
    cells = pairs.groupBy(*by, a, b).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(*by, F.explode(F.array(F.struct(F.col(a).alias("label"), F.col("n").alias("x"), F.lit(0).cast("bigint").alias("y")), F.struct(F.col(b).alias("label"), F.lit(0).cast("bigint").alias("x"), F.col("n").alias("y")))).alias("s")).select(*by, "s.*")
    chance = sides.groupBy(*by, "label").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).groupBy(*by).agg(F.sum(F.col("x") * F.col("y")).alias("xy"))
    seen = cells.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).alias("same"))
    both = seen.join(chance, by) if by else seen.crossJoin(F.broadcast(chance))  # one row each
    po, pe = F.col("same") / F.col("n"), F.col("xy") / (F.col("n") * F.col("n"))
    kappa = F.when(pe >= 1 - 1e-12, F.when(po >= 1 - 1e-12, F.lit(1.0)).otherwise(0.0)).otherwise((po - pe) / (1 - pe))
    return both.select(*by, "n", po.alias("agreement"), kappa.alias("kappa"))


def adjudicate(reviews: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """(record_id, label, reviewer, needs_adjudication) from (record_id, reviewer, label).

    A stated decision overrides; else one label by all reviewers stands; else it needs one.
    """
    told = reviews.groupBy("record_id").agg(F.count_distinct("label").alias("kinds"), F.min("label").alias("l"), F.count_distinct("reviewer").alias("who"), F.min("reviewer").alias("r"))
    if decisions is None:
        told = told.withColumn("d", F.lit(None).cast("string"))
    else:
        told = told.join(decisions.select("record_id", F.col("label").alias("d")), "record_id", "full_outer")
    label = F.coalesce("d", F.when(F.col("kinds") == 1, F.col("l")))
    by = F.when(F.col("d").isNotNull(), F.lit("adjudicated")).when(F.col("kinds") == 1, F.when(F.col("who") == 1, F.col("r")).otherwise(F.lit("consensus")))
    return told.select("record_id", label.alias("label"), by.alias("reviewer"), label.isNull().alias("needs_adjudication"))


def sample_size(population: int, margin: float = 0.05, confidence: float = 0.95, p: float = 0.5) -> int:
    """Cochran's size for a share, corrected for a finite population."""
    if population <= 0:
        return 0
    n0 = Z[round(confidence, 2)] ** 2 * p * (1 - p) / margin**2
    return max(1, min(population, math.ceil(n0 / (1 + (n0 - 1) / population))))


def allocate(sizes: DataFrame, stratum: str, n: int, size: str = "n") -> DataFrame:
    """(stratum, places): n places over strata in proportion to ``size``, one at least for each if there are enough.

    One sort of seats: a stratum's first seat comes before all others, of larger strata first;
    its j-th is worth what is left of its exact share after j - 1 seats. The n best seats count.
    There are no more seats than places and strata together. Strata without rows get nothing.
    """
    full = sizes.filter(F.col(stratum).isNotNull() & (F.col(size) > 0)).select(F.col(stratum), F.col(size).alias("_s")).withColumn("_all", F.lit(1))
    total = F.sum("_s").over(Window.partitionBy("_all"))
    share = full.withColumn("_share", F.least(F.lit(n), total) * F.col("_s") / total)
    seats = share.withColumn("_seat", F.explode(F.sequence(F.lit(1), F.least(F.col("_s"), F.ceil("_share") + 1).cast("int"))))
    best = Window.partitionBy("_all").orderBy((F.col("_seat") > 1), F.when(F.col("_seat") > 1, F.round(F.col("_share") - F.col("_seat") + 1, 9)).desc_nulls_last(), F.col("_s").desc(), F.col(stratum))
    return seats.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= n).groupBy(stratum).agg(F.count(F.lit(1)).cast("int").alias("places"))


def stratified_sample(records: DataFrame, stratum: str, key: str, n: int, seed: int = 1234, scope: str | None = None, cap: int | None = None, reviewers: tuple[str, ...] = ("reviewer_a", "reviewer_b"), double: float = 0.2) -> DataFrame:
    """A repeatable sample of n rows over strata, dealt to reviewers.

    Rows are in order of a hash of seed and key, so every draw is the same. ``cap`` bounds the
    rows of one ``scope``: a stratum takes its next rows instead of those above it, and what
    strata then still lack is refilled in that order from the rows of any. A ``double`` share of
    the sample goes to all reviewers, the others by turns. Rows without a stratum aren't drawn.
    """
    order = [F.sha1(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), F.col(key)]
    known = records.filter(F.col(stratum).isNotNull())
    places = allocate(known.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")), stratum, n)
    if scope and cap:
        known = known.withColumn("_c", F.row_number().over(Window.partitionBy(scope).orderBy(*order))).filter(F.col("_c") <= cap).drop("_c")
    queued = known.join(F.broadcast(places), stratum, "left").withColumn("_n", F.row_number().over(Window.partitionBy(stratum).orderBy(*order)))
    # A row beyond its stratum's places can only be drawn if some stratum has too few; n of those are enough.
    first = queued.filter(F.col("_n") <= F.col("places")).withColumn("_late", F.lit(0))
    spare = queued.filter(F.coalesce(F.col("_n") > F.col("places"), F.lit(True))).orderBy(*order).limit(n).withColumn("_late", F.lit(1))
    ranked = first.unionByName(spare).withColumn("_all", F.lit(1)).withColumn("_r", F.row_number().over(Window.partitionBy("_all").orderBy("_late", *order))).filter(F.col("_r") <= n)
    turned = ranked.withColumn("_r", F.row_number().over(Window.partitionBy("_all").orderBy(*order)) - 1)
    both = F.array(*[F.lit(r) for r in reviewers])
    turn = F.array(F.element_at(both, (F.col("_r") % len(reviewers) + 1).cast("int")))
    n_double = F.round(F.lit(double) * F.count(F.lit(1)).over(Window.partitionBy("_all"))) if len(reviewers) > 1 else F.lit(0)
    return turned.withColumn("assigned_to", F.when(F.col("_r") < n_double, both).otherwise(turn)).drop("_n", "_r", "_all", "_late", "places")
