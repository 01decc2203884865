"""Operators over timed records: relations, range joins, continuity, islands.

Timed tables have the columns video_id, start_time and end_time in seconds. Operators that need
the order within a video are windows on video_id; those that join intervals deal them to time
buckets first, so that one very long video is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import ids, interval


def _order(key: str = "video_id", *by: str) -> Window:
    return Window.partitionBy(key).orderBy(*(by or ("start_time", "end_time", "event_id")))


def neighbour_relations(events: DataFrame, k: int = 6, tolerance: float = 0.25, inverse: bool = False, carry: dict[str, Column] | None = None) -> DataFrame:
    """(video_id, event_a, event_b, relation, gap_seconds) of each event with its next k in the video.

    The k neighbours come by ``lead`` over one window, so there is no join. Events with equal
    times are in order of their id. Columns that ``carry`` names come along for both events, as
    <name>_a and <name>_b.
    """
    w, carry = _order(), carry or {}
    own = F.struct("event_id", "start_time", "end_time", *[v.alias(n) for n, v in carry.items()])
    later = [F.lead(own, j).over(w) for j in range(1, k + 1)]
    kept = [v.alias(f"_own_{n}") for n, v in carry.items()]
    pairs = events.select("video_id", F.col("event_id").alias("a"), F.col("start_time").alias("s"), F.col("end_time").alias("e"), *kept, F.array_compact(F.array(*later)).alias("later")).select("*", F.explode("later").alias("n")).drop("later")
    told = pairs.withColumn("r", interval.relation(F.col("s"), F.col("e"), F.col("n.start_time"), F.col("n.end_time"), tolerance)).filter(F.col("r").isNotNull())
    swapped = F.col("r.swapped")
    gap = F.when(F.col("r.relation") == "BEFORE", F.round(F.col("n.start_time") - F.col("e"), 3))
    out = told.select("video_id", F.when(swapped, F.col("n.event_id")).otherwise(F.col("a")).alias("event_a"), F.when(swapped, F.col("a")).otherwise(F.col("n.event_id")).alias("event_b"), F.col("r.relation").alias("relation"), gap.alias("gap_seconds"), *[F.when(swapped == (side == "b"), F.col(f"_own_{n}")).otherwise(F.col(f"n.{n}")).alias(f"{n}_{side}") for n in carry for side in "ab"])
    if inverse:
        turned = [F.col(f"{n}_{x}").alias(f"{n}_{y}") for n in carry for x, y in ("ab", "ba")]
        out = out.unionByName(out.filter(F.col("relation") == "BEFORE").select("video_id", F.col("event_b").alias("event_a"), F.col("event_a").alias("event_b"), F.lit("AFTER").alias("relation"), "gap_seconds", *turned))
    return out


def long_range_links(events: DataFrame, entity: str = "entity", min_gap: float = 20.0, k: int = 3, scene: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """(video_id, event_a, event_b, gap_seconds): for each event its nearest k later ones of one of its entities.

    ``events`` has a row for each event and entity. A link needs a gap of ``min_gap`` at least
    and, if ``scene`` names a column, another scene. Starts and the earliest times at which a
    link may begin are merged in one window, in which an event's candidates are the k starts
    after its own place, so they are never found by comparing all later events. With a scene,
    starts are numbered, within their scene too, and met by number: of each of the k next numbers
    that fall in the event's own scene, one more is looked at. Columns that ``carry`` names, which
    must be the same in all rows of an event, come along for both events, as <name>_a and <name>_b.
    """
    carry = carry or []
    held = F.struct(*carry) if carry else F.lit(None).cast("int")
    own = F.col(scene).cast("string") if scene else F.lit(None).cast("string")
    first = F.col("end_time") + min_gap
    starts = events.select("video_id", entity, "event_id", "start_time", F.lit(None).cast("double").alias("from"), F.col("start_time").alias("t"), F.lit(1).alias("kind"), own.alias("sc"), held.alias("held"))
    asks = events.select("video_id", entity, "event_id", "start_time", F.col("end_time").alias("from"), first.alias("t"), F.lit(0).alias("kind"), own.alias("sc"), held.alias("held"))
    w = Window.partitionBy("video_id", entity).orderBy(F.col("t"), F.col("kind"), F.col("event_id"))
    both = starts.unionByName(asks)
    target = F.struct(F.col("start_time").alias("b_start"), F.col("event_id").alias("event_b"), F.col("held").alias("held_b"))
    if not scene:
        over = f"OVER (PARTITION BY video_id, `{entity}` ORDER BY t, kind, event_id)"
        later = F.array_compact(F.array(*[F.expr(f"lead(_start, {j}) IGNORE NULLS {over}") for j in range(1, k + 1)]))
        ranked = both.withColumn("_start", F.when(F.col("kind") == 1, target)).select("video_id", "event_id", "from", "kind", "held", later.alias("_later")).filter("kind = 0")
        near = ranked.select("video_id", F.col("event_id").alias("event_a"), F.col("from").alias("a_end"), F.col("held").alias("held_a"), F.explode("_later").alias("_b"))
    else:
        # How many later starts lie in the event's own scene: so many numbers more may be needed.
        inside = Window.partitionBy("video_id", entity, "sc").orderBy(F.col("t").desc(), F.col("kind").desc(), F.col("event_id").desc())
        ranked = both.withColumn("place", F.sum("kind").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("more", F.sum("kind").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        targets = ranked.filter("kind = 1").select("video_id", entity, target.alias("_b"), F.col("sc").alias("b_sc"), "place")
        wanted = ranked.filter("kind = 0").select("video_id", entity, F.col("event_id").alias("event_a"), F.col("from").alias("a_end"), F.col("sc").alias("a_sc"), F.col("held").alias("held_a"), F.explode(F.sequence(F.col("place") + 1, F.col("place") + F.lit(k) + F.col("more"))).alias("place"))
        linked = wanted.join(targets, ["video_id", entity, "place"]).filter("a_sc IS NULL OR b_sc IS NULL OR a_sc <> b_sc")
        per = Window.partitionBy("video_id", entity, "event_a").orderBy("place")
        near = linked.withColumn("n", F.row_number().over(per)).filter(F.col("n") <= k).select("video_id", "event_a", "a_end", "held_a", "_b")
    best = near.groupBy("video_id", "event_a", "a_end", "held_a").agg(F.collect_set("_b").alias("_all"))
    told = best.select("video_id", "event_a", "a_end", "held_a", F.explode(F.slice(F.array_sort("_all"), 1, k)).alias("_b"))
    return told.select("video_id", "event_a", F.col("_b.event_b").alias("event_b"), (F.col("_b.b_start") - F.col("a_end")).alias("gap_seconds"), *[F.col(f"held_a.{c}").alias(f"{c}_a") for c in carry], *[F.col(f"_b.held_b.{c}").alias(f"{c}_b") for c in carry])


def relation_violations(relations: DataFrame, events: DataFrame, tolerance: float = 0.3) -> DataFrame:
    """Relations that the two events' intervals contradict, or whose events are missing."""
    side = lambda n: events.select(F.col("video_id"), F.col("event_id").alias(f"event_{n}"), F.col("start_time").alias(f"s{n}"), F.col("end_time").alias(f"e{n}"))
    joined = relations.join(side("a"), ["video_id", "event_a"], "left").join(side("b"), ["video_id", "event_b"], "left")
    missing = F.col("sa").isNull() | F.col("sb").isNull()
    holds = interval.relation_holds(F.col("relation"), F.col("sa"), F.col("ea"), F.col("sb"), F.col("eb"), tolerance)
    return joined.withColumn("reason", F.when(missing, F.lit("event_missing")).when(~holds, F.lit("interval_semantics"))).filter("reason IS NOT NULL").select("video_id", "event_a", "event_b", "relation", "reason")


def _buckets(s: Column, e: Column, width: float) -> Column:
    return F.sequence(F.floor(s / width), F.floor(F.greatest(s, e) / width))


def interval_join(left: DataFrame, right: DataFrame, key: str = "video_id", width: float = 60.0) -> DataFrame:
    """Pairs of the same key whose half-open intervals overlap: columns of both, the right's as r_*.

    Both sides are dealt to time buckets of ``width`` seconds and meet by equality; a pair that
    shares several buckets is kept in the first of them only.
    """
    a = left.withColumn("_bucket", F.explode(_buckets(F.col("start_time"), F.col("end_time"), width)))
    b = right.select(*[F.col(c).alias(c if c == key else f"r_{c}") for c in right.columns]).withColumn("_bucket", F.explode(_buckets(F.col("r_start_time"), F.col("r_end_time"), width)))
    first = F.greatest(F.floor(F.col("start_time") / width), F.floor(F.col("r_start_time") / width))
    return a.join(b, [key, "_bucket"]).filter((F.col("start_time") < F.col("r_end_time")) & (F.col("end_time") > F.col("r_start_time")) & (F.col("_bucket") == first)).drop("_bucket")


#: Each level of ``points_in_intervals`` has buckets so many times as wide as the one before.
LEVEL = 8


def _level(s: Column, e: Column, width: float) -> Column:
    """The first level whose buckets are as wide as the interval is long, so that it lies in two of them at most."""
    return F.greatest(F.lit(0), F.ceil(F.log(F.greatest(e - s, F.lit(width)) / width) / F.log(F.lit(float(LEVEL))) + 1e-9)).cast("int")


def points_in_intervals(points: DataFrame, spans: DataFrame, time: str = "t", key: str = "video_id", width: float = 60.0) -> DataFrame:
    """Points with each interval that holds them, both ends included; the interval's columns as r_*.

    Intervals are dealt to levels by their length: buckets of ``width`` seconds, then of
    ``LEVEL`` times as many and so on, so that each lies in two buckets at most, however long it
    is. A point is looked up once in each level that there is.
    """
    wide = lambda: F.pow(F.lit(float(LEVEL)), F.col("_level")) * F.lit(float(width))
    s, e = F.col("r_start_time"), F.col("r_end_time")
    b = spans.select(*[F.col(c).alias(c if c == key else f"r_{c}") for c in spans.columns]).filter(e >= s).withColumn("_level", _level(s, e, width))
    levels = F.broadcast(b.select("_level").distinct())
    b = b.withColumn("_bucket", F.explode(F.sequence(F.floor(s / wide()), F.floor(e / wide()))))
    a = points.crossJoin(levels).withColumn("_bucket", F.floor(F.col(time) / wide()))
    return a.join(b, [key, "_level", "_bucket"]).filter(interval.contains_time(s, e, F.col(time))).drop("_bucket", "_level")


def clip_to_window(segments: DataFrame, windows: DataFrame, width: float = 60.0) -> DataFrame:
    """Segments cut to the windows they overlap: times relative to the window, and whether either end was cut."""
    joined = interval_join(segments, windows, width=width)
    s, e = F.greatest("start_time", "r_start_time"), F.least("end_time", "r_end_time")
    return joined.withColumn("clip_start", s - F.col("r_start_time")).withColumn("clip_end", e - F.col("r_start_time")).withColumn("partial_start", F.col("start_time") < F.col("r_start_time")).withColumn("partial_end", F.col("end_time") > F.col("r_end_time"))


def as_of(left: DataFrame, right: DataFrame, value: str, key: str = "video_id", time: str = "t", backward: bool = True) -> DataFrame:
    """``left`` with the right's ``value`` at the latest time not after (or earliest not before) its own.

    One window over the union of both sides, with no join: right rows come first at equal times.
    """
    sides = left.withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_left", F.lit(True)).unionByName(right.select(key, time, F.col(value).alias("_v"), F.lit(False).alias("_left")), allowMissingColumns=True)
    order = [F.col(time), F.col("_left")] if backward else [F.col(time).desc(), F.col("_left")]
    w = Window.partitionBy(key).orderBy(*order, F.col("_v")).rowsBetween(Window.unboundedPreceding, 0)
    return sides.withColumn(value, F.last("_v", ignorenulls=True).over(w)).filter("_left").drop("_v", "_left")


def nearest(left: DataFrame, right: DataFrame, value: str, key: str = "video_id", time: str = "t") -> DataFrame:
    """``left`` with the right's ``value`` nearest in time; the earlier one of two equally near."""
    told = right.select(key, time, F.struct(F.col(time).alias("at"), F.col(value).alias("v")).alias("_hit"))
    both = as_of(as_of(left, told.withColumnRenamed("_hit", "_before"), "_before", key, time), told.withColumnRenamed("_hit", "_after"), "_after", key, time, backward=False)
    before, after = F.col(time) - F.col("_before.at"), F.col("_after.at") - F.col(time)
    pick = F.when(F.col("_after").isNull() | (before <= after), F.col("_before.v")).otherwise(F.col("_after.v"))
    return both.withColumn(value, pick).drop("_before", "_after")


def paths_of_two(relations: DataFrame, max_gap: float = 8.0) -> DataFrame:
    """(video_id, a, b, c): the first event c after b, for each pair a before b, with gaps up to ``max_gap``."""
    edge = relations.filter((F.col("relation") == "BEFORE") & (F.col("gap_seconds") <= max_gap))
    onward = edge.groupBy("video_id", F.col("event_a").alias("event_b")).agg(F.min("event_b").alias("event_c"))
    return edge.select("video_id", "event_a", "event_b").join(onward, ["video_id", "event_b"]).select("video_id", "event_a", "event_b", "event_c")


def before_cycles(relations: DataFrame, most: int = 10) -> DataFrame:
    """(video_id, cycle): cycles of the BEFORE graph, ``most`` a video at most, by depth-first search."""

    def told(pdf: pd.DataFrame, found: list[list[str]]) -> pd.DataFrame:
        return pd.DataFrame([(pdf.video_id.iloc[0], "\x1f".join(c)) for c in found], columns=["video_id", "cycle"], dtype=object)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        graph: dict[str, list[str]] = {}
        for a, b in sorted(set(zip(pdf.event_a.astype(str), pdf.event_b.astype(str), strict=True))):
            graph.setdefault(a, []).append(b)
        state: dict[str, int] = {}
        found: list[list[str]] = []
        for root in graph:
            if state.get(root):
                continue
            trail, stack = [root], [iter(graph[root])]
            state[root] = 1
            while stack:
                node = next(stack[-1], None)
                if node is None:
                    state[trail.pop()] = 2
                    stack.pop()
                elif state.get(node) == 1:
                    found.append([*trail[trail.index(node) :], node])
                    if len(found) >= most:
                        return told(pdf, found)
                elif not state.get(node):
                    state[node] = 1
                    trail.append(node)
                    stack.append(iter(graph.get(node, ())))
        return told(pdf, found)

    kind = relations.schema["video_id"].dataType.simpleString()
    edges = relations.filter(F.col("relation") == "BEFORE").select("video_id", F.col("event_a").cast("string").alias("event_a"), F.col("event_b").cast("string").alias("event_b")).distinct()
    return edges.groupBy("video_id").applyInPandas(search, f"video_id {kind}, cycle string").withColumn("cycle", F.split("cycle", "\x1f"))


def continuity(scenes: DataFrame, tolerance: float = 0.5, key: str = "video_id") -> DataFrame:
    """Scenes with prev_scene_id, next_scene_id, temporal_adjacency and, if there is ``objects``, subject_continuity.

    Continuity with the next scene is null where either has no object.
    """
    w = Window.partitionBy(key).orderBy("start_time", "scene_id")
    out = scenes.withColumn("prev_scene_id", F.lag("scene_id").over(w)).withColumn("next_scene_id", F.lead("scene_id").over(w)).withColumn("temporal_adjacency", F.coalesce(F.abs(F.lead("start_time").over(w) - F.col("end_time")) <= tolerance, F.lit(False)))
    if "objects" in scenes.columns:
        nxt = F.lead("objects").over(w)
        out = out.withColumn("subject_continuity", F.when((F.size("objects") > 0) & (F.size(nxt) > 0), F.arrays_overlap("objects", nxt)))
    return out


def continuity_faults(scenes: DataFrame, key: str = "video_id") -> DataFrame:
    """Links whose other end doesn't link back."""
    back = scenes.select(key, F.col("scene_id").alias("next_scene_id"), F.col("prev_scene_id").alias("back"))
    return scenes.filter("next_scene_id IS NOT NULL").join(back, [key, "next_scene_id"], "left").filter(~F.col("back").eqNullSafe(F.col("scene_id"))).select(key, "scene_id", "next_scene_id")


def state_changes(scenes: DataFrame, attributes: list[str], key: str = "video_id", order: str = "start_time", carry: list[str] | None = None) -> DataFrame:
    """(key, order, attribute, before, after) where a known attribute differs from the previous scene's.

    Columns that ``carry`` names come along for both scenes, as <name>_a and <name>_b.
    """
    w, carry = Window.partitionBy(key).orderBy(order), carry or []
    beside = [x for c in carry for x in (F.lag(c).over(w).alias(f"{c}_a"), F.col(c).alias(f"{c}_b"))]
    was = scenes.select(key, order, *attributes, *[F.lag(a).over(w).alias(f"_{a}") for a in attributes], *beside)
    changed = [F.when(F.col(f"_{a}") != F.col(a), F.struct(F.lit(a).alias("attribute"), F.col(f"_{a}").cast("string").alias("before"), F.col(a).cast("string").alias("after"))) for a in attributes]
    sides = [f"{c}_{n}" for c in carry for n in "ab"]
    return was.select(key, order, F.explode(F.array_compact(F.array(*changed))).alias("c"), *sides).select(key, order, "c.*", *sides)


def new_entities(scenes: DataFrame, objects: str = "objects", key: str = "video_id", order: str = "start_time") -> DataFrame:
    """Scenes with ``appeared``: objects that the previous scene didn't have; empty for a first scene."""
    was = F.lag(objects).over(Window.partitionBy(key).orderBy(order))
    return scenes.withColumn("appeared", F.when(was.isNull(), F.array().cast("array<string>")).otherwise(F.array_except(objects, was)))


def gap_islands(spans: DataFrame, keys: list[str], gap: float) -> DataFrame:
    """Spans of equal keys merged while the next starts at most ``gap`` after the latest end so far."""
    w = Window.partitionBy(*keys).orderBy("start_time", "end_time")
    reach = F.max("end_time").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("start_time") > reach + gap).cast("int"), F.lit(1))
    return spans.withColumn("_new", fresh).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "island").agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.count(F.lit(1)).alias("n"))


def bounded_runs(scenes: DataFrame, key: str = "video_id", gap: float = 0.5, longest: float = 120.0, most: int = 12, least: int = 2, shortest: float = 8.0) -> DataFrame:
    """(key, run, scene_ids, start_time, end_time, n): maximal runs of contiguous scenes, broken where a run
    would grow too long or too many. A flag column ``compatible`` (with the previous scene) is honoured.

    The reset on length makes a run depend on where the last one ended, so that a video is
    scanned in order; the scan streams over sorted partitions and holds one run at a time.
    """
    has_flag = "compatible" in scenes.columns
    kind = scenes.schema[key].dataType.simpleString()
    schema = StructType.fromDDL(f"{key} {kind}, run long, scene_ids array<string>, start_time double, end_time double, n long")
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        run: list[tuple] = []
        video, count = None, 0

        def close() -> None:
            nonlocal count
            if len(run) >= least and run[-1][2] - run[0][1] >= shortest:
                count += 1
                out.append((video, count, [r[0] for r in run], run[0][1], run[-1][2], len(run)))
            run.clear()

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(arrow)
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
            out.clear()
            return batch

        for batch in batches:
            for name, scene, s, e, fits in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if name != video:
                    close()
                    video, count = name, 0
                elif run and not (fits and abs(s - run[-1][2]) <= gap and e - run[0][1] <= longest and len(run) < most):
                    close()
                run.append((scene, s, e))
            yield made()
        close()
        yield made()

    flag = F.coalesce("compatible", F.lit(False)) if has_flag else F.lit(True)
    chosen = scenes.select(key, F.col("scene_id").cast("string").alias("scene"), F.col("start_time").cast("double").alias("s"), F.col("end_time").cast("double").alias("e"), flag.alias("fits"))
    return chosen.repartition(key).sortWithinPartitions(key, "s", "scene").mapInArrow(scan, schema)


def split_long(scenes: DataFrame, longest: float) -> DataFrame:
    """Scenes longer than ``longest`` as equal parts: part, start_time and end_time replaced."""
    n = F.greatest(F.lit(1), F.ceil((F.col("end_time") - F.col("start_time")) / longest))
    step = (F.col("end_time") - F.col("start_time")) / F.col("_n")
    parts = scenes.withColumn("_n", n).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    s, e = F.col("start_time"), F.col("end_time")
    return parts.withColumn("_s", s + step * F.col("part")).withColumn("end_time", F.when(F.col("part") == F.col("_n") - 1, e).otherwise(s + step * (F.col("part") + 1))).withColumn("start_time", F.col("_s")).drop("_s", "_n")


def merge_short(scenes: DataFrame, shortest: float, key: str = "video_id") -> DataFrame:
    """Scenes shorter than ``shortest`` merged into the one before, a leading one into the one after."""
    w = Window.partitionBy(key).orderBy("start_time", "scene_id")
    long_enough = (F.col("end_time") - F.col("start_time") >= shortest).cast("int")
    group = F.greatest(F.lit(1), F.sum(long_enough).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return scenes.withColumn("_g", group).groupBy(key, "_g").agg(F.min_by("scene_id", "start_time").alias("scene_id"), F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.count(F.lit(1)).alias("merged")).drop("_g")


def evenly_spaced(frames: DataFrame, k: int, key: str = "video_id", order: str = "t") -> DataFrame:
    """k of each key's n rows in order, the first and last included; all if there are no more than k."""
    n, rn = F.count(F.lit(1)).over(Window.partitionBy(key)), F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    wanted = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / max(1, k - 1)).cast("int"))
    return frames.withColumn("_n", n).withColumn("_rn", rn).filter((F.col("_n") <= k) | F.array_contains(wanted, F.col("_rn"))).drop("_n", "_rn")


def motion_peaks(samples: DataFrame, value: str = "change", level: float = 0.0, key: str = "video_id", order: str = "t") -> DataFrame:
    """Samples above both neighbours and ``level``; ends have one neighbour."""
    w = Window.partitionBy(key).orderBy(order)
    low = F.lit(float("-inf"))
    marked = samples.withColumn("_l", F.coalesce(F.lag(value).over(w), low)).withColumn("_r", F.coalesce(F.lead(value).over(w), low))
    return marked.filter((F.col(value) > level) & (F.col(value) > F.col("_l")) & (F.col(value) >= F.col("_r"))).drop("_l", "_r")


def renumbered(records: DataFrame, prefix: str, by: list[str], key: str = "video_id", width: int = 4, name: str = "event_id") -> DataFrame:
    """Ids by total order within a key, like event_0001."""
    return records.withColumn(name, ids.numbered(prefix, F.row_number().over(Window.partitionBy(key).orderBy(*by)), width))


def extract_events(*modalities: DataFrame) -> DataFrame:
    """One event table of several modalities, numbered in order of time within each video."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), modalities)
    return renumbered(merged, "event_", ["start_time", "end_time", "event_type"])
