"""Wrong answers and captions that are hard to tell from right ones, and other wordings of right ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text

#: Attributes that a caption may name and what stands against each.
OPPOSITES = {"pans left": "pans right", "pans right": "pans left", "tilts up": "tilts down", "tilts down": "tilts up", "zooms in": "zooms out", "zooms out": "zooms in", "dark lighting": "bright lighting", "bright lighting": "dark lighting", "dim lighting": "bright lighting"}


#: Lengths under eight seconds are told 2.5 times as long, others 0.4 times, and 4 seconds more where
#: that is no 2 seconds away.
SHORT, LONGER, SHORTER, FAR, MORE = 8.0, 2.5, 0.4, 2.0, 4.0


def told_apart(a: Column, b: Column) -> Column:
    """Whether two texts say different things: neither is empty or part of the other."""
    x, y = text.normalize_text(a), text.normalize_text(b)
    return (x != "") & ~y.contains(x) & ~x.contains(y)


def swapped(answer: Column) -> Column:
    """An ordered answer turned round, null if it isn't one: First a, then b; Before. or After."""
    said = F.trim(answer)
    pattern = r"^First (.+), then (.+)\.$"
    both = F.concat(F.lit("First "), F.regexp_extract(said, pattern, 2), F.lit(", then "), F.regexp_extract(said, pattern, 1), F.lit("."))
    return F.when(said.rlike(pattern), both).when(said.startswith("Before."), F.concat(F.lit("After."), F.substring(said, 8, 4096))).when(said.startswith("After."), F.concat(F.lit("Before."), F.substring(said, 7, 4096)))


def other_duration(answer: Column) -> Column:
    """An answer on a length with a plainly different one, null if it states none."""
    pattern = r"from (\d+(?:\.\d+)?)s to (\d+(?:\.\d+)?)s"
    start, end = (F.regexp_extract(answer, pattern, k).try_cast("double") for k in (1, 2))
    scaled = lambda length: F.round(length * F.when(length < SHORT, LONGER).otherwise(SHORTER), 1)
    new = text.bound(F.greatest(F.lit(0.1), end - start), lambda n: F.when(F.abs(scaled(n) - n) < FAR, F.round(n + MORE, 1)).otherwise(scaled(n)))
    said = lambda x: F.concat(text.bound(text.about(x["n"]), lambda a: F.concat(F.upper(F.substring(a, 1, 1)), F.substring(a, 2, 99))), F.lit(" (from "), F.format_string("%.1f", x["s"]), F.lit("s to "), F.format_string("%.1f", x["s"] + x["n"]), F.lit("s)."))
    return F.when(start.isNotNull() & end.isNotNull(), text.bound(F.struct(start.alias("s"), new.alias("n")), said))


def other_time(answer: Column, duration: Column, least: float = 5.0, share: float = 0.2) -> Column:
    """An answer on a start with a start far from it within the video, null if it states none or none is far enough."""
    t = F.regexp_extract(answer, r"starts at (\d+(?:\.\d+)?)s", 1).try_cast("double")
    step = F.greatest(F.lit(least), duration * share)
    new = F.when(t + step <= duration, t + step).otherwise(F.greatest(F.lit(0.0), t - step))
    said = lambda x: F.when(F.abs(x["n"] - x["t"]) >= 3, F.concat(F.lit("Around "), text.clock(x["n"]), F.lit(" (starts at "), F.format_string("%.1f", x["n"]), F.lit("s).")))
    return text.bound(F.struct(t.alias("t"), new.alias("n")), said)


def wrong_answers(questions: DataFrame, events: DataFrame, durations: DataFrame, most: int = 3, gap: float = 3.0, phrase: str = "event") -> DataFrame:
    """(video_id, question_id, rank, kind, negative): up to ``most`` wrong answers a question, the rule-made one first.

    Others are what happens ``gap`` seconds or more outside the evidence, in order of a hash;
    each has to differ from the answer and from the ones before it.
    """
    rule = F.when(F.col("type").isin("temporal_ordering", "multi_event", "before_after"), swapped(F.col("answer"))).when(F.col("type") == "duration", other_duration(F.col("answer"))).when(F.col("type") == "event_localization", other_time(F.col("answer"), F.col("duration")))
    kind = F.when(F.col("type") == "duration", F.lit("wrong_duration")).when(F.col("type") == "event_localization", F.lit("shifted_time")).otherwise(F.lit("swapped_order"))
    made = questions.join(durations, "video_id", "left").select("video_id", "question_id", "answer", kind.alias("kind"), rule.alias("negative"), F.lit(0).alias("_o"), F.lit("").alias("_h"))
    other = events.select("video_id", F.col("event_id").cast("string").alias("_e"), F.col("start_time").alias("_s"), F.col("end_time").alias("_t"), F.col(phrase).alias("_p"))
    outside = questions.join(other, "video_id").filter((F.col("_s") >= F.col("end_time") + gap) | (F.col("_t") <= F.col("start_time") - gap))
    # Of a video's events, only so many of the least hash can be needed.
    order = F.sha1(F.concat_ws("|", "question_id", "_e"))
    near = outside.withColumn("_h", order).withColumn("_n", F.row_number().over(Window.partitionBy("video_id", "question_id").orderBy("_h"))).filter(F.col("_n") <= 4 * most)
    borrowed = near.select("video_id", "question_id", "answer", F.lit("other_event").alias("kind"), text.sentence(F.col("_p")).alias("negative"), F.lit(1).alias("_o"), "_h")
    told = made.filter("negative IS NOT NULL").unionByName(borrowed).filter(told_apart(F.col("negative"), F.col("answer")))
    first = told.withColumn("_k", F.row_number().over(Window.partitionBy("video_id", "question_id", text.normalize_text(F.col("negative"))).orderBy("_o", "_h"))).filter("_k = 1")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("video_id", "question_id").orderBy("_o", "_h")))
    return ranked.filter(F.col("rank") <= most).select("video_id", "question_id", "rank", "kind", "negative")


def swapped_attribute(caption: Column) -> Column:
    """A caption with the first attribute that has an opposite turned into it; null if it names none."""
    return F.coalesce(*[F.when(F.lower(caption).contains(a), F.regexp_replace(caption, f"(?i){a}", b)) for a, b in OPPOSITES.items()])


def worded(frame: DataFrame, templates: list[str], fields: list[str], key: str, n: int = 2) -> DataFrame:
    """(key, wording, prompt): ``n`` wordings of a record's fields, templates chosen by a hash of its key; a template lacking a field isn't used."""
    rows = []
    for i, template in enumerate(templates):
        said, lacks = F.lit(template), F.lit(False)
        for f in fields:
            if "{" + f + "}" in template:
                said, lacks = F.replace(said, F.lit("{" + f + "}"), F.coalesce(F.col(f).cast("string"), F.lit(""))), lacks | F.col(f).isNull()
        rows.append(F.when(~lacks, F.struct(ids.unit_hash(f"wording {i}", F.col(key)).alias("u"), said.alias("prompt"))))
    chosen = F.slice(F.array_sort(F.array_compact(F.array(*rows))), 1, n)
    return frame.select(key, F.posexplode(chosen).alias("wording", "_c")).select(key, "wording", F.col("_c.prompt").alias("prompt"))
