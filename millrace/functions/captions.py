"""Caption and measurement rules as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reasons import reasons
from .text import joined_and

# Phrases that commit a text to a camera movement, and what they commit it to.
MOVEMENTS = {
    "pan_left": r"\bpan(?:s|ning)?\s+(?:to\s+the\s+)?left\b",
    "pan_right": r"\bpan(?:s|ning)?\s+(?:to\s+the\s+)?right\b",
    "tilt_up": r"\btilt(?:s|ing)?\s+up\b",
    "tilt_down": r"\btilt(?:s|ing)?\s+down\b",
    "zoom_in": r"\bzoom(?:s|ing)?\s+in\b",
    "zoom_out": r"\bzoom(?:s|ing)?\s+out\b",
    "static": r"\b(?:static|stationary|fixed|still)\s+camera\b|\bcamera\s+(?:is|stays|remains)\s+(?:static|still|stationary|fixed)\b",
}
# Brightness bands of lighting words, and how far outside one contradicts the word.
LIGHT = {"dark": (0.0, 50.0), "dim": (50.0, 95.0), "normal": (95.0, 170.0), "bright": (170.0, 256.0)}
LIGHT_SLACK = 20.0
# Texts that stand for no text.
PLACEHOLDERS = ("unknown", "unmeasured", "n/a", "null", "none")


class Limit(NamedTuple):
    """A flag for a measure outside an open or closed side."""

    measure: str
    flag: str
    least: float | None = None
    most: float | None = None


#: Limits of a shot's measures, and what lies outside is called.
SHOT_LIMITS = (Limit("sharpness", "blurry", least=40.0), Limit("dark", "underexposed", most=0.7), Limit("bright", "overexposed", most=0.5), Limit("blockiness", "compression_artifacts", most=1.8))
#: A camera movement in words. Parts in which a field is named vanish if it is unknown.
CAMERA_WORDS = {
    "pan": ("{speed} ", "pan", " to the {direction}"),
    "tilt": ("{speed} ", "tilt", " {direction}"),
    "dolly": ("{speed} ", "dolly", " {direction}"),
    "zoom": ("{speed} ", "zoom", " {direction}"),
    "crane": ("{speed} ", "crane", " {direction}"),
    "tracking": ("{speed} ", "tracking shot", " moving {direction}"),
    "orbit": ("{speed} ", "camera orbiting the subject", " {direction}"),
    "static": ("static camera",),
    "handheld": ("handheld camera",),
    "fpv": ("first-person camera",),
    "drone": ("drone shot",),
    "complex": ("complex camera movement",),
}


def movements(text: Column) -> Column:
    """Camera movements that a text claims."""
    low = F.lower(text)
    return reasons(*[(low.rlike(pattern), name) for name, pattern in MOVEMENTS.items()])


def family(movement: Column) -> Column:
    return F.element_at(F.split(movement, "_"), 1)


def contradictions(text: Column, said: Column | None = None) -> Column:
    """Claims of one text that cannot all hold: two directions of a family, or static and moving.

    ``said``: its ``movements``, where they are a column already, so that no pattern is looked for again.
    """
    said = movements(text) if said is None else said
    has = lambda m: F.array_contains(said, m)
    both = [(has(a) & has(b), f"{a.split('_')[0]}_in_two_directions") for a, b in (("pan_left", "pan_right"), ("tilt_up", "tilt_down"), ("zoom_in", "zoom_out"))]
    return reasons(*both, (has("static") & (F.size(said) > 1), "static_and_moving"))


def camera_conflicts(text: Column, movement: Column, said: Column | None = None) -> Column:
    """(hard, soft) ways in which a caption disagrees with the camera field; ``said`` as in ``contradictions``."""
    said = movements(text) if said is None else said
    own, known = family(movement), F.coalesce(movement, F.lit("unknown")) != "unknown"
    opposite = F.exists(said, lambda m: (family(m) == own) & (m != movement) & (own != "static"))
    static_said, moving_said = F.array_contains(said, "static"), F.exists(said, lambda m: m != "static")
    other = F.exists(said, lambda m: (family(m) != own) & (m != "static"))
    hard = reasons((known & opposite, "opposite_direction"), (known & static_said & (own != "static"), "said_static"), (known & moving_said & (own == "static"), "said_moving"))
    return F.struct(hard.alias("hard"), reasons((known & other & own.isin("pan", "tilt", "zoom"), "other_movement")).alias("soft"))


def light_conflict(label: Column, brightness: Column) -> Column:
    """Whether a lighting word is far from the measured brightness; null if either is unknown."""
    out = None
    for word, (low, high) in LIGHT.items():
        far = (brightness < low - LIGHT_SLACK) | (brightness > high + LIGHT_SLACK)
        out = F.when(F.lower(F.trim(label)) == word, far) if out is None else out.when(F.lower(F.trim(label)) == word, far)
    return out


def outside(limits: Iterable[Limit], **measures: Column) -> Column:
    """The flags of the limits that a measure breaks, in the limits' order; an unknown measure breaks none."""
    rules = []
    for limit in limits:
        if limit.measure in measures:
            value = measures[limit.measure]
            rules += [(value < limit.least, limit.flag)] if limit.least is not None else []
            rules += [(value > limit.most, limit.flag)] if limit.most is not None else []
    return reasons(*rules)


def motionless(series: dict[str, tuple[Column, float, bool]], duration: Column, shortest: float = 2.0, samples: int = 3) -> Column:
    """Whether every series of a shot stays at its level.

    A series is an array of samples, its highest level and whether it must be there; each must
    have ``samples`` of them. A shot that is too short is never motionless.
    """
    holds = duration >= shortest
    for values, level, needed in series.values():
        still = (F.size(values) >= samples) & ~F.exists(values, lambda v: v > level)  # noqa: B023
        holds = holds & (F.coalesce(still, F.lit(False)) if needed else (values.isNull() | (F.size(values) == 0) | still))
    return holds


def filled(parts: Iterable[str], **fields: Column) -> Column:
    """The parts one after the other, each with its ``{field}`` filled in; a part whose field is null is left out."""
    out = []
    for part in parts:
        name = re.search(r"\{(\w+)\}", part)
        out.append(F.lit(part) if name is None else F.coalesce(F.concat(F.lit(part[: name.start()]), fields[name[1]], F.lit(part[name.end() :])), F.lit("")))
    return F.concat(*out)


def caption_faults(text: Column, shortest: int = 12, longest: int = 1200) -> Column:
    """Why a caption isn't fit: its length, placeholders, markup left over, repeated words."""
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    words = F.split(low, r"\s+")
    return reasons(
        (low == "", "empty"),
        ((low != "") & (F.length(low) < shortest), "too_short"),
        (F.length(low) > longest, "too_long"),
        (low.isin(*PLACEHOLDERS), "placeholder"),
        (low.rlike(r"[{}<>]|```|\bas an ai\b"), "residue"),
        ((F.size(words) >= 6) & (F.size(F.array_distinct(words)) * 2 < F.size(words)), "repetitive"),
    )


def camera_phrase(movement: Column, direction: Column, speed: Column) -> Column:
    """A camera block in words; null if the movement has none."""
    return F.coalesce(*[F.when(movement == name, filled(parts, direction=direction, speed=speed)) for name, parts in CAMERA_WORDS.items()])


def generation_prompt(duration: Column, shot: Column, subjects: Column, setting: Column, time_of_day: Column, camera: Column, lighting: Column, actions: Column) -> Column:
    """A text-to-video prompt from measured fields; null if nothing but timing is known."""
    head = F.concat(F.lit("A "), F.coalesce(F.format_string("%.0f-second ", duration), F.lit("")), F.coalesce(F.concat(shot, F.lit(" shot")), F.lit("shot")))
    subject = F.when(F.size(subjects) > 0, F.concat(F.lit("of "), joined_and(F.slice(subjects, 1, 3))))
    place = F.when(setting == "indoor", F.lit("indoors")).when(setting == "outdoor", F.lit("outdoors"))
    when = F.when(time_of_day.isin("day", "daytime"), F.lit("in daylight")).when(time_of_day.isin("night", "nighttime"), F.lit("at night")).otherwise(F.concat(F.lit("at "), time_of_day))
    details = F.concat_ws(", ", camera, F.concat(lighting, F.lit(" lighting")))
    acted = F.concat_ws("; ", F.slice(actions, 1, 3))
    text = F.concat(F.concat_ws(" ", head, subject, place, when), F.when(acted != "", F.concat(F.lit("; "), acted)).otherwise(F.lit("")), F.when(details != "", F.concat(F.lit(", "), details)).otherwise(F.lit("")), F.lit("."))
    bare = subject.isNull() & place.isNull() & when.isNull() & (details == "") & (acted == "")
    return F.when(~bare, text)


def url_kind(url: Column) -> Column:
    """invalid, video, playlist, channel or other, by host and path."""
    host, path = F.lower(F.try_parse_url(url, F.lit("HOST"))), F.try_parse_url(url, F.lit("PATH"))
    query = F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit(""))
    return F.when(host.isNull() | ~F.lower(url).rlike("^https?://"), F.lit("invalid")).when(query.rlike(r"(^|&)v=") | path.rlike(r"^/(shorts|embed)/"), F.lit("video")).when(query.rlike(r"(^|&)list="), F.lit("playlist")).when(path.rlike(r"^/(@|channel/|c/|user/)"), F.lit("channel")).otherwise(F.lit("other"))
