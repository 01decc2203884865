"""Camera labels as family and direction, and their agreement with measured motion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reasons import reasons

#: The directions that each family of movements has; "" is the family by itself.
DIRECTIONS = {
    "static": ("",),
    "pan": ("left", "right"),
    "tilt": ("up", "down"),
    "dolly": ("in", "out"),
    "zoom": ("in", "out"),
    "tracking": ("", "left", "right", "forward", "backward"),
    "orbit": ("", "clockwise", "counterclockwise"),
    "crane": ("", "up", "down"),
    "handheld": ("",),
    "fpv": ("",),
    "drone": ("",),
    "complex": ("",),
}
LABELS = tuple("_".join(filter(None, (f, d))) for f, ds in DIRECTIONS.items() for d in ds)
#: Families that flow alone cannot tell apart, and those that say nothing definite.
LOOKALIKE = (("zoom", "dolly"), ("tracking", "pan"), ("tracking", "tilt"))
INDEFINITE = ("unknown", "complex", "handheld")
#: Other spellings of directions.
SPELLINGS = {"counter_clockwise": "counterclockwise", "counter-clockwise": "counterclockwise", "anticlockwise": "counterclockwise", "forwards": "forward", "backwards": "backward", "inward": "in", "outward": "out"}


def label(text: Column) -> Column:
    """A stored label as one of the known ones, else unknown."""
    t = F.regexp_replace(F.lower(F.trim(text)), r"\s+", "_")
    return F.when(t.isin(*LABELS), t).otherwise(F.lit("unknown"))


def family(text: Column) -> Column:
    return F.substring_index(label(text), "_", 1)


def direction(text: Column) -> Column:
    """The direction of a label, null if it has none."""
    known = label(text)
    return F.when(F.contains(known, F.lit("_")), F.substring_index(known, "_", -1))


def from_parts(family_: Column, direction_: Column) -> Column:
    """The label of a family and a direction: the family alone if it doesn't have that direction, unknown if it can't stand alone."""
    spelt = F.regexp_replace(F.lower(F.trim(direction_)), r"\s+", "_")
    d = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair]), spelt), spelt)
    f = F.lower(F.trim(family_))
    whole = F.concat_ws("_", f, F.when(d != "", d))
    return F.when(whole.isin(*LABELS), whole).when(f.isin(*LABELS), f).otherwise(F.lit("unknown"))


def agreement(stated: Column, measured: Column, consistency: Column, least: float = 0.6) -> Column:
    """(state, ambiguous, why) of a stated label against that measured from flow.

    Nothing to compare is not_applicable. One family passes if enough samples say so, and always
    if nothing moves. All else fails for review; it is ambiguous where the flow cannot decide.
    """
    a, b = family(stated), family(measured)
    weak = F.coalesce(consistency, F.lit(0.0)) < least
    alike = F.lit(False)
    for x, y in LOOKALIKE:
        alike = alike | ((a == x) & (b == y)) | ((a == y) & (b == x))
    unknown = (a == "unknown") | measured.isNull()
    same = a == b
    told = lambda state, ambiguous, why: F.struct(F.lit(state).alias("state"), F.lit(ambiguous).alias("ambiguous"), F.lit(why).alias("why"))
    return (
        F.when(unknown, told("not_applicable", False, "nothing_to_compare"))
        .when(same & ((a == "static") | ~weak), told("passed", False, "same_family"))
        .when(same, told("failed", True, "inconsistent_flow"))
        .when(alike, told("failed", True, "look_alike"))
        .when(b.isin(*INDEFINITE) | weak, told("failed", True, "inconclusive_flow"))
        .otherwise(told("failed", False, "other_family"))
    )


def stabilisation(text: Column) -> Column:
    """Words for how steady a shot is, as one of three, else unknown."""
    t = F.lower(F.trim(text))
    return F.when(t.rlike(r"tripod|locked|stab|gimbal|steady|smooth"), F.lit("stabilized")).when(t.rlike(r"slight|mild|minor"), F.lit("slightly_shaky")).when(t.rlike(r"shak|hand|jitter"), F.lit("shaky")).otherwise(F.lit("unknown"))


def depth_of_field(text: Column) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t.rlike(r"shallow|bokeh|blurr"), F.lit("shallow")).when(t.rlike(r"deep|everything|all in focus"), F.lit("deep")).when(t.rlike(r"medium|moderate"), F.lit("medium")).otherwise(F.lit("unknown"))


def video_flags(width: Column, height: Column, fps: Column, duration: Column, audio: Column, least_edge: int = 360, least_fps: float = 15.0, shortest: float = 2.0) -> Column:
    """Faults of a whole video that its probe shows."""
    return reasons((F.least(width, height) < least_edge, "low_resolution"), (fps < least_fps, "low_frame_rate"), (duration < shortest, "too_short"), (~audio, "no_audio"))
