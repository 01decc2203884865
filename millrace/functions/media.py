"""Functions at the media edge: Arrow-batched, for pixels and text that no expression reaches."""

from __future__ import annotations

import difflib
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(StringType())
def dhash(pixels: pd.Series) -> pd.Series:
    """Of 72 grey values, 8 rows of 9: 16 hex digits that say where brightness rises to the right."""

    def one(values: object) -> str | None:
        if values is None or len(values) != 72:
            return None
        grid = np.asarray(values, float).reshape(8, 9)
        return f"{int.from_bytes(np.packbits(grid[:, 1:] > grid[:, :-1]).tobytes(), 'big'):016x}"

    return pixels.map(one, na_action="ignore")


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matched characters by all characters; null with null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def one_edit(a: Column, b: Column) -> Column:
    """At most one insertion, deletion or replacement apart."""
    return F.levenshtein(a, b, 1) >= 0


def camera_label(dx: Column, dy: Column, magnitude: Column, divergence: Column, still: float = 0.3, zoom: float = 0.02) -> Column:
    """A camera movement from mean optical flow: the scene moves against the camera."""
    return (
        F.when(magnitude < still, F.lit("static"))
        .when(F.abs(divergence) >= zoom, F.when(divergence > 0, F.lit("zoom_in")).otherwise(F.lit("zoom_out")))
        .when(F.abs(dx) >= F.abs(dy), F.when(dx > 0, F.lit("pan_left")).otherwise(F.lit("pan_right")))
        .otherwise(F.when(dy > 0, F.lit("tilt_up")).otherwise(F.lit("tilt_down")))
    )


def box_iou(a: Column, b: Column) -> Column:
    """Of boxes (x1, y1, x2, y2)."""
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    area = lambda r: (r["x2"] - r["x1"]) * (r["y2"] - r["y1"])
    both = area(a) + area(b) - w * h
    return F.when(both <= 0, F.lit(0.0)).otherwise(w * h / both)
