"""Answers of models as records: JSON with text around it, loose numbers, words of a vocabulary."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.S)


def first_object(text: str | None) -> str | None:
    """The first JSON object in an answer as compact JSON, null if there is none.

    Fences are taken off; trailing commas, single quotes and a missing end are mended, each
    only if the text isn't JSON without it.
    """
    if not text:
        return None
    fenced = FENCE.search(text)
    body = fenced[1] if fenced else text
    at = body.find("{")
    if at < 0:
        return None
    body = body[at:]
    mended = re.sub(r",\s*([}\]])", r"\1", body)
    for tried in (body, mended, mended.replace("'", '"'), _closed(mended)):
        try:
            value, _ = json.JSONDecoder().raw_decode(tried)
        except ValueError:
            continue
        if isinstance(value, dict):
            return json.dumps(value, sort_keys=True, separators=(",", ":"))
    return None


def _closed(text: str) -> str:
    """The text with what is open at its end closed, without a value cut short."""
    open_, quoted, escaped = [], False, False
    for c in text:
        if escaped:
            escaped = False
        elif c == "\\":
            escaped = quoted
        elif c == '"':
            quoted = not quoted
        elif not quoted and c in "{[":
            open_.append("}" if c == "{" else "]")
        elif not quoted and c in "}]" and open_:
            open_.pop()
    return re.sub(r"[,:]\s*$", "", text + '"' * quoted) + "".join(reversed(open_))


@F.pandas_udf(StringType())
def answer_json(text: pd.Series) -> pd.Series:
    return text.map(first_object)


def loose_number(text: Column) -> Column:
    """The first number in a text, with a comma or a point before its decimals: 3,5 and 3.5mm are 3.5."""
    return F.regexp_replace(F.regexp_extract(text, r"(-?\d+(?:[.,]\d+)?)", 1), ",", ".").try_cast("double")


def one_of(text: Column, vocabulary: list[str], default: str = "unknown") -> Column:
    """A text as a word of a vocabulary: the same word but for case, blanks and dashes, else the longest that the text holds."""
    t = F.regexp_replace(F.lower(F.trim(text)), r"[\s-]+", "_")
    by_length = sorted(vocabulary, key=lambda w: (-len(w), w))
    return F.when(t.isin(*vocabulary), t).otherwise(F.coalesce(*[F.when(t.contains(w), F.lit(w)) for w in by_length], F.lit(default)))
