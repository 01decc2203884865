"""Text functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words without content.
STOPWORDS = "a an and are as at be by for from in is it its of on or that the this to was were with".split()
_EMPTY = F.array


def normalize_text(text: Column) -> Column:
    """Lower case, every character but word characters, blanks, % and ' as a blank, blanks collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)[^\w\s%']", " "), r"(?U)\s+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(normalize_text(text), " "), lambda t: t != "")


def content_words(text: Column, stopwords: list[str] = STOPWORDS) -> Column:
    """Distinct tokens of two or more characters that are neither stop words nor digits."""
    return F.array_distinct(F.filter(tokens(text), lambda t: (F.length(t) > 1) & ~t.isin(stopwords) & ~t.rlike(r"^[0-9]+$")))


def shingles(words: Column, k: int = 3) -> Column:
    """Distinct runs of k words; a shorter text is one shingle, an empty one has none."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, k), " "))
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(runs))


def _ratio(a: Column, b: Column, both_empty: float) -> Column:
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(both_empty)).otherwise(F.size(F.array_intersect(a, b)) / either)


def jaccard(a: Column, b: Column) -> Column:
    """Of two word sets; two empty ones are alike."""
    return _ratio(a, b, 1.0)


def hash_jaccard(a: Column, b: Column) -> Column:
    """Of two fingerprint sets; an empty one is like nothing."""
    return _ratio(a, b, 0.0)


def containment(needle: Column, haystack: Column) -> Column:
    """Share of the needle's items in the haystack; 1 for an empty needle."""
    needle = F.array_distinct(needle)
    return F.when(F.size(needle) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(needle, haystack)) / F.size(needle))


def numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\d+(?:\.\d+)?"), F.lit(0))


def numeric_grounding(answer: Column, evidence: Column) -> Column:
    """Share of the answer's numbers that the evidence has; 1 if it has none."""
    return containment(numbers(answer), numbers(evidence))


def lexical_grounding(answer: Column, evidence: Column) -> Column:
    """Share of the answer's content words that the evidence has."""
    return containment(content_words(answer), content_words(evidence))


def specificity(text: Column) -> Column:
    """Distinct content words by all words; 0 for an empty text."""
    n = F.size(tokens(text))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.size(content_words(text)) / n)


def format_seconds(t: Column, decimals: int = 1) -> Column:
    """Half a last digit goes to the even one, which Java's own format doesn't do."""
    return F.format_string(f"%.{decimals}f seconds", F.bround(t, decimals))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def clock(t: Column) -> Column:
    """h:mm:ss, or m:ss below an hour; negative times count as zero."""
    s = F.bround(F.greatest(t, F.lit(0.0))).cast("long")
    h, m, r = (s / 3600).cast("long"), ((s % 3600) / 60).cast("long"), s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%d:%02d", m, r))


def about(seconds: Column) -> Column:
    """A duration in words, as coarse as it is long."""
    n = F.greatest(F.lit(1), F.bround(seconds).cast("int"))
    fives = (F.bround(seconds / 5) * 5).cast("int")
    minutes = seconds / 60
    return (
        F.when(seconds < 1, F.lit("less than a second"))
        .when(seconds < 10, F.concat(F.lit("about "), n.cast("string"), F.when(n == 1, F.lit(" second")).otherwise(F.lit(" seconds"))))
        .when(seconds < 60, F.concat(F.lit("about "), fives.cast("string"), F.lit(" seconds")))
        .when(minutes < 10, F.format_string("about %.1f minutes", minutes))
        .otherwise(F.concat(F.lit("about "), F.bround(minutes).cast("int").cast("string"), F.lit(" minutes")))
    )


def joined_and(items: Column) -> Column:
    """'a', 'a and b', 'a, b and c'; '' for none."""
    n = F.size(items)
    return F.when(n == 0, F.lit("")).when(n == 1, items[0]).otherwise(F.concat(F.array_join(F.slice(items, 1, n - 1), ", "), F.lit(" and "), F.element_at(items, -1)))


def sentence(text: Column) -> Column:
    """First letter upper case, and a full stop unless it ends in one of . ! ?"""
    t = F.trim(text)
    up = F.concat(F.upper(F.substring(t, 1, 1)), t.substr(F.lit(2), F.length(t)))
    return F.when(t == "", t).when(t.rlike(r"[.!?]$"), up).otherwise(F.concat(up, F.lit(".")))
