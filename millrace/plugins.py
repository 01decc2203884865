"""The media edge: models as batch functions over rows, each with a mock that needs no model.

A provider turns a batch of inputs into a batch of results; ``apply`` runs one over a column in
Arrow batches and makes it once in each Python worker. Retries and rate limits live here, at the
edge, and nowhere in the relational core.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Provider(Protocol):
    name: str

    def batch(self, inputs: Sequence[object]) -> list[object]: ...


class MockAnalyzer:
    """Deterministic scene labels from the input's hash."""

    name = "mock"
    LABELS = ("static", "pan_left", "pan_right", "zoom_in")

    def batch(self, inputs: Sequence[object]) -> list[object]:
        return [None if x is None else self.LABELS[hashlib.sha1(str(x).encode()).digest()[0] % 4] for x in inputs]


class MockTranscriber:
    """Echoes its input as words."""

    name = "mock"

    def batch(self, inputs: Sequence[object]) -> list[object]:
        return [None if x is None else " ".join(str(x).split()) for x in inputs]


class MockReader:
    """On-screen text as JSON detections (text, score, box) of an input's words in capitals."""

    name = "mock"

    def batch(self, inputs: Sequence[object]) -> list[object]:
        words = lambda x: [w for w in str(x).split() if w.isupper() and len(w) > 1]
        return [None if x is None else json.dumps([{"text": w, "score": 0.9, "box": [0.1 * k, 0.8, 0.1 * k + 0.1, 0.9]} for k, w in enumerate(words(x))]) for x in inputs]


class MockSounds:
    """Sound events as JSON (label, start, end) of an input's hash."""

    name = "mock"
    LABELS = ("Speech", "Music", "Dog", "Silence")

    def batch(self, inputs: Sequence[object]) -> list[object]:
        return [None if x is None else json.dumps([{"label": self.LABELS[_place(x, 4)], "start": 0.0, "end": 1.0 + _place(x, 3)}]) for x in inputs]


class FixedScenes:
    """Cuts at equal steps, for a duration in seconds: JSON of (start, end)."""

    name = "fixed"

    def __init__(self, step: float = 10.0):
        self.step = step

    def batch(self, inputs: Sequence[object]) -> list[object]:
        return [None if x is None else json.dumps([[k * self.step, min(float(x), (k + 1) * self.step)] for k in range(max(1, -int(-float(x) // self.step)))]) for x in inputs]


class WordVerifier:
    """A claim ("text|||evidence") is supported by the share of its words that the evidence has."""

    name = "words"

    def batch(self, inputs: Sequence[object]) -> list[object]:
        def score(x: object) -> str:
            said, _, held = str(x).partition("|||")
            words = set(said.lower().split())
            share = len(words & set(held.lower().split())) / max(1, len(words))
            return json.dumps({"score": round(share, 3), "state": "passed" if share >= 0.5 else "failed"})

        return [None if x is None else score(x) for x in inputs]


class MockModel:
    """A language model's answer: JSON with its prompt's digest, as a real one would be parsed."""

    name = "mock"

    def batch(self, inputs: Sequence[object]) -> list[object]:
        return [None if x is None else "Here it is: " + json.dumps({"answer": hashlib.sha1(str(x).encode()).hexdigest()[:8], "confidence": 0.5}) for x in inputs]


class Rewording:
    """Other words for a question, by a small table; a question without any stays."""

    name = "table"
    TABLE = (("What happens", "What takes place"), ("Approximately how long", "About how long"), ("Which happens first", "Which comes first"))

    def batch(self, inputs: Sequence[object]) -> list[object]:
        def other(x: str) -> str:
            return next((x.replace(a, b, 1) for a, b in self.TABLE if x.startswith(a)), x)

        return [None if x is None else other(str(x)) for x in inputs]


class MockEnricher:
    """A score in [0, 1] of an input's hash, as an aesthetic model gives one."""

    name = "mock"

    def batch(self, inputs: Sequence[object]) -> list[object]:
        return [None if x is None else f"{_place(x, 1000) / 1000:.3f}" for x in inputs]


def _place(x: object, n: int) -> int:
    return int.from_bytes(hashlib.sha1(str(x).encode()).digest()[:4]) % n


class NullProvider:
    """Runs nothing: every result is unknown, which later checks read as not_run."""

    name = "null"

    def batch(self, inputs: Sequence[object]) -> list[object]:
        return [None] * len(inputs)


PROVIDERS: dict[str, Callable[[], Provider]] = {"mock_vision": MockAnalyzer, "mock_speech": MockTranscriber, "mock_ocr": MockReader, "mock_sounds": MockSounds, "fixed_scenes": FixedScenes, "word_verifier": WordVerifier, "mock_model": MockModel, "rewording": Rewording, "mock_enricher": MockEnricher, "null": NullProvider}
_MADE: dict[str, Provider] = {}


def register(name: str, make: Callable[[], Provider]) -> None:
    PROVIDERS[name] = make


def retried(call: Callable[[], list], attempts: int = 3, wait: float = 0.0) -> list:
    for k in range(attempts):
        try:
            return call()
        except (OSError, TimeoutError):
            if k + 1 == attempts:
                raise
            time.sleep(wait * 2**k)
    return []


class TokenBucket:
    """At most ``rate`` calls a second on average, with bursts of ``burst``."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
        self.at = now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            self.tokens, self.at = 1.0, self.clock()
        self.tokens -= 1


def apply(provider: str, column: Column, returns: str = "string") -> Column:
    """A provider over a column."""
    make = PROVIDERS[provider]

    @F.pandas_udf(returns)
    def run(values: pd.Series) -> pd.Series:
        if provider not in _MADE:
            _MADE[provider] = make()
        return pd.Series(retried(lambda: _MADE[provider].batch([None if pd.isna(v) else v for v in values])), dtype=object)

    return run(column)
