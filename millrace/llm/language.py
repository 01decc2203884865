"""Language identification by multilingual mixture inference.

Each language has a model of hashed byte trigrams. A word's likelihood under a language is the
product over its letters; a document's language shares are the weights of the mixture that
makes its words likeliest, found by expectation-maximisation; and the set of languages is the
one whose likelihood, less a penalty for each member, is greatest. One more member of every
mixture, under which all trigrams are equally likely, takes the words of no learned language.

A document's words are counted first, and its mixture is inferred from the distinct ones by
their counts: work and memory follow its vocabulary, and nothing depends on which documents
are inferred beside it.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, struct

BUCKET_BITS = 15
UNKNOWN = "und"
#: ASCII letters as lower case, other ASCII as blanks; bytes of other characters stay.
LETTERS = bytes((b + 32) if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of a text whose words are counted at a time, and of distinct words inferred together.
PIECE_BYTES, GROUP_BYTES = 1 << 20, 200_000
#: A word's likelihood ratio between languages is held within e to this power.
STRETCH = 12.0


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # languages x buckets


def counted(text: bytes) -> Counter:
    """How often each word of a lower-cased text occurs. A very long text is taken piece by piece."""
    words: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + PIECE_BYTES
        if end < len(text):
            blank = text.find(b" ", end)
            end = len(text) if blank < 0 else blank
        words.update(text[at:end].translate(LETTERS).split())
        at = end
    return words


def _grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram around each letter of the words, where each word starts among those)."""
    flat = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    inner = np.flatnonzero(flat != 32)
    code = (flat[inner - 1].astype(np.uint32) << 16) | (flat[inner].astype(np.uint32) << 8) | flat[inner + 1]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS), np.flatnonzero(flat[inner - 1] == 32)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 1500, smoothing: float = 0.5) -> Model:
    """Fit on labelled rows: about ``rows_per_language`` of each language, chosen by a hash of the id.

    Rows without a language, a text or an id teach nothing; repeated rows teach as often as they
    stand there. An empty table gives a model without languages.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 1 << BUCKET_BITS), np.float32))
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1_000_000, rows_per_language * 1_000_000 // sizes[k])))])
    sample = labelled.filter(place < share[F.col("lang")]).select("lang", "text")

    def rows(batch: pa.RecordBatch) -> list:
        tables: dict[str, np.ndarray] = {}
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = counted(text.lower().encode())
            if words:
                buckets, starts = _grams(list(words))
                times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.diff(np.append(starts, len(buckets))))
                table = tables.setdefault(name, np.zeros(1 << BUCKET_BITS, np.int64))
                np.add.at(table, buckets, times)
        out: list[list] = [[], [], []]
        for name, table in sorted(tables.items()):
            used = np.flatnonzero(table)
            for column, values in zip(out, ([name] * len(used), used.tolist(), table[used].tolist()), strict=True):
                column += values
        return out

    seen = arrow_map(sample, struct(("lang", "string"), ("bucket", "int"), ("n", "bigint")), rows).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.full((len(languages), 1 << BUCKET_BITS), smoothing)
    np.add.at(table, (seen["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(np.int64), seen["bucket"].to_numpy(np.int64)), seen["n"].to_numpy(np.float64))
    return Model(languages, np.log(table / table.sum(1, keepdims=True)).astype(np.float32))


def infer(model: Model, texts: list[bytes], rounds: int = 50, penalty: float = 1.0) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """(words, shares, members, other) of each text: shares among the chosen languages, which those are, and the share of words of none.

    Each text's mixture moves until it stands still by itself. A text without words has no member.
    """
    size = len(model.languages)
    shares, members, other = np.full((len(texts), size), 1 / max(1, size)), np.zeros((len(texts), size), bool), np.zeros(len(texts))
    bags = [counted(t) for t in texts]
    full = [k for k, bag in enumerate(bags) if bag] if size else []
    for group in _groups([sum(map(len, bags[k])) for k in full]):
        rows = [full[g] for g in group]
        shares[rows], members[rows], other[rows] = _mixtures(model, [bags[k] for k in rows], rounds, penalty)
    return [bag.total() for bag in bags], shares, members, other


def _mixtures(model: Model, bags: list[Counter], rounds: int, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buckets, starts = _grams([w for bag in bags for w in bag])
    times = np.fromiter((n for bag in bags for n in bag.values()), np.float64)
    letters = np.diff(np.append(starts, len(buckets)))
    noise = -letters * np.log(1 << BUCKET_BITS)
    likely = np.stack([*(np.add.reduceat(p[buckets], starts, dtype=np.float64) for p in model.log_p), noise], 1)
    likely = np.exp(np.maximum(likely - likely.max(1, keepdims=True), -STRETCH))
    n = np.array([len(bag) for bag in bags])
    doc, first = np.repeat(np.arange(len(bags)), n), np.cumsum(n) - n
    words = np.add.reduceat(times, first)
    pi = np.full((len(bags), likely.shape[1]), 1 / likely.shape[1])
    moving = np.ones(len(bags), bool)
    for _ in range(rounds):
        part = pi[doc] * likely
        part *= (times / part.sum(1))[:, None]
        new = np.add.reduceat(part, first, axis=0) / words[:, None]
        moved = np.abs(new - pi).max(1)
        pi[moving] = new[moving]
        moving &= moved >= 1e-3
        if not moving.any():
            break
    named = pi[:, :-1]
    rank = np.argsort(np.argsort(-named, axis=1, kind="stable"), axis=1)
    best, size = np.full(len(bags), -np.inf), np.zeros(len(bags), np.int64)
    for k in range(1, named.shape[1] + 1):
        only = np.where(rank < k, np.maximum(named, 1e-9), 0)
        only = np.concatenate([only * ((1 - pi[:, -1:]) / only.sum(1, keepdims=True)), pi[:, -1:]], 1)
        fit = np.add.reduceat(times * np.log(np.maximum((only[doc] * likely).sum(1), 1e-300)), first) - penalty * k * np.log1p(words)
        size[fit > best] = k
        best = np.maximum(best, fit)
    chosen = rank < size[:, None]
    kept = np.where(chosen, np.maximum(named, 1e-9), 0)
    return kept / kept.sum(1, keepdims=True), chosen, pi[:, -1]


def _groups(sizes: list[int]) -> list[list[int]]:
    """Neighbours taken together, up to ``GROUP_BYTES``."""
    groups, total = [], 0
    for k, n in enumerate(sizes):
        if not groups or total + n > GROUP_BYTES:
            groups.append([])
            total = 0
        groups[-1].append(k)
        total += n
    return groups


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, lang_pred, score, other, languages.

    ``lang_pred`` is the language of the largest share, of equal ones the first by name, and
    ``score`` that share within the chosen set; ``languages`` lists the set, largest first;
    ``other`` is the share of the words that no language explains. A text that is null or has no
    letter, and any text if the model has no language, is ``und`` with score 0. Null ids and
    repeated rows are judged each on its own; other columns, whatever their names, aren't read.
    An empty table gives none. Very long texts are counted in pieces.
    """
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = struct(("_id", docs.schema[id_col].dataType), ("n_words", "bigint"), ("lang_pred", "string"), ("score", "double"), ("other", "double"), ("languages", "array<struct<lang: string, share: double>>"))
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_p))

    def rows(batch: pa.RecordBatch) -> list:
        known = Model(*sent.value)
        texts = batch.column(1).to_pylist()
        words, shares, members, other = infer(known, [t.lower().encode() if t else b"" for t in texts])
        names, scores, sets = [], [], []
        for text, share, among in zip(texts, shares, members, strict=True):
            if not among.any() or not lettered(text):
                names.append(UNKNOWN), scores.append(0.0), sets.append([])
                continue
            order = sorted(np.flatnonzero(among), key=lambda k: (-share[k], k))  # noqa: B023
            names.append(known.languages[order[0]]), scores.append(round(float(share[order[0]]), 9))
            sets.append([{"lang": known.languages[k], "share": round(float(share[k]), 9)} for k in order])
        return [batch.column(0), words, names, scores, other.round(9).tolist(), sets]

    return arrow_map(chosen, schema, rows).withColumnRenamed("_id", id_col)


def lettered(text: str) -> bool:
    return any(map(str.isalpha, text))
