"""Substring dedup over a log-structured index of window fingerprints.

The index of all earlier batches is a table of sorted immutable runs, in buckets by ranges of
the fingerprint: of each window its 128-bit fingerprint and smallest document, and of each
window's smallest five-word fingerprint (a sieve) that alone. A new batch is dealt to shards of a
bounded number of characters; each makes sorted runs of its own, and one merge a bucket joins
them with history's. A merge answers each run with one bit an entry: does a smaller document
start this window? Answers are a hundredth of the index, so that neither windows nor texts
travel back. At the end the batch's runs and history's are compacted to one run a bucket.

Most windows occur once. Two equal windows share the smallest of the nine five-word
fingerprints inside them, so a batch first merges its sieve, a fifth of its words, with
history's, and only windows whose smallest one is in history or in two documents go on.

Within a shard every fingerprint has one entry, so a passage that a third of all documents
hold costs its bucket one entry a shard, not one a document. Fingerprints match on 64 bits and
are verified on 64 more, from an independent polynomial of the words' XXH64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..runtime import durable, shuffle_width
from .common import as_bytes, struct

WINDOW, GRAM = 13, 5
SHARD_CHARS = 4_000_000
#: Entries of a bucket, about, and of one stored piece of a run at most: cells of 8 MB.
BUCKET_ENTRIES, RUN_ENTRIES = 4_000_000, 1_000_000
GRAMS, WINDOWS = 0, 1
CACHED_WORDS = 400_000
MULTIPLIERS = tuple(np.uint64(int.from_bytes(hashlib.sha256(f"window polynomial {k}".encode()).digest()[:8], "little") | 1) for k in range(3))
LAST = np.iinfo(np.int64).max

BLOB = struct(("kind", "int"), ("bucket", "int"), ("shard", "int"), ("first", "binary"), ("second", "binary"), ("docs", "binary"))
ANSWER = struct(("shard", "int"), ("step", "int"), ("bucket", "int"), ("bits", "binary"))


class _Hashes(dict):
    """XXH64 of words, remembered for the latest few hundred thousand."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _polynomial(codes: np.ndarray, width: int, multiplier: np.uint64) -> np.ndarray:
    """A mixed fingerprint of every run of ``width`` codes."""
    n = max(0, len(codes) - width + 1)
    total = codes[:n].copy()
    for k in range(1, width):
        total *= multiplier
        total += codes[k : k + n]
    total ^= total >> np.uint64(31)
    total *= multiplier
    total ^= total >> np.uint64(29)
    return total


class _Shard:
    """The windows of a shard's documents, by flat arrays."""

    def __init__(self, table: pa.Table, window: int):
        self.ids = table.column("id")
        self.docs = np.array(self.ids.fill_null(LAST).to_numpy(), np.int64)
        self.texts = table.column("text")
        cache, parts = _Hashes(), []
        for chunk in self.texts.chunks:
            for text in as_bytes(chunk):
                words = text.split() if text else []
                parts.append(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.codes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        counts = np.maximum(0, self.sizes - window + 1)
        self.row = np.repeat(np.arange(len(parts)), counts)
        before = np.cumsum(counts) - counts
        self.start = np.arange(len(self.row)) - np.repeat(before - (self.ends - self.sizes), counts)
        self.window = window

    def smallest_grams(self) -> np.ndarray:
        """Of each window the smallest fingerprint of its grams."""
        grams = _polynomial(self.codes, GRAM, MULTIPLIERS[0])
        least = grams
        for k in range(1, self.window - GRAM + 1):
            n = len(grams) - k
            least = np.minimum(least[:n], grams[k : k + n])
        return least[self.start] if len(self.start) else np.zeros(0, np.uint64)

    def fingerprints(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.start[chosen]
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return tuple(_polynomial(self.codes, self.window, m)[at] for m in MULTIPLIERS[1:])


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order of the keys, and where each distinct key starts in it."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    if not len(order):
        return order, np.zeros(0, np.int64)
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def _cuts(first: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets begin and end in a sorted array: equal ranges of the fingerprint."""
    of = ((first >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(buckets + 1))


def _sieve(shard: _Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(each window's smallest gram, the distinct ones sorted, which of them two documents hold)."""
    least = shard.smallest_grams()
    if not len(least):
        return least, least, np.zeros(0, bool)
    docs = shard.docs[shard.row]
    kept = np.ones(len(least), bool)
    kept[1:] = (least[1:] != least[:-1]) | (docs[1:] != docs[:-1])
    values, docs = least[kept], docs[kept]
    order, starts = _runs(values)
    docs = docs[order]
    return least, values[order][starts], np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)


def _entries(shard: _Shard, answers: dict[tuple[int, int], bytes] | None, buckets: int) -> tuple[np.ndarray, ...]:
    """(windows that may repeat, their entry, and of the entries: fingerprint twice, smallest document)."""
    if answers is None:
        chosen = np.arange(len(shard.start))
    else:
        least, values, _ = _sieve(shard)
        chosen = np.flatnonzero(_answer(values, answers, 1, buckets)[np.searchsorted(values, least)]) if len(least) else np.zeros(0, np.int64)
    first, second = shard.fingerprints(chosen)
    order, starts = _runs(first, second)
    if not len(order):
        return chosen, chosen, first, second, np.zeros(0, np.int64)
    entry = np.empty(len(order), np.int64)
    entry[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    return chosen, entry, first[order][starts], second[order][starts], np.minimum.reduceat(shard.docs[shard.row[chosen]][order], starts)


def _answer(first: np.ndarray, answers: dict[tuple[int, int], bytes], step: int, buckets: int) -> np.ndarray:
    """The bits that the merges gave back for a sorted run."""
    cuts, out = _cuts(first, buckets), np.zeros(len(first), bool)
    for bucket in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[bucket], cuts[bucket + 1]
        out[a:b] = np.unpackbits(np.frombuffer(answers[step, int(bucket)], np.uint8), count=b - a).astype(bool)
    return out


def _pieces(kind: int, shard: int, first: np.ndarray, second: np.ndarray | None, docs: np.ndarray | None, flags: np.ndarray | None, buckets: int) -> list[dict]:
    cuts = _cuts(first, buckets)
    return [_cell(kind, k, shard, first[a:b], None if second is None else second[a:b], None if docs is None else docs[a:b], None if flags is None else flags[a:b]) for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]


def _cell(kind: int, bucket: int, shard: int, first: np.ndarray, second: np.ndarray | None, docs: np.ndarray | None, flags: np.ndarray | None) -> dict:
    return {"kind": kind, "bucket": bucket, "shard": shard, "first": first.tobytes(), "second": (np.packbits(flags) if second is None else second).tobytes(), "docs": None if docs is None else zstandard.compress(docs.tobytes(), 1)}


def _tabled(rows: list[dict], schema) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))


def _asked(table: pa.Table) -> dict[tuple[int, int], bytes]:
    return dict(zip(zip(table.column("step").to_pylist(), table.column("bucket").to_pylist(), strict=True), table.column("bits").to_pylist(), strict=True))


def _merge_sieve(table: pa.Table) -> pa.Table:
    """Of one bucket of the sieve's runs: which entries do two documents hold?"""
    firsts = [np.frombuffer(x, np.uint64) for x in table.column("first").to_pylist()]
    flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(f)) for x, f in zip(table.column("second").to_pylist(), firsts, strict=True)]
    order, starts = _runs(np.concatenate(firsts))
    sizes = np.diff(np.append(starts, len(order)))
    repeated = np.empty(len(order), bool)
    repeated[order] = np.repeat((sizes > 1) | (np.maximum.reduceat(np.concatenate(flags)[order], starts) > 0), sizes)
    return _answered(table, 1, firsts, repeated)


def _answered(table: pa.Table, step: int, firsts: list[np.ndarray], bits: np.ndarray) -> pa.Table:
    rows, at = [], 0
    for shard, bucket, first in zip(table.column("shard").to_pylist(), table.column("bucket").to_pylist(), firsts, strict=True):
        if shard >= 0:
            rows.append({"shard": shard, "step": step, "bucket": bucket, "bits": np.packbits(bits[at : at + len(first)]).tobytes()})
        at += len(first)
    return _tabled(rows, ANSWER)


def _opened(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    firsts = [np.frombuffer(x, np.uint64) for x in table.column("first").to_pylist()]
    second = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("second").to_pylist()])
    docs = np.concatenate([np.frombuffer(zstandard.decompress(x), np.int64) for x in table.column("docs").to_pylist()])
    return firsts, second, docs


def _merge_windows(table: pa.Table) -> pa.Table:
    """Of one bucket of window runs: which entries does a smaller document hold elsewhere?"""
    firsts, second, docs = _opened(table)
    order, starts = _runs(np.concatenate(firsts), second)
    smaller = np.empty(len(order), bool)
    smaller[order] = np.repeat(np.minimum.reduceat(docs[order], starts), np.diff(np.append(starts, len(order)))) < docs[order]
    return _answered(table, 2, firsts, smaller)


def _merge_runs(table: pa.Table) -> pa.Table:
    """One bucket of several runs as a single run, in pieces of a bounded size."""
    kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
    second = docs = flags = None
    if kind == GRAMS:
        first = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("first").to_pylist()]))
        flags = np.zeros(len(first), bool)
    else:
        firsts, second, docs = _opened(table)
        first = np.concatenate(firsts)
        order, starts = _runs(first, second)
        first, second, docs = first[order[starts]], second[order[starts]], np.minimum.reduceat(docs[order], starts)
    part = lambda x, at: None if x is None else x[at : at + RUN_ENTRIES]
    return _tabled([_cell(kind, bucket, -1, *(part(x, at) for x in (first, second, docs, flags))) for at in range(0, len(first), RUN_ENTRIES)], BLOB)


def _dealt_anew(buckets: int):
    """Stored runs cut to another number of buckets: each is a range, so that pieces only fall apart or stand together."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first = np.frombuffer(row["first"], np.uint64)
                second = docs = flags = None
                if row["kind"] == GRAMS:
                    flags = np.zeros(len(first), bool)
                else:
                    second, docs = np.frombuffer(row["second"], np.uint64), np.frombuffer(zstandard.decompress(row["docs"]), np.int64)
                yield from _tabled(_pieces(row["kind"], -1, first, second, docs, flags, buckets), BLOB).to_batches()

    return cut


def _sharded(docs: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """Rows of one id in one shard; those without an id anywhere, as none removes the other's words."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be an integer: words go by the order of ids")
    own = F.col(id_col).cast("bigint")
    key = F.pmod(F.xxhash64(F.when(own.isNull(), F.xxhash64(text_col)).otherwise(own)), F.lit(shards)).cast("int")
    return docs.select(key.alias("shard"), own.alias("id"), F.col(text_col).alias("text"))


def shard_count(docs: DataFrame, text_col: str = "text", shard_chars: int = SHARD_CHARS) -> int:
    """Enough shards that each has about ``shard_chars`` characters at most, one a task at least."""
    total = docs.agg(F.sum(F.length(text_col)).alias("n")).first()["n"] or 0
    return max(shuffle_width(docs.sparkSession), -(-total // shard_chars))


def index_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shards: int | None = None, buckets: int | None = None, history: DataFrame | None = None) -> DataFrame:
    """What ``history`` takes, to be written as Parquet: a batch's sorted runs, compacted with earlier ones.

    The number of buckets follows the entries of both, so that a bucket stays of one size
    however many batches there were; earlier runs of fewer buckets are cut to it.
    """
    shards = shards or shard_count(docs, text_col)
    if buckets is None:
        entries = (history.agg(F.sum(F.length("first") / 8)).first()[0] or 0) if history is not None else 0
        buckets = max(shards, -(-int(entries) // BUCKET_ENTRIES))

    def run(table: pa.Table) -> pa.Table:
        shard = _Shard(table, window)
        _, grams, _ = _sieve(shard)
        _, _, first, second, least = _entries(shard, None, buckets)
        return _tabled([*_pieces(GRAMS, -1, grams, None, None, np.zeros(len(grams), bool), buckets), *_pieces(WINDOWS, -1, first, second, least, None, buckets)], BLOB)

    runs = _sharded(docs, id_col, text_col, shards).groupBy("shard").applyInArrow(run, BLOB)
    return compact(runs if history is None else runs.unionAll(history.select(*BLOB.names).mapInArrow(_dealt_anew(buckets), BLOB)))


def compact(runs: DataFrame) -> DataFrame:
    """Several runs of equal buckets merged into one; every fingerprint keeps its smallest document."""
    return runs.groupBy("kind", "bucket").applyInArrow(_merge_runs, BLOB)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, history: DataFrame | None = None, buckets: int | None = None, shards: int | None = None) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_text, spans.

    Words stand between ASCII blanks. A word goes if a window of ``window`` words covers it
    whose word sequence also starts in a document of smaller id, in this table or in
    ``history`` (runs from ``index_runs``, of any number of buckets). Windows are judged on the
    input. ``kept_text`` joins what is left by one space; ``spans`` lists the removed runs of
    words. Ids are integers, others are refused; a null id is larger than any other, and rows
    that share an id never remove each other's words. Null and empty texts have no words. Other
    columns, whatever their names, aren't read; an empty table gives none.
    """
    shards = shards or shard_count(docs, text_col)
    buckets = buckets or shards
    dealt = _sharded(docs, id_col, text_col, shards)

    def sieve(table: pa.Table) -> pa.Table:
        _, values, flags = _sieve(_Shard(table, window))
        return _tabled(_pieces(GRAMS, table.column("shard")[0].as_py(), values, None, None, flags, buckets), BLOB)

    def index(table: pa.Table, asked: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _tabled([], BLOB)
        _, _, first, second, least = _entries(_Shard(table, window), _asked(asked), buckets)
        return _tabled(_pieces(WINDOWS, table.column("shard")[0].as_py(), first, second, least, None, buckets), BLOB)

    schema = struct(("id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_text", "string"), ("spans", "array<struct<start: bigint, end: bigint>>"))

    def strip(table: pa.Table, asked: pa.Table) -> pa.Table:
        return _stripped(table, _asked(asked), window, buckets, schema)

    def merged(runs: DataFrame, kind: int, merge) -> DataFrame:
        """Answers to the batch's runs, merged bucket by bucket with those of history."""
        if history is not None:
            runs = runs.unionAll(history.filter(F.col("kind") == kind).select(*BLOB.names).mapInArrow(_dealt_anew(buckets), BLOB))
        return runs.groupBy("bucket").applyInArrow(merge, ANSWER)

    told = merged(dealt.groupBy("shard").applyInArrow(sieve, BLOB), GRAMS, _merge_sieve)
    runs = dealt.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(index, BLOB)
    answers = merged(runs, WINDOWS, _merge_windows).unionAll(told)
    return dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(strip, schema).withColumnRenamed("id", id_col)


def incremental_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, fractions: tuple[float, ...] = (0.125,)) -> DataFrame:
    """``substring_dedup`` of a table taken batch by batch in order of id, each against the index of those before.

    The first batch ends at about the first of the ``fractions`` of ids, and so on; rows without
    an id come last. The result is that of the whole table at once. After each batch but the
    last its runs are compacted into the index, which is kept in the shared folder.
    """
    bounds = sorted(set(docs.select(F.col(id_col).cast("double").alias("i")).approxQuantile("i", list(fractions), 0.01))) if fractions else []
    own, history, results = F.col(id_col), None, []
    edges = [None, *bounds, None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        inside = F.lit(True) if low is None else F.coalesce(own >= low, F.lit(True))
        batch = docs.filter(inside & (F.lit(True) if high is None else F.coalesce(own < high, F.lit(False))))
        results.append(substring_dedup(batch, id_col, text_col, window, history))
        if high is not None:
            history = durable(index_runs(batch, id_col, text_col, window, history=history))
    return reduce(DataFrame.unionAll, results)


def _stripped(table: pa.Table, answers: dict, window: int, buckets: int, schema) -> pa.Table:
    if not table.num_rows:
        return _tabled([], schema)
    shard = _Shard(table, window)
    chosen, entry, first, _, least = _entries(shard, answers, buckets)
    smaller = _answer(first, answers, 2, buckets)
    hit = chosen[smaller[entry] | (shard.docs[shard.row[chosen]] > least[entry])] if len(chosen) else chosen
    edge = np.zeros(len(shard.codes) + window + 1, np.int64)
    np.add.at(edge, shard.start[hit], 1)
    np.add.at(edge, shard.start[hit] + window, -1)
    gone = np.cumsum(edge)[: len(shard.codes)] > 0
    removed, kept, spans, k = [], [], [], 0
    for text in (t for chunk in shard.texts.chunks for t in as_bytes(chunk)):
        end, size = shard.ends[k], shard.sizes[k]
        mask = gone[end - size : end]
        k += 1
        words = text.split() if text else []
        count = int(mask.sum())
        removed.append(count)
        runs = list(_true_runs(mask)) if count else []
        spans.append([{"start": a, "end": b} for a, b in runs])
        left, at = [], 0
        for a, b in [*runs, (size, size)]:
            left += words[at:a]
            at = b
        kept.append(b" ".join(left).decode())
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = [shard.ids, shard.sizes, np.array(removed), kept, spans]
    return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def _true_runs(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return ((int(a), int(b)) for a, b in edges.reshape(-1, 2))
