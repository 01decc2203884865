"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every window of eight item words is a pattern. A table of two-word blocks tells how far the
search may jump; blocks that end a pattern lead to a bucket, narrowed by the pattern's first
block, and what is left is compared with the text directly.

The benchmark is searched for in blocks of a stated number of words. A block is a few flat
arrays, some 40 bytes a word: its text once, one byte of shift for each of eight places a word,
and the patterns' places sorted by the hash of their last two words. Blocks are read from the
benchmark, sent, searched for and freed one after the other, so that neither the driver nor a
worker holds more than one whatever the benchmark's size; of each only the documents it hits
are kept.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable, settled
from .common import arrow_map, as_bytes, folded_words, struct

BLOCK_WORDS = 1_000_000


class WuManber:
    """The patterns of one length that begin at ``starts`` in a block's flat words."""

    def __init__(self, length: int, starts: np.ndarray, single: np.ndarray, pair: np.ndarray):
        self.length = m = length
        self.block = b = min(2, m)
        ends = pair if b == 2 else single  # by the place of a block's last word
        self.mask = (1 << (8 * len(starts)).bit_length()) - 1
        shift = np.full(self.mask + 1, m - b + 1, np.uint8)
        for end in range(b, m + 1):
            np.minimum.at(shift, ends[starts + end - 1] & np.uint32(self.mask), m - end)
        self.shift = shift.tobytes()
        order = np.argsort(ends[starts + m - 1], kind="stable")
        self.starts, self.suffix, self.prefix = starts[order], ends[starts + m - 1][order], ends[starts + b - 1][order]

    def places(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """(where it ends, patterns of its last and first block) wherever the shift table finds no jump."""
        m, b, mask, shift, suffix = self.length, self.block, self.mask, self.shift, self.suffix
        end, n = m, len(words)
        while end <= n:
            code = crc32(words[end - 1], crc32(words[end - 2])) if b == 2 else crc32(words[end - 1])
            step = shift[code & mask]
            if step:
                end += step
                continue
            low = bisect_left(suffix, code)
            if low < len(suffix) and suffix[low] == code:
                first = crc32(words[end - m + 1], crc32(words[end - m])) if b == 2 else crc32(words[end - m])
                yield end, self.starts[low + np.flatnonzero(self.prefix[low : bisect_right(suffix, code)] == first)]
            end += 1


class Block:
    """Some items: their ids, their words in one text, and a search for each length of pattern."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.ids = [i for i, _ in items]
        sizes = np.array([len(w) for _, w in items], np.int64)
        self.first = np.cumsum(sizes) - sizes
        words = [w for _, own in items for w in own]
        self.text = b" ".join(words)
        self.at = np.cumsum([0, *(len(w) + 1 for w in words)])
        single = np.fromiter(map(crc32, words), np.uint32, len(words))
        pair = np.fromiter((crc32(w, c) for w, c in zip(words, [0, *single[:-1].tolist()], strict=True)), np.uint32, len(words)) if words else single
        short = {int(n): self.first[sizes == n] for n in np.unique(sizes) if 0 < n < window}
        long = sizes >= window
        counts = sizes[long] - window + 1
        full = np.repeat(self.first[long] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        self.searches = [WuManber(n, s, single, pair) for n, s in [*short.items(), (window, full)] if len(s)]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Merged [start, end) runs of hit words, and the sorted ids of the items found."""
        found, items = [], set()
        for search in self.searches:
            m = search.length
            for end, starts in search.places(words):
                said = b" ".join(words[end - m : end])
                same = [s for s in starts.tolist() if self.text[self.at[s] : self.at[s + m] - 1] == said]
                if same:
                    found.append((end - m, end))
                    items.update((np.searchsorted(self.first, same, side="right") - 1).tolist())
        return merged(found), sorted({self.ids[k] for k in items if self.ids[k] is not None})


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of at least one item and about ``block_words`` words at most, read as they are asked for."""
    items, size = [], 0
    for item, text in benchmark.select(F.col(id_col).cast("string"), text_col).toLocalIterator():
        words = folded_words(text.encode() if text is not None else None)
        if items and size + len(words) > block_words:
            yield Block(items, window)
            items, size = [], 0
        items.append((item, words))
        size += len(words)
    yield Block(items, window)


SPANS = "array<struct<start: bigint, end: bigint>>"
FOUND = (("n_words", "bigint"), ("items", "array<string>"), ("spans", SPANS))


def _searched(rows: DataFrame, block: Block) -> tuple[DataFrame, object]:
    """(id, n_words, items, spans) of every row (id, text), and the broadcast of the block."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def search(batch: pa.RecordBatch) -> list:
        counts, items, spans = [], [], []
        for text in as_bytes(batch.column(1)):
            words = folded_words(text)
            runs, owners = sent.value.scan(words)
            counts.append(len(words)), items.append(owners), spans.append([{"start": a, "end": b} for a, b in runs])
        return [batch.column(0), counts, items, spans]

    return arrow_map(rows, struct(("id", rows.schema["id"].dataType), *FOUND), search), sent


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 8, min_items: int = 2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per input row: id, n_words, n_hit, items, contaminated, spans.

    ``items`` are the found item ids as sorted strings, ``spans`` the runs of hit words. Null
    and empty texts have no words. An item without an id makes words hit but isn't listed. An
    empty benchmark hits nothing, an empty table gives no rows. Rows with equal or null ids are
    judged each on its own, and other columns, whatever their names, are not read. A benchmark
    of one block is searched for in one pass that shuffles nothing. Of more, each takes a pass
    that keeps the rows it hits, and these meet by row number.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = item_blocks(benchmark, item_col, item_text_col, window, block_words)
    block, more = next(blocks), next(blocks, None)
    found = _searched(rows, block)[0] if more is None else _by_blocks(rows, chain([block, more], blocks))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return found.select(F.col("id").alias(id_col), "n_words", hit.alias("n_hit"), "items", (F.size("items") >= min_items).alias("contaminated"), "spans")


def _by_blocks(rows: DataFrame, blocks: Iterator[Block]) -> DataFrame:
    """``_searched`` for each block by itself; its broadcast goes before the next one is made."""
    keyed = settled(rows).select(F.struct(F.monotonically_increasing_id().alias("row"), "id").alias("id"), "text")
    parts: list[DataFrame] = []
    for block in blocks:
        found, sent = _searched(keyed, block)
        parts.append(durable(found.filter(F.size("spans") > 0) if parts else found))
        sent.destroy()
    met = reduce(DataFrame.unionAll, parts).groupBy("id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))

    def together(batch: pa.RecordBatch) -> list:
        runs = [[{"start": a, "end": b} for a, b in merged([(x["start"], x["end"]) for x in spans])] for spans in batch.column(3).to_pylist()]
        return [batch.column(0), batch.column(1), [sorted(set(x)) for x in batch.column(2).to_pylist()], runs]

    return arrow_map(met.select("id.id", "n_words", "items", "spans"), struct(("id", rows.schema["id"].dataType), *FOUND), together)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from ``decontaminate``'s rows."""
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
