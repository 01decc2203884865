"""SimHash near-dedup by multi-index hashing.

A 64-bit fingerprint is kept as two segments of 32 bits, each a table of the fingerprints by
the segment's value. Two fingerprints that differ in at most two bits differ in at most one
bit of the upper segment or agree in the lower. So a fingerprint looks up the small ball of 33
values within one bit in the upper table, and its own value in the lower; what the tables hold
there is fetched, and the complete distance of every fetched fingerprint is verified.

A value that many distinct fingerprints share would bring all pairs of them together. Those
fingerprints, and those whose ball holds such a value, are linked without pairs: two that are
within two bits meet at a code within one bit of both, so each is sent to the 65 codes around
it, and a code links what arrives, 65 at most, to the smallest of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.graph import connected_components
from ..runtime import durable
from .common import arrow_map, as_bytes, spaced_words, struct

SEED = 42
SHINGLE = 3
DISTANCE = 2
BLOCK = 1 << 15
#: Distinct fingerprints of one segment value that are fetched one by one.
BUCKET = 64


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the A-Z-lower-cased words' shingles; zero if there is no word."""
    words = spaced_words(text.lower() if text else None)
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at : min(n, at + BLOCK) + width - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(width)), strict=False)) if len(part) >= width else [b" ".join(part)]
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed 64-bit number."""

    def rows(batch: pa.RecordBatch) -> list:
        return [batch.column(0), np.array([fingerprint(t, width) for t in as_bytes(batch.column(1))], "<u8").view("<i8").tolist()]

    return arrow_map(docs.select(F.col(id_col).alias("id"), text_col), struct(("id", docs.schema[id_col].dataType), ("fp", "bigint")), rows)


def _ball(code: Column, bits: int) -> Column:
    """The code, and the code with each one of its ``bits`` lower bits flipped."""
    return F.array(code, *[code.bitwiseXOR(F.lit((1 << k) - (1 << 64) * (k == 63)).cast("bigint")) for k in range(bits)])


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(codes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(src, dst), src < dst, of distinct fingerprints ``fp`` at most two bits apart.

    All such pairs in which no looked-up value has more than ``bucket`` fingerprints, and of the
    others enough to connect what they connect.
    """
    fp = F.col("fp")
    looked = F.array(
        F.struct(F.lit(0).alias("segment"), _ball(F.shiftrightunsigned(fp, 32), 32).alias("values")),
        F.struct(F.lit(1).alias("segment"), F.array(fp.bitwiseAND(F.lit(0xFFFFFFFF))).alias("values")),
    )
    probes = codes.select("fp", F.explode(looked).alias("x")).select("fp", F.col("x.segment").alias("segment"), F.posexplode("x.values").alias("flip", "value"))
    table = probes.filter("flip = 0").select("segment", "value", "fp")
    crowd = durable(table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket).select("segment", "value"))
    few = crowd.isEmpty()
    held = table if few else table.join(crowd, ["segment", "value"], "left_anti")
    fetched = probes.join(held.withColumnRenamed("fp", "other"), ["segment", "value"]).filter(fp != F.col("other"))
    found = fetched.filter(_apart("fp", "other") <= DISTANCE).select(F.least("fp", "other").alias("src"), F.greatest("fp", "other").alias("dst"))
    if not few:
        near_crowd = probes.join(crowd, ["segment", "value"], "left_semi").select("fp").distinct()
        met = near_crowd.select("fp", F.explode(_ball(fp, 64)).alias("code")).groupBy("code").agg(F.collect_list("fp").alias("all")).filter(F.size("all") > 1)
        star = met.select(F.array_min("all").alias("src"), F.explode("all").alias("dst")).filter(F.col("src") != F.col("dst"))
        found = found.unionAll(star.filter(_apart("src", "dst") <= DISTANCE))
    return found.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """One row per input row: id, fp (signed), component_id.

    Rows of equal fingerprint are one class before anything is looked up, so that the size of a
    group of copies costs nothing. ``component_id`` is the smallest id of the rows reachable by
    links of at most two bits, itself included; a null id is never it unless there is no other.
    Null and empty texts have fingerprint zero and link like any other. Very long texts are
    hashed in blocks; other columns, whatever their names, aren't read; an empty table gives none.
    """
    marked = durable(fingerprints(docs, id_col, text_col, width))
    classes = durable(marked.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), marked.count())
    roots = connected_components(links(classes.select("fp"), bucket))
    joined = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    whole = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    told = joined.filter("linked or n > 1").join(whole, "root").select("fp", "component_id")
    return marked.join(told.withColumn("found", F.lit(True)), "fp", "left").select(F.col("id").alias(id_col), "fp", F.when(F.col("found"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def hexed(fp: Column) -> Column:
    """16 lowercase hex digits of a signed fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


#: The longer fingerprint of ``near_copies``: 64-bit words, bits by which a segment has more values than there are
#: documents, the documents of one segment value whose pairs are fetched, and those that one task compares with as many.
LONG_WORDS, SPARE_BITS, PAIRED, COMPARED = 8, 4, 16, 4096
#: Fingerprints that are compared with a block at once.
STRIP = 64
STEP = 0x9E3779B97F4A7C15


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th independent 64 bits of each hash."""
    x = hashes + np.uint64(k * STEP % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def long_fingerprint(text: bytes | None, width: int) -> np.ndarray:
    """512 bits of SimHash over the distinct shingles of a text, as 0 and 1; all 0 if there is no word."""
    words = spaced_words(text.lower() if text else None)
    ones, n = np.zeros(64 * LONG_WORDS, np.int64), 0
    if words:
        seen = np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[k : k + width]), SEED) for k in range(max(1, len(words) - width + 1))), np.uint64))
        n = len(seen)
        for at in range(0, n, BLOCK):
            for k in range(LONG_WORDS):
                ones[64 * k : 64 * k + 64] += np.unpackbits(_mixed(seen[at : at + BLOCK], k + 1).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return (2 * ones > n).astype(np.uint8)


def bits_at(similarity: float) -> int:
    """Differing bits of the long fingerprints of two texts whose shingle sets have this Jaccard similarity, as expected.

    Of sets of a size the cosine is 2 j / (1 + j), and a bit differs with the angle's share of a half turn.
    """
    return int(64 * LONG_WORDS * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def segment_bits(documents: int) -> int:
    """Bits of a segment, so that the fetched pairs of unlike documents grow with the documents and not with their square."""
    return max(16, max(1, documents - 1).bit_length() + SPARE_BITS)


def _joined_within(table: pa.Table, most: int) -> list[tuple[int, int]]:
    """(src, dst), src < dst: roots that the near pairs of part ``a`` with part ``b`` connect, as a forest.

    Every fingerprint of the one part is compared with all of the other whose root it isn't known to share.
    """
    part, label = table["part"].to_numpy(), table["root"].to_numpy().copy()
    codes = table["fp"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, LONG_WORDS)
    low, high = (np.flatnonzero(part == table[side][0].as_py()) for side in ("a", "b"))
    found = []
    for at in range(0, len(low), STRIP):
        rows = low[at : at + STRIP]
        rows = rows[[bool((label[high] != label[row]).any()) for row in rows]]
        apart = np.zeros((len(rows), len(high)), np.uint16)
        for k in range(LONG_WORDS):
            apart += np.bitwise_count(codes[rows, k, None] ^ codes[None, high, k])
        near = apart <= most
        for k in np.flatnonzero((near & (label[rows, None] != label[None, high])).any(1)):
            met = np.union1d(label[high[near[k]]], label[rows[k]])
            found += [(int(met[0]), int(x)) for x in met[1:]]
            label[np.isin(label, met)] = met[0]
    return found


def _joined(members: DataFrame, most: int, block: int) -> DataFrame:
    """(src, dst) of roots, src < dst: enough to connect what all near pairs of every segment value connect.

    ``members`` are (segment, value, node, root, fp). Pairs under one root are connected already. So
    of each value the members outside its most frequent root are compared with each other and with
    those inside, in blocks of about ``block`` with as many: no pair is left out, and none but the
    blocks of one value's fingerprints meet in a task.
    """
    keys = ["segment", "value"]
    held = members.groupBy(*keys, "root").agg(F.count(F.lit(1)).alias("n"))
    told = held.groupBy(*keys).agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n")).filter(F.col("n") > F.col("main.n"))
    parts = told.select(*keys, F.col("main.root").alias("main"), F.ceil((F.col("n") - F.col("main.n")) / block).alias("outer"), F.ceil(F.col("main.n") / block).alias("inner"))
    by = F.xxhash64("node")
    dealt = members.join(parts, keys).withColumn("part", F.when(F.col("root") == F.col("main"), F.col("outer") + F.pmod(by, "inner")).otherwise(F.pmod(by, "outer")))
    part, last = F.col("part"), F.least("part", F.col("outer") - 1)
    first = F.when(part < F.col("outer"), F.transform(F.sequence(part, F.col("outer") + F.col("inner") - 1), lambda x: F.struct(part.alias("a"), x.alias("b"))))
    other = F.filter(F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda x: F.struct(x.alias("a"), part.alias("b"))), lambda x: x["a"] < x["b"])
    met = dealt.withColumn("pair", F.explode(F.when(first.isNull(), other).otherwise(F.concat(first, other))))
    schema = struct(("src", "bigint"), ("dst", "bigint"))
    arrow = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        found = _joined_within(table, most)
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], schema=arrow)

    told_apart = met.select(*keys, "pair.a", "pair.b", "part", "root", "fp").repartition(*keys, "a", "b")  # else a value's blocks stay in one task
    return told_apart.groupBy(*keys, "a", "b").applyInArrow(run, schema)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, bucket: int = PAIRED, block: int = COMPARED) -> DataFrame:
    """One row per input row: id, component_id, by texts whose shingles agree to about ``similarity``.

    Two 512-bit fingerprints link if they differ in no more bits than ``bits_at`` expects. Such
    pairs are fetched from tables of their segments, of which one at least is equal with a
    chance that grows with their likeness, and their complete distance is verified. Of a segment
    value with more than ``bucket`` fingerprints, each is first verified against the least of
    them and, by the next segment too, against the least of those that share both. That connects
    most of a group of near copies; every other pair of the value, of those not connected by
    then, is compared in blocks. So the components are those of all pairs, whatever ``bucket``
    and ``block``. ``component_id`` is the smallest id reachable. Null and empty texts are one
    group; an empty table gives none; other columns aren't read.
    """
    size = segment_bits(docs.count())
    segments = 64 * LONG_WORDS // size

    def rows(batch: pa.RecordBatch) -> list:
        codes, cut = [], []
        weights = 1 << np.arange(size)
        for text in as_bytes(batch.column(1)):
            bits = long_fingerprint(text, width)
            codes.append(np.packbits(bits, bitorder="little").view("<i8").tolist())
            cut.append((bits[: segments * size].reshape(segments, size) @ weights).tolist())
        return [batch.column(0), codes, cut]

    made = struct(("id", docs.schema[id_col].dataType), ("fp", "array<bigint>"), ("cut", "array<bigint>"))
    marked = durable(arrow_map(docs.select(F.col(id_col).alias("id"), text_col), made, rows))
    classes = durable(marked.groupBy("fp").agg(F.min("id").alias("least"), F.first("cut").alias("cut")).withColumn("node", F.monotonically_increasing_id()), 4 * marked.count())
    keys = ["segment", "value"]
    placed = classes.select("node", F.posexplode("cut").alias(*keys))
    sizes = durable(placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), classes.count() * segments // 8)
    codes = classes.select("node", "fp")
    most = bits_at(similarity)

    def verified(pairs: DataFrame) -> DataFrame:
        """Of candidate pairs (src, dst), each once, those whose complete distance is small enough."""
        both = pairs.distinct().join(codes.select(F.col("node").alias("src"), F.col("fp").alias("a")), "src").join(codes.select(F.col("node").alias("dst"), F.col("fp").alias("b")), "dst")
        apart = F.aggregate(F.zip_with("a", "b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        return both.filter(apart <= most).select("src", "dst")

    few = placed.join(sizes.filter(F.col("n") <= bucket), keys).select("node", *keys)
    met = few.withColumnRenamed("node", "src").join(few.withColumnRenamed("node", "dst"), keys).filter("src < dst").select("src", "dst")
    found = verified(met)
    crowd = sizes.filter(F.col("n") > bucket).select(*keys)
    few_only = crowd.isEmpty()
    if not few_only:
        nexts = classes.select("node", F.posexplode("cut").alias(*keys), "cut").select("node", *keys, F.get("cut", (F.col("segment") + 1) % segments).alias("next"))
        many = nexts.join(crowd, keys)
        stars = [many.join(many.groupBy(*by).agg(F.min("node").alias("src")), by).filter("node <> src").select("src", F.col("node").alias("dst")) for by in (keys, [*keys, "next"])]
        found = found.unionAll(verified(stars[0].unionAll(stars[1])))
    roots = connected_components(found.distinct())
    joined = classes.join(roots, "node", "left").select("node", "fp", "least", F.coalesce("root", "node").alias("root"))
    if not few_only:
        members = placed.join(crowd, keys).join(joined.select("node", "root", "fp"), "node")
        rest = durable(_joined(members, most, block).distinct(), classes.count())
        if not rest.isEmpty():
            upper = connected_components(rest).select(F.col("node").alias("root"), F.col("root").alias("top"))
            joined = joined.join(upper, "root", "left").withColumn("root", F.coalesce("top", "root"))
    whole = joined.join(joined.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return marked.select("id", "fp").join(whole, "fp").select(F.col("id").alias(id_col), "component_id")
