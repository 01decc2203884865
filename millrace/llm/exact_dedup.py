"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

A normalised text is cut where its own content says so; each chunk gets a 64-bit identifier
and a text becomes a recipe, the ordered list of its chunks' identifiers. The identifiers are
verified: every distinct chunk is moved once (copies are combined before the shuffle), and an
identifier that stands for more than one chunk is split by an ordinal. From then on only
recipes move, about a hundredth of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..runtime import durable

#: Code points after which a text may be cut: two in a row, below U+0100, that leave this remainder.
#: (The regular expression engine tests those by a bit set. Other scripts get cuts of the largest size.)
CUT_MODULUS, CUT_REMAINDER = 5, 2


def normalise(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def chunk_pattern(min_chars: int, max_chars: int) -> str:
    cut = "".join(rf"\x{{{c:X}}}" for c in range(0x21, 0x100) if c % CUT_MODULUS == CUT_REMAINDER)
    return f"(?s).{{{min_chars},{max_chars}}}?[{cut}]{{2}}|.{{1,{max_chars}}}"


def chunk_id(chunk: Column, bits: int) -> Column:
    h = F.xxhash64(chunk)
    return h if bits >= 64 else h.bitwiseAND(F.lit((1 << bits) - 1))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 256, max_chars: int = 2048, id_bits: int = 64) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts are equal when they agree after deleting ASCII blanks; a null text is empty, and all
    empty texts form one group. Of a group the row with the most code points stays, then the
    smallest id (a null id comes last). Rows that repeat an id get the same verdict each.
    Other columns of the input, whatever their names, are not read. An empty table gives none.
    """
    base = docs.select(F.col(id_col).alias("id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("points"), normalise(F.col(text_col)).alias("norm"))
    pattern = F.lit(chunk_pattern(min_chars, max_chars))
    chunks = F.regexp_extract_all(F.col("norm"), pattern, F.lit(0))
    recipes = durable(base.select("id", "points", F.sha2("norm", 256).alias("sha"), F.transform(chunks, lambda c: chunk_id(c, id_bits)).alias("recipe")).withColumn("rkey", F.xxhash64("recipe")))

    pieces = base.select(F.explode(chunks).alias("chunk")).select(chunk_id(F.col("chunk"), id_bits).alias("cid"), "chunk")
    shared = durable(pieces.groupBy("cid").agg(F.count_distinct("chunk").alias("n")).filter("n > 1").select("cid"))
    keys = ["rkey", "recipe"]
    if not shared.isEmpty():
        recipes = recipes.join(_ordinals(base, chunks, shared, id_bits, id_col), "sha", "left")
        keys.append("ordinals")
        recipes = recipes.withColumn("ordinals", F.coalesce("ordinals", F.array().cast("array<int>")))

    best = F.min(F.struct((-F.col("points")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("id")))
    # Kept apart, so that the join's sides are plain shuffles, whose hot partitions can be split.
    groups = durable(recipes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), best.alias("best")).filter("n > 1").select(*keys, "n", F.col("best.id").alias("keep")))
    one = F.col("n").isNull()
    keep = F.when(one, F.col("id")).otherwise(F.col("keep"))
    return recipes.join(groups, keys, "left").select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.size("recipe").cast("long").alias("n_chunks"),
    )


def _ordinals(base: DataFrame, chunks: Column, shared: DataFrame, id_bits: int, id_col: str) -> DataFrame:
    """For each distinct text that has a chunk whose identifier is shared: the chunks' ordinals."""
    placed = base.select(F.sha2("norm", 256).alias("sha"), F.posexplode(chunks).alias("pos", "chunk")).withColumn("cid", chunk_id(F.col("chunk"), id_bits)).join(shared, "cid", "left_semi")
    names = placed.select("cid", "chunk").distinct().withColumn("ordinal", F.row_number().over(Window.partitionBy("cid").orderBy("chunk")))
    told = placed.join(names, ["cid", "chunk"]).select("sha", "pos", "ordinal").distinct()
    return told.groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("pos", "ordinal"))).alias("o")).select("sha", F.col("o.ordinal").alias("ordinals"))
