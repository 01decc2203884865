"""Byte-level text rules that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

#: Bytes of a folded word: digits, a-z and every byte of a non-ASCII character. A-Z fold to a-z.
FOLD = bytes((b + 32) if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: What stands between the same words of lower-cased text, as a regular expression.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def folded_words(text: bytes | None) -> list[bytes]:
    """Words of A-Z-lower-cased text; None has none."""
    return text.translate(FOLD).split() if text else []


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words between runs of the six ASCII blanks, unchanged; None has none."""
    return text.split() if text else []


def fold_ascii(text: Column) -> Column:
    """Lower-case text so that no character outside A-Z comes to equal an ASCII one.

    The Kelvin sign is the only such character; another letter stands in for it.
    """
    return F.lower(F.replace(text, F.lit("K"), F.lit("é")))


def arrow_map(frame: DataFrame, schema: StructType, rows: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """``frame.mapInArrow`` for a function from a batch to a list of columns, one for each field.

    Batches stream through; nothing is kept between them.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = rows(batch)
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow)

    return frame.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding it."""
    return column.cast(pa.binary()).to_pylist()


PLAIN = {"bigint": LongType(), "int": IntegerType(), "double": DoubleType(), "string": StringType(), "binary": BinaryType(), "boolean": BooleanType()}


def kind(said: str) -> DataType:
    """A type by its short name, without a session: plain ones, array<...> and struct<a: ..., ...> of plain ones."""
    if said.startswith("array<"):
        return ArrayType(kind(said[6:-1]))
    if said.startswith("struct<"):
        return StructType([StructField(n.strip(), kind(t.strip())) for n, t in (x.split(":") for x in said[7:-1].split(","))])
    return PLAIN[said]


def struct(*fields: tuple[str, str | DataType]) -> StructType:
    return StructType([StructField(n, kind(t) if isinstance(t, str) else t) for n, t in fields])


_KEPT: list = [None, None]


def kept(key: object, make: Callable[[], object]) -> object:
    """``make()``, once for each key in a Python worker, which keeps only the latest one's value.

    So what an operator remembers between tasks is freed when another operator's tasks begin.
    """
    if _KEPT[0] is not key:
        _KEPT[:] = [None, None]
        _KEPT[:] = [key, make()]
    return _KEPT[1]
