"""SentencePiece encoding and decoding, with giant documents encoded in chunks by a max-plus scan.

A document longer than a chunk is cut every ``chunk_chars`` code points, wherever that falls.
The state at a cut is where the first token boundary at or after it lies, and which token ends
there; a piece has at most ``reach`` code points, so there are few states. Each chunk by itself
yields its transfer matrix: 0 where a left and a right state go together, minus infinity where
they don't. Matrices multiply in the max-plus semiring, associatively; prefix products and one
walk back give the states on the only path of weight 0, and then each chunk is encoded by
itself between its two states.

Two facts of byte-pair pieces make this exact. No piece holds a blank after another character,
so that every place before a word is a boundary: a cut near one has a single state. And a run
of tokens is the encoding of its text exactly when each two neighbours are the encoding of
theirs, so that a junction is checked by encoding two tokens' text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..runtime import durable
from .common import arrow_map, kept, struct

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_CHARS = 32_768
#: Words that a worker remembers, of so many characters at most: some 20 MB.
CACHED_WORDS, CACHED_CHARS = 100_000, 32
BLANK = "▁"
#: A character of no piece: it becomes a byte token, which nothing merges with.
BARRIER = "\x01"
WORDS = re.compile(f"[ {BLANK}]*[^ {BLANK}]+|[ {BLANK}]+")
ANY = -1


class Tokenizer:
    """The library's processor, with a memory of words and the rules for parts of a text."""

    def __init__(self, model: bytes):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
        self.reach = max(map(len, self.pieces))
        self.free = not any(BLANK in p.lstrip(BLANK) for p in self.pieces)
        self.byte = [sp.is_byte(k) for k in range(len(self.pieces))]
        odd = [sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k) for k in range(len(self.pieces))]
        self.bytes = [None if o else bytes([int(p[3:5], 16)]) if b else p.replace(BLANK, " ").encode() for p, b, o in zip(self.pieces, self.byte, odd, strict=True)]
        self.known: dict[str, bytes] = {}
        self.joins: dict[tuple[int, int], bool] = {}

    def _word(self, word: str) -> bytes:
        """Ids of a word that begins with a blank: the processor puts that blank there itself."""
        ids = np.array(self.sp.encode(word[1:], num_threads=1), "<i4").tobytes() if len(word) > 1 else np.array([self.sp.piece_to_id(BLANK)], "<i4").tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def part(self, text: str, inside: bool = False) -> bytes:
        """Ids (int32, little-endian) of a part of a text that begins at a boundary.

        ``inside``: the part begins within a word, so that no blank is put before it.
        """
        if not self.free:
            return self._whole(text, inside)
        words = WORDS.findall(text)
        head = b""
        if inside and words:
            head, words = self._whole(words[0], True), words[1:]
        known, word = self.known.get, self._word
        return head + b"".join([known(w) or word(w) for w in words])

    def _whole(self, text: str, inside: bool) -> bytes:
        if inside:
            return np.array(self.sp.encode(BARRIER + text, num_threads=1)[2:], "<i4").tobytes()
        return np.array(self.sp.encode(text[1:], num_threads=1), "<i4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, as the library gives them."""
        return self.part(" " + text) if text else b""

    def decode(self, ids: bytes) -> str:
        """The text of ids, as the library gives it."""
        numbers = np.frombuffer(ids, "<i4").tolist()
        try:
            text = b"".join(map(self.bytes.__getitem__, numbers)).decode()
        except (TypeError, UnicodeDecodeError):
            return self.sp.decode(numbers)
        return text[1:] if text.startswith(" ") and numbers and not self.byte[numbers[0]] else text

    def goes(self, left: int, right: int) -> bool:
        """Whether two tokens may be neighbours."""
        if left == ANY or right == ANY:
            return True
        key = (left, right)
        if key not in self.joins:
            self.joins[key] = self.byte[left] or self.byte[right] or self._whole(self.pieces[left] + self.pieces[right], True) == np.array(key, "<i4").tobytes()
        return self.joins[key]

    def states(self, text: str, at: int) -> list[int]:
        """Possible distances from a cut to the first boundary at or after it; one if a word begins there."""
        if at == 0 or at >= len(text):
            return [0]
        if self.free:
            for k in range(self.reach):
                if at + k < len(text) and text[at + k] in (" ", BLANK) and text[at + k - 1] not in (" ", BLANK):
                    return [k]
        return list(range(min(self.reach, len(text) - at)))

    def chunks(self, text: str, size: int) -> list[tuple[str, int, list[int], list[int]]]:
        """Of each chunk: its text and as much more as a state may reach, its size, left states, right states."""
        size = max(size, self.reach)
        cuts = list(range(0, len(text), size)) or [0]
        if len(cuts) > 1 and len(text) - cuts[-1] < self.reach:
            cuts.pop()
        states = [self.states(text, c) for c in cuts] + [[0]]
        ends = [*cuts[1:], len(text)]
        return [(text[a : b + self.reach], b - a, states[k], states[k + 1]) for k, (a, b) in enumerate(zip(cuts, ends, strict=True))]

    def between(self, text: str, start: int, end: int, first: bool, single: bool) -> bytes:
        """Ids of a chunk between two states. ``single``: the left state is the only one, before a word."""
        return self.part(" " + text[start:end]) if first else self.part(text[start:end], not single)

    def transfer(self, text: str, size: int, left: list[int], right: list[int], first: bool) -> list[tuple[int, int, int, int]]:
        """(left state, right state, first token, last token) of each way through a chunk.

        Next to a single state any token may stand: a word begins there, or the text ends.
        """
        if len(left) == len(right) == 1:
            return [(left[0], right[0], ANY, ANY)]
        out = []
        for i in left:
            for j in right:
                ids = np.frombuffer(self.between(text, i, size + j, first, len(left) == 1), "<i4")
                out.append((i, j, ANY if len(left) == 1 else int(ids[0]), ANY if len(right) == 1 else int(ids[-1])))
        return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of two transfer matrices."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def prefixes(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """All prefix products, by pairing neighbours: half of them at each level."""
    if len(matrices) == 1:
        return matrices
    pairs = prefixes([times(matrices[k], matrices[k + 1]) for k in range(0, len(matrices) - 1, 2)])
    return [matrices[0]] + [pairs[(k - 1) // 2] if k % 2 else times(pairs[k // 2 - 1], matrices[k]) for k in range(1, len(matrices))]


def path(ways: list[list[tuple[int, int, int, int]]], goes) -> list[tuple[int, int]]:
    """(left state, right state) of each chunk, from every chunk's ways through it.

    A node at a cut is a state with the token that ends there.
    """
    nodes: list[list[tuple[int, int]]] = [[(0, ANY)]]
    matrices = []
    for chunk in ways:
        after = sorted({(j, last) for _, j, _, last in chunk})
        place = {x: k for k, x in enumerate(after)}
        m = np.full((len(nodes[-1]), len(after)), -np.inf)
        for a, (state, left) in enumerate(nodes[-1]):
            for i, j, first, last in chunk:
                if i == state and goes(left, first):
                    m[a, place[j, last]] = 0.0
        matrices.append(m)
        nodes.append(after)
    reached = prefixes(matrices)
    at, out = int(np.argmax(reached[-1][0])), []
    for k in range(len(matrices) - 1, -1, -1):
        score = matrices[k][:, at] + (reached[k - 1][0] if k else 0.0)
        was = int(np.argmax(score))
        if score[was] == -np.inf:
            raise ValueError("no path through the chunks")
        out.append((nodes[k][was][0], nodes[k + 1][at][0]))
        at = was
    return out[::-1]


def _model(spark, path: str):
    """The model's bytes for all executors: the driver's file, or one of a store that Spark knows."""
    if "://" in path:
        content = bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])
    else:
        with open(path, "rb") as f:
            content = f.read()
    return spark.sparkContext.broadcast(content)


def _tokenizer(sent) -> Tokenizer:
    """One in each Python worker."""
    content = sent.value
    return kept(content, lambda: Tokenizer(content))


def _sha(text: str | None) -> str:
    return hashlib.sha256((text or "").encode()).hexdigest()


def _told(tokenizer: Tokenizer, ids: list[bytes], checked: bool) -> list[list]:
    """n_tokens, token_ids and, if the round trip is checked, the digest of the decoded text."""
    return [[len(x) // 4 for x in ids], ids, *([[_sha(tokenizer.decode(x)) for x in ids]] if checked else [])]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH, chunk_chars: int = CHUNK_CHARS, checked: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, token_ids, n_chunks, text_sha256 and, if ``checked``, decoded_sha256.

    ``token_ids`` are int32, little-endian, and equal the library's for the whole text;
    ``text_sha256`` is the source text's and ``decoded_sha256`` that of the text which the ids
    decode to. Null and empty texts have no tokens and one chunk. Null ids and repeated rows are
    encoded each on its own, other columns aren't read, and an empty table gives none. Chunks of
    giant documents are kept once, numbered, and dealt over all tasks; only their states meet
    again, and then their ids.
    """
    sent = _model(docs.sparkSession, model_path)
    kind = docs.schema[id_col].dataType
    digest = [("decoded_sha256", "string")] if checked else []
    out = struct(("id", kind), ("n_tokens", "bigint"), ("token_ids", "binary"), *digest, ("n_chunks", "bigint"), ("text_sha256", "string"))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def small(batch: pa.RecordBatch) -> list:
        tokenizer, texts = _tokenizer(sent), batch.column(1).to_pylist()
        return [batch.column(0), *_told(tokenizer, [tokenizer.encode(t) for t in texts], checked), [1] * len(texts), [_sha(t) for t in texts]]

    short = arrow_map(source.filter(F.col("text").isNull() | (F.length("text") <= chunk_chars)), out, small)

    giants = source.filter(F.length("text") > chunk_chars).select(F.monotonically_increasing_id().alias("row"), "id", "text")
    states = "array<int>"
    piece = struct(("row", "bigint"), ("k", "int"), ("id", kind), ("sha", "string"), ("chunk", "string"), ("size", "int"), ("left", states), ("right", states))

    def cut(batches):
        arrow = to_arrow_schema(piece)
        for batch in batches:
            for row, name, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                sha, made = _sha(text), _tokenizer(sent).chunks(text, chunk_chars)
                for at in range(0, len(made), 16):
                    yield pa.RecordBatch.from_pylist([{"row": row, "k": at + k, "id": name, "sha": sha, "chunk": c, "size": n, "left": a, "right": b} for k, (c, n, a, b) in enumerate(made[at : at + 16])], schema=arrow)

    # Kept, so that a chunk has one row number at all its uses, whatever order the rows came in.
    pieces = durable(giants.mapInArrow(cut, piece).repartition("row", "k"))

    way = "array<struct<i: int, j: int, first: int, last: int>>"

    def through(batch: pa.RecordBatch) -> list:
        tokenizer = _tokenizer(sent)
        rows = zip(*(batch.column(c).to_pylist() for c in range(1, 6)), strict=True)
        return [batch.column(0), batch.column(1), [[dict(zip(("i", "j", "first", "last"), w, strict=True)) for w in tokenizer.transfer(text, n, a, b, k == 0)] for k, text, n, a, b in rows]]

    ways = arrow_map(pieces.select("row", "k", "chunk", "size", "left", "right"), struct(("row", "bigint"), ("k", "int"), ("ways", way)), through)
    chosen = struct(("row", "bigint"), ("k", "int"), ("i", "int"), ("j", "int"))

    def combine(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        steps = path([[(w["i"], w["j"], w["first"], w["last"]) for w in r["ways"]] for r in rows], _tokenizer(sent).goes)
        return pa.Table.from_pylist([{"row": r["row"], "k": r["k"], "i": i, "j": j} for r, (i, j) in zip(rows, steps, strict=True)], schema=to_arrow_schema(chosen))

    steps = ways.groupBy("row").applyInArrow(combine, chosen)
    encoded = struct(("row", "bigint"), ("k", "int"), ("id", kind), ("sha", "string"), ("ids", "binary"))

    def back(batch: pa.RecordBatch) -> list:
        tokenizer = _tokenizer(sent)
        rows = zip(*(batch.column(c).to_pylist() for c in (1, 4, 5, 6, 7, 8)), strict=True)
        return [*(batch.column(c) for c in range(4)), [tokenizer.between(text, i, n + j, k == 0, single) for k, text, n, single, i, j in rows]]

    joined = pieces.join(steps, ["row", "k"]).select("row", "k", "id", "sha", "chunk", "size", (F.size("left") == 1).alias("single"), "i", "j")
    parts = arrow_map(joined, encoded, back)

    def assemble(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        values = [[rows[0]["id"]], *_told(_tokenizer(sent), [b"".join(r["ids"] for r in rows)], checked), [len(rows)], [rows[0]["sha"]]]
        return pa.table([pa.array(v, type=f.type) for v, f in zip(values, to_arrow_schema(out), strict=True)], schema=to_arrow_schema(out))

    return short.unionAll(parts.groupBy("row").applyInArrow(assemble, out)).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "token_ids", model_path: str = MODEL_PATH, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the text of the ids. Null ids decode to the empty text; an empty table gives none."""
    sent = _model(encoded.sparkSession, model_path)
    schema = struct(*((c, encoded.schema[c].dataType) for c in keep), ("decoded", "string"))

    def rows(batch: pa.RecordBatch) -> list:
        tokenizer = _tokenizer(sent)
        return [*(batch.column(c) for c in range(len(keep))), [tokenizer.decode(x or b"") for x in batch.column(len(keep)).to_pylist()]]

    return arrow_map(encoded.select(*keep, ids_col), schema, rows)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Encode and decode in one pass: id, n_tokens, n_chunks, ids_sha256, text_sha256, decoded_sha256, same."""
    encoded = encode(docs, id_col, text_col, model_path, chunk_chars, checked=True)
    return encoded.select(id_col, "n_tokens", "n_chunks", F.sha2("token_ids", 256).alias("ids_sha256"), "text_sha256", "decoded_sha256", (F.col("decoded_sha256") == F.col("text_sha256")).alias("same"))
