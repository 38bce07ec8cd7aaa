"""Encoding and decoding by a byte-level vocabulary through a sentencepiece model made from its ranks.

The ranks file lists tokens as bytes, each with its rank. The model is serialised directly, nothing is trained: a
piece per token, its bytes mapped to characters from U+0100 on, scored by the negative rank, under identity
normalisation. Merging the adjacent pair of the best score is then merging the pair of the lowest rank, the leftmost
first, which is what byte pair encoding by ranks does. A text is cut into pre-tokens by the vocabulary's pattern; each
distinct pre-token is encoded once and remembered within a task, up to a bound of memory. A pre-token that is itself a token is
that token. Decoding maps ids to pieces and characters back to bytes.

Defined cases: a null text counts as empty and has no tokens. Rows are encoded one by one, so repeated rows and null
identifiers give repeated rows and null identifiers. Names of special tokens are plain text. Of very long texts a
bounded number of pre-tokens is held at once. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters above the white space of the first 256 stand for bytes.
FIRST_CHARACTER = 0x100
_TO_CHARACTERS = {byte: byte + FIRST_CHARACTER for byte in range(256)}

#: Pre-tokens held at once of a text, and characters of remembered pre-tokens in a task.
PART, REMEMBERED = 1 << 18, 1 << 23


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out) + bytes([value])


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protocol buffer field: a message or text, a 32-bit float, or an integer."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def bpe_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose pieces are ``tokens`` in order of rank, and an unknown piece after them."""
    normal, unknown, bpe = 1, 2, 2
    pieces = [
        _field(1, _mapped(token).encode()) + _field(2, -float(rank)) + _field(3, normal)
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(tokens))
    plain = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))  # no dummy prefix, no white-space rules
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, plain)


def _mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_CHARACTERS)


def _unmapped(piece: str) -> bytes:
    return bytes(ord(c) - FIRST_CHARACTER for c in piece)


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: str | None, pattern: str | None):
        import public_tokenizers
        import regex
        import sentencepiece

        with open(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=bpe_model(tokens))
        self.ranks = array("I", (ranks[t] for t in tokens))
        self.tokens = {r: _unmapped(self.processor.id_to_piece(i)) for i, r in enumerate(self.ranks)}
        self.whole = {t: r.to_bytes(4, "little") for r, t in self.tokens.items()}
        self.pattern = regex.compile(pattern or public_tokenizers.PATTERN)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _parts(self, text: str) -> Iterator[list[str]]:
        if len(text) <= PART:
            yield self.pattern.findall(text)
        else:
            found = (m.group() for m in self.pattern.finditer(text))
            while part := list(islice(found, PART)):
                yield part

    def _learn(self, words: set[str]) -> None:
        rest = []
        for word in words:
            as_bytes = word.encode()
            if as_bytes in self.whole:
                self.known[word] = self.whole[as_bytes]
            else:
                rest.append((word, as_bytes))
        encoded = self.processor.encode([_mapped(b) for _, b in rest], num_threads=1)
        for (word, _), ids in zip(rest, encoded):
            self.known[word] = struct.pack(f"<{len(ids)}I", *[self.ranks[i] for i in ids])
        self.held += sum(map(len, words))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        out = []
        for words in self._parts(text):
            new = set(words).difference(self.known)
            if new:
                self._learn(new)
            out += map(self.known.__getitem__, words)
            if self.held > REMEMBERED:
                self.known, self.held = {}, 0
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


@lru_cache(maxsize=2)
def byte_bpe(vocabulary: str | None = None, pattern: str | None = None) -> ByteBpe:
    return ByteBpe(vocabulary, pattern)


def encode_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, vocabulary: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Identifier, n_tokens and ids (little-endian 32-bit integers) of every row.

    ``vocabulary`` is the path of a ranks file and ``pattern`` what cuts texts into pre-tokens, by default those of the
    installed public tokenizers.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [bpe.encode(text.as_py()) for text in part.column(1)]
                count = pa.array([len(i) // 4 for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), count, pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, n_tokens long, ids binary").withColumnRenamed("id", id_column)


def decode_documents(encoded: DataFrame, id_column: str = "doc_id", *, vocabulary: str | None = None) -> DataFrame:
    """The rows of ``encode_documents`` with ``decoded``, the bytes that their ids stand for."""
    rows = encoded.select(F.col(id_column).alias("id"), "n_tokens", "ids")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                decoded = pa.array([bpe.decode(ids.as_py()) for ids in part.column(2)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], ["id", "n_tokens", "ids", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"id {kind}, n_tokens long, ids binary, decoded binary").withColumnRenamed(
        "id", id_column
    )


def byte_bpe_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Identifier, n_tokens, ids_sha256, decoded_sha256."""
    return decode_documents(encode_documents(docs, id_column, text_column), id_column).select(
        id_column,
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
