"""Packing tokenised documents into fixed-length sequences at balanced attention cost.

A document costs ``linear`` per token plus ``quadratic`` per squared token. Within a block of documents
(bounded by its tokens, so memory is bounded) whole sequences are cut off long documents, and what is left is
assigned in descending order to the sequence with the lowest cost so far that has room for it; where it fits
in none, it is cut to fill the cheapest. A block has exactly as many sequence tokens as document tokens: full
sequences, and the binary digits of the rest as sequences of a power-of-two length, which need no padding.

Blocks are filled inside the tasks that read the documents, so nothing is shuffled, and no group of
documents meets in one task.

Tokens are those of the byte-level vocabulary, plus one end token a document. The vocabulary's splitting rule
looks ahead only where white space follows white space; texts without that are split by a rule without
look-ahead, which gives the same pieces faster.

The names of the vocabulary's special tokens, where a text holds them, are read as those tokens.

Defined cases: a null text counts as empty, and an empty document is its end token. Repeated rows and null
identifiers are packed like others. An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import json
import os
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH, END, BLOCK_TOKENS = 2048, 1, 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024  # the cost of a token, and of a pair of tokens that attend to each other


#: The vocabulary's splitting rule for texts in which no two characters of white space are neighbours.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


@lru_cache(maxsize=2)
def _encoders(vocabulary: str | None):
    """Encodings for any text, and for texts without neighbouring white space."""
    import public_tokenizers
    import tiktoken

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special, beside = {}, os.path.splitext(path)[0] + ".json"
    if os.path.exists(beside):
        with open(beside, encoding="utf-8") as file:
            special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    full, plain = (
        tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        for name, pattern in (("full", public_tokenizers.PATTERN), ("plain", PLAIN_PATTERN))
    )
    return full, plain


def _neighbouring_spaces(text: str) -> bool:
    """True at least for the texts that have them."""
    pairs = any(pair in text for pair in ("  ", "\n\n", " \n", "\n "))
    return pairs or any(space in text for space in _OTHER_SPACES)


def token_ids(text: str, vocabulary: str | None = None, special: bool = False) -> bytes:
    """Ids of a text as little-endian 32-bit integers. With ``special``, names of special tokens are those tokens."""
    full, plain = _encoders(vocabulary)
    encoding = full if _neighbouring_spaces(text) else plain
    if special and any(name in text for name in encoding.special_tokens_set):
        ids = array("I", encoding.encode(text, allowed_special="all"))
    else:
        ids = array("I", encoding.encode_ordinary(text))
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def capacities(tokens: int, length: int = LENGTH) -> list[int]:
    """Sequence lengths that hold ``tokens`` exactly: full ones, then falling powers of two."""
    full, rest = divmod(tokens, length)
    return [length] * full + [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


class OpenSequences:
    """Sequences as (cost, number) by remaining room, under a tree of the least cost over room."""

    def __init__(self, length: int):
        self.base = 1 << length.bit_length()
        self.least = [(float("inf"), -1, 0)] * (2 * self.base)  # cost, number, room
        self.heaps: list[list[tuple[float, int, int]]] = [[] for _ in range(length + 1)]

    def add(self, room: int, entry: tuple[float, int]) -> None:
        heapq.heappush(self.heaps[room], (*entry, room))
        self._refresh(room)

    def take(self, size: int) -> tuple[int, tuple[float, int]]:
        """Remove the cheapest with room for ``size``, or, where none has it, the cheapest of all."""
        best, low, high = self.least[0], self.base + size, 2 * self.base
        while low < high:
            if low & 1:
                best = min(best, self.least[low])
                low += 1
            low, high = low >> 1, high >> 1
        if best[1] < 0:
            best = self.least[1]
        spent, number, room = heapq.heappop(self.heaps[best[2]])
        self._refresh(room)
        return room, (spent, number)

    def _refresh(self, room: int) -> None:
        at = self.base + room
        self.least[at] = self.heaps[room][0] if self.heaps[room] else self.least[0]
        while at > 1:
            at >>= 1
            self.least[at] = min(self.least[2 * at], self.least[2 * at + 1])


def assign(
    sizes: list[int], length: int = LENGTH, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) of documents with these sizes, and the number of sequences."""
    pieces, sequences, rest = [], 0, []
    for doc, size in enumerate(sizes):
        whole = size // length
        pieces += [(doc, i * length, length, sequences + i, 0) for i in range(whole)]
        sequences += whole
        if size % length:
            rest.append((size % length, doc, whole * length))
    rest.sort(key=lambda r: (-r[0], r[1]))
    room = capacities(sum(size for size, _, _ in rest), length)
    used = [0] * len(room)
    cost = lambda size: size * (linear + quadratic * size)
    # a short sequence starts with the cost of the tokens it lacks, so that it is not filled first
    queue = OpenSequences(length)
    for i, r in enumerate(room):
        queue.add(r, (cost(length - r), i))
    for size, doc, start in rest:
        while size:
            space, (spent, i) = queue.take(size)
            part = min(size, space)
            pieces.append((doc, start, part, sequences + i, used[i]))
            used[i], size, start = used[i] + part, size - part, start + part
            if part < space:
                queue.add(space - part, (spent + cost(part), i))
    return pieces, sequences + len(room)


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    length: int = LENGTH,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    vocabulary: str | None = None,
) -> DataFrame:
    """Pieces: identifier, start, length, ids (little-endian 32-bit integers), doc_tokens, sequence_id, offset.

    ``vocabulary`` is the path of the ranks file, by default that of the installed public tokenizers. Special tokens
    are the added tokens of the .json file of the same name beside it, if there is one.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    end = END.to_bytes(4, "little")
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        keys, ids, held = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal sequence
            pieces, count = assign([len(b) // 4 for b in ids], length, linear, quadratic)
            doc, start, size, own, offset = map(list, zip(*pieces))
            columns = [
                pa.concat_arrays(keys).take(pa.array(doc, pa.int64())),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int64()),
                pa.array([ids[d][4 * s : 4 * (s + n)] for d, s, n in zip(doc, start, size)], pa.binary()),
                pa.array([len(ids[d]) // 4 for d in doc], pa.int64()),
                pa.array([sequence + i for i in own], pa.int64()),
                pa.array(offset, pa.int64()),
            ]
            sequence += count
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for row in range(batch.num_rows):
                keys.append(batch.column(0).slice(row, 1))
                ids.append(token_ids(batch.column(1)[row].as_py(), vocabulary, special=True) + end)
                held += len(ids[-1]) // 4
                if held >= BLOCK_TOKENS:
                    yield close()
                    keys, ids, held = [], [], 0
        if ids:
            yield close()

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        pack,
        f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    ).withColumnRenamed("id", id_column)


def piece_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
