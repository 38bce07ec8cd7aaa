"""Fill-in-the-middle forms of documents, cut at numbers of code points that content-defined chunks locate.

Texts are cut into chunks where a rolling hash of their bytes says so, so equal passages give equal chunks wherever they
lie. A task remembers the summary of each chunk by its content: how many code points begin in it, and how many bytes
at its head belong to the code point begun before it. Chunks met again are recognised by comparing contents, not hashes.
The counts of a document's chunks, added up, give its length and the chunk of each cut; only that chunk is read again.

Defined cases: a null text counts as empty; empty texts and texts that hold a sentinel stay plain. A null identifier
counts as the empty text where the draws are made. Equal identifiers draw alike, so repeated rows give repeated rows.
Texts are hashed in windows and chunks have a greatest length, so very long texts take memory in proportion to their own
size only. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100

#: Bytes under the rolling hash, bits of it that must be zero at a chunk's end, greatest length of a chunk.
WINDOW, BITS, LONGEST = 32, 8, 4096
#: Bytes hashed at once, and bytes of remembered chunks in a task.
AT_ONCE, REMEMBERED = 1 << 20, 1 << 26

_GEAR = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(29)).astype(np.uint32)
_MASK = np.uint32((1 << BITS) - 1 << (32 - BITS))


def _rolling_ends(data: np.ndarray) -> np.ndarray:
    """Positions after which the hash of the last ``WINDOW`` bytes ends a chunk."""
    found = []
    for at in range(0, len(data), AT_ONCE):
        start = max(0, at - WINDOW + 1)
        h = _GEAR[data[start : at + AT_ONCE]]
        width = 1
        while width < WINDOW:  # sums over twice as many bytes
            longer = h.copy()
            longer[width:] += h[:-width] << np.uint32(width)
            h, width = longer, 2 * width
        ends = np.flatnonzero(h & _MASK == 0) + start + 1
        found.append(ends[ends > at])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(data: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Ends of the chunks of texts that follow one another in ``data``; ``documents`` are the ends of the texts.

    Whether a chunk ends depends on the text's own bytes only.
    """
    ends = _rolling_ends(data)
    starts = np.concatenate([[0], documents])
    ends = ends[ends - starts[np.searchsorted(starts, ends, "left") - 1] >= WINDOW]
    ends = np.union1d(ends, documents[np.diff(starts) > 0])
    sizes = np.diff(np.concatenate([[0], ends]))
    extra = (sizes - 1) // LONGEST
    if extra.any():  # chunks too long end every LONGEST bytes from their start on
        first = np.repeat(ends - sizes, extra)
        number = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        ends = np.union1d(ends, first + number * LONGEST)
    return ends


def _begins(chunk: bytes) -> np.ndarray:
    """Positions of the first bytes of code points."""
    return np.flatnonzero(np.frombuffer(chunk, np.uint8) & 0xC0 != 0x80)


class ChunkCounts:
    """Summaries of chunks, remembered by content."""

    def __init__(self, remembered: int = REMEMBERED):
        self.known: dict[bytes, tuple[int, int]] = {}
        self.held, self.remembered, self.shared = 0, remembered, 0

    def summary(self, chunk: bytes) -> tuple[int, int]:
        """Code points that begin in the chunk, and bytes at its head that belong to the one begun before."""
        found = self.known.get(chunk)
        if found is None:
            if chunk.isascii():
                found = len(chunk), 0
            else:
                begins = _begins(chunk)
                found = len(begins), int(begins[0]) if len(begins) else len(chunk)
            if self.held > self.remembered:
                self.known, self.held = {}, 0
            self.known[chunk] = found
            self.held += len(chunk) + 100
        else:
            self.shared += 1
        return found


class CutTexts:
    """Texts that follow one another in ``data``, with the number of code points before each chunk."""

    def __init__(self, data: bytes, documents: np.ndarray, counts: ChunkCounts):
        self.data, self.documents = data, documents
        self.ends = chunk_ends(np.frombuffer(data, np.uint8), documents)
        self.starts = np.concatenate([[0], self.ends])[:-1].astype(np.int64)
        self.summaries = [counts.summary(data[a:b]) for a, b in zip(self.starts.tolist(), self.ends.tolist())]
        self.before = np.concatenate([[0], np.cumsum([n for n, _ in self.summaries], dtype=np.int64)])
        first = np.concatenate([[0], documents])
        self.base = self.before[np.searchsorted(self.ends, first, "right")]  # code points before each text

    def length(self, document: int) -> int:
        return int(self.base[document + 1] - self.base[document])

    def place(self, document: int, points: int) -> int:
        """Where in ``data`` the code point begins that has so many before it in the document, or the document's end."""
        if points >= self.length(document):
            return int(self.documents[document])
        wanted = int(self.base[document]) + points
        chunk = int(np.searchsorted(self.before, wanted, "right")) - 1
        local, start = wanted - int(self.before[chunk]), int(self.starts[chunk])
        count, head = self.summaries[chunk]
        if local == 0:
            return start + head
        if count == self.ends[chunk] - start:  # a byte each
            return start + local
        return start + int(_begins(self.data[start : int(self.ends[chunk])])[local])


def _offsets(column: pa.Array) -> np.ndarray:
    """Where texts of a column without nulls begin in its buffer, and where the last one ends."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def text_slices(batch: pa.RecordBatch, index: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes in the text column ``index``, one row at least."""
    at, offsets = 0, _offsets(batch.column(index)) if batch.num_rows else None
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def _draws(id_column: str, seed: int) -> list[Column]:
    """Four 32-bit numbers from the hash of seed and identifier."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, seed: int = 1,
    plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
) -> DataFrame:
    """Identifier, n, form (plain, psm or spm), prefix_chars, middle_chars and output of every row.

    ``plain_from`` and ``spm_below`` are hundredths of the draws.
    """
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        *_draws(id_column, seed),
    )
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = ChunkCounts()
        for batch in batches:
            for part in text_slices(batch, 1, AT_ONCE):
                offsets = _offsets(part.column(1))
                first, last = int(offsets[0]), int(offsets[-1])
                data = part.column(1).buffers()[2][first:last].to_pybytes() if last > first else b""
                ends = offsets[1:] - first
                texts = CutTexts(data, ends, counts)
                out = {name: [] for name in ("n", "form", "prefix", "middle", "output")}
                draws = zip(*(part.column(i).to_pylist() for i in range(2, 6)))
                start = 0
                for row, (h1, h2, h3, h4) in enumerate(draws):
                    end, n = int(ends[row]), texts.length(row)
                    text = data[start:end]
                    if not text or p in text or s in text or m in text or h3 % 100 >= plain_from:
                        form, low, high, output = "plain", None, None, text
                    else:
                        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                        a, b = texts.place(row, low), texts.place(row, high)
                        prefix, middle, suffix = data[start:a], data[a:b], data[b:end]
                        if h4 % 100 < spm_below:
                            form, output = "spm", s + suffix + p + prefix + m + middle
                        else:
                            form, output = "psm", p + prefix + s + suffix + m + middle
                    out["n"].append(n)
                    out["form"].append(form)
                    out["prefix"].append(low)
                    out["middle"].append(None if low is None else high - low)
                    out["output"].append(output)
                    start = end
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(out["n"], pa.int64()),
                        pa.array(out["form"], pa.string()),
                        pa.array(out["prefix"], pa.int64()),
                        pa.array(out["middle"], pa.int64()),
                        pa.array(out["output"], pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        transform, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    ).withColumnRenamed("id", id_column)


def restored_text(form: str = "form", output: str = "output") -> Column:
    """The text that a form was made from. Sentinels occur in a rearranged output only where they were put."""
    parts = F.split(output, "<[PSM]>", -1)
    first, second, third = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(F.col(form) == "psm", F.concat(first, third, second))
        .when(F.col(form) == "spm", F.concat(second, third, first))
        .otherwise(F.col(output))
    )


def fill_in_middle_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Identifier, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    return fill_in_middle(docs, id_column, text_column).select(
        id_column,
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored_text(), 256).alias("restored_sha256"),
    )
