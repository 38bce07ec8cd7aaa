"""Alignment of the tokens that two vocabularies give the same text, and how often their tokens meet.

Vocabulary A is a byte-level one, B a sentencepiece model; both read a space and the text. The byte offsets where tokens
end are two rising lists, and where both hold the same offset a group of tokens ends. The lists are merged along
the merge path: binary searches on its diagonals divide the merge into pieces of equal work, wherever long texts lie.
Each piece reports the common ends it finds, which are its overlaps; a group open at a piece's border is closed by
the next piece that finds an end.

Every A token of a group is linked with every B token of it. How many documents hold a pair of ids linked is counted by a
combined aggregation. Counts come back to the documents in two ways: pairs in at least a fixed share of all
(document, pair) rows, of which there can be no more than ``FREQUENT``, are looked up in a table sent to the tasks; the
rows of all others are joined by pair.

Defined cases: texts that are null or empty, or whose tokens do not spell a space and the text (such as texts holding
U+2581, or normalised by B's model), have no tokens and count zero. Each row is a document, repeated rows and
null identifiers included. Names of special tokens are plain text. Texts are tokenised in slices, of one very long text at least;
links of one group are counted by distinct ids. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm.fill_in_middle import text_slices
from curbline.llm.packing import token_ids
from curbline.session import settle

#: Elements merged by a piece, and bytes of text tokenised at once.
PIECE, AT_ONCE = 1 << 16, 1 << 19
#: Links of a group above which they are counted by distinct ids.
CROWDED = 1 << 12
#: Greatest number of pairs whose counts are sent to every task: 24 bytes each.
FREQUENT = 1 << 18


class Vocabularies:
    """Bytes of the tokens of A and B, by id."""

    def __init__(self, path_a: str | None, path_b: str | None):
        import public_tokenizers
        import sentencepiece

        self.path_a = path_a
        with open(path_a or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
        self.a = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
        self.processor = sentencepiece.SentencePieceProcessor(
            model_file=path_b or public_tokenizers.path("piece_bpe_32k.model")
        )
        self.b = [self._piece(i) for i in range(self.processor.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(t) for t in side], np.int64) for side in (self.a, self.b))
        # decimal ids with what may follow them, for the digest of the groups: "," or "|" after A, "," or ";" after B
        self.written = [f"{i}{mark}" for i in range(len(self.a)) for mark in ",|"]
        self.written += [f"{i}{mark}" for i in range(len(self.b)) for mark in ",;"]

    def _piece(self, index: int) -> bytes:
        piece = self.processor.id_to_piece(index)
        if self.processor.is_byte(index):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B for each text; empty ones where either does not spell a space and the text."""
        out = []
        for text, ids_b in zip(texts, self.processor.encode(texts, num_threads=1)):
            ids_a = np.frombuffer(token_ids(" " + text, self.path_a), "<u4").astype(np.int64)
            wanted = b" " + text.encode()
            if (
                text
                and b"".join(map(self.b.__getitem__, ids_b)) == wanted
                and b"".join(map(self.a.__getitem__, ids_a.tolist())) == wanted
            ):
                out.append((ids_a, np.array(ids_b, np.int64)))
            else:
                out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
        return out


@lru_cache(maxsize=2)
def vocabularies(path_a: str | None = None, path_b: str | None = None) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def diagonals(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many elements of ``a`` are among the first ``at`` of the merge, where ``a`` goes first among equals.

    A binary search on each diagonal of the merge path, all of them in step.
    """
    low, high = np.maximum(0, at - len(b)), np.minimum(at, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        i, j = np.where(open_, middle, 0), np.where(open_, at - 1 - middle, 0)
        taken = open_ & (a[i] <= b[j])
        low, high = np.where(taken, middle + 1, low), np.where(open_ & ~taken, middle, high)
    return low


def piece_overlaps(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of A and B tokens up to each common end whose B token lies in the piece; the A end may be the last one before."""
    start = max(i0 - 1, 0)
    mine, theirs = a[start:i1], b[j0:j1]
    if not len(mine) or not len(theirs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
    same = np.flatnonzero(mine[place] == theirs)
    return start + place[same] + 1, j0 + same + 1


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of A and B tokens up to each end that both have, from pieces of equal work."""
    borders = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    i = diagonals(a, b, borders)
    j = borders - i
    found = [piece_overlaps(a, b, *x) for x in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist())]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *side]) for side in zip(*found)) if found else (none, none)


class Aligned:
    """Groups of the tokens of some texts, which follow one another without a gap."""

    def __init__(self, tokens: list[tuple[np.ndarray, np.ndarray]], known: Vocabularies, piece: int = PIECE):
        self.known, self.texts = known, len(tokens)
        none = np.zeros(0, np.int64)
        self.a = np.concatenate([none, *(a for a, _ in tokens)])
        self.b = np.concatenate([none, *(b for _, b in tokens)])
        self.n_a = np.array([len(a) for a, _ in tokens], np.int64)
        self.n_b = np.array([len(b) for _, b in tokens], np.int64)
        ends_a, ends_b = np.cumsum(known.size_a[self.a]), np.cumsum(known.size_b[self.b])
        self.end_a, self.end_b = common_ends(ends_a, ends_b, piece)  # the last ends of a text are common ends
        self.size_a = np.diff(self.end_a, prepend=0)
        self.size_b = np.diff(self.end_b, prepend=0)
        self.text = np.searchsorted(np.cumsum(self.n_a), self.end_a, "left")  # of each group

    def per_text(self, values: np.ndarray | None = None) -> np.ndarray:
        """Sums over the groups of each text, of ones by default."""
        out = np.zeros(self.texts, np.int64)
        np.add.at(out, self.text, 1 if values is None else values)
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, A id, B id and number of links, once for each pair of ids linked in a text, in this order."""
        width = len(self.known.b)
        space = len(self.known.a) * width
        links = self.size_a * self.size_b
        plain = np.flatnonzero(links <= CROWDED)
        group = np.repeat(plain, links[plain])
        step = np.arange(len(group)) - np.repeat(np.cumsum(links[plain]) - links[plain], links[plain])
        first_a, first_b = self.end_a - self.size_a, self.end_b - self.size_b
        a = self.a[first_a[group] + step // self.size_b[group]]
        b = self.b[first_b[group] + step % self.size_b[group]]
        keys, weights = [self.text[group] * space + a * width + b], []
        crowded = np.flatnonzero(links > CROWDED)
        for g in crowded.tolist():
            ids_a, times_a = np.unique(self.a[first_a[g] : self.end_a[g]], return_counts=True)
            ids_b, times_b = np.unique(self.b[first_b[g] : self.end_b[g]], return_counts=True)
            keys.append((self.text[g] * space + ids_a[:, None] * width + ids_b).ravel())
            weights.append((times_a[:, None] * times_b).ravel())
        if len(crowded):
            keys = np.concatenate(keys)
            weights = np.concatenate([np.ones(len(group), np.int64), *weights])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            keys, times = keys[first], np.add.reduceat(weights[order], first)
        else:
            keys = np.sort(keys[0])
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            keys, times = keys[first], np.diff(first, append=len(keys))
        text, pair = np.divmod(keys, space)
        return text, pair // width, pair % width, times

    def digests(self) -> list[str]:
        """SHA-256 of the groups of each text, written ``a1,a2|b1;a3|b2,b3``; empty for texts without tokens."""
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        group_a, group_b = (np.repeat(np.arange(len(s)), s) for s in (self.size_a, self.size_b))
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.end_a - 1] = 1
        last_b[self.end_b - 1] = 1
        codes[np.arange(len(self.a)) + (self.end_b - self.size_b)[group_a]] = 2 * self.a + last_a
        codes[np.arange(len(self.b)) + self.end_a[group_b]] = 2 * len(self.known.a) + 2 * self.b + last_b
        ends, out, start, written = np.cumsum(self.n_a + self.n_b).tolist(), [], 0, self.known.written
        for end in ends:
            text = "".join(map(written.__getitem__, codes[start:end].tolist()))
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if text else "")
            start = end
        return out


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def aligned_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, path_a: str | None = None,
    path_b: str | None = None,
) -> DataFrame:
    """Identifier and ``groups`` of every row: an array of (a, b), the ids of each group's tokens in order.

    ``path_a`` is the ranks file of a byte-level vocabulary and ``path_b`` a sentencepiece model, by default those of the
    installed public tokenizers.
    """
    rows = _rows(docs, id_column, text_column)
    ids = pa.list_(pa.int32())
    kind = pa.list_(pa.struct([("a", ids), ("b", ids)]))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(path_a, path_b)
        for batch in batches:
            for part in text_slices(batch, 2, AT_ONCE):
                found = Aligned(known.tokens(part.column(2).to_pylist()), known)
                groups = [[] for _ in range(found.texts)]
                a, b = found.a.tolist(), found.b.tolist()
                for text, i, n, j, m in zip(*(
                    x.tolist() for x in (found.text, found.end_a, found.size_a, found.end_b, found.size_b)
                )):
                    groups[text].append({"a": a[i - n : i], "b": b[j - m : j]})
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(groups, kind)], ["id", "groups"])

    of = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(align, f"id {of}, groups array<struct<a: array<int>, b: array<int>>>").withColumnRenamed(
        "id", id_column
    )


def aligned_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, path_a: str | None = None,
    path_b: str | None = None,
) -> DataFrame:
    """A stored table with row (a number of its own), id, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct
    linked pairs as arrays of A ids, B ids and numbers of links."""
    rows = _rows(docs, id_column, text_column)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(path_a, path_b)
        for batch in batches:
            for part in text_slices(batch, 2, AT_ONCE):
                found = Aligned(known.tokens(part.column(2).to_pylist()), known)
                text, a, b, links = found.pairs()
                ends = pa.array(np.searchsorted(text, np.arange(found.texts + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(found.n_a),
                        pa.array(found.n_b),
                        pa.array(found.per_text()),
                        pa.array(found.per_text(found.size_a * found.size_b)),
                        pa.array(found.digests(), pa.string()),
                        *(pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (a, b)),
                        pa.ListArray.from_arrays(ends, pa.array(links)),
                    ],
                    ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "links"],
                )

    of = rows.schema["id"].dataType.simpleString()
    return settle(
        rows.mapInArrow(
            align,
            f"row long, id {of}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "a array<int>, b array<int>, links array<long>",
        ),
        "aligned",
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, count (documents that hold the pair linked) and best (whether no pair of this A id has a higher count).

    Only combined counts are shuffled. The best counts are one row per A id, as many as the vocabulary has.
    """
    counts = aligned.select(F.inline(F.arrays_zip("a", "b"))).groupBy("a", "b").agg(F.count("*").alias("count"))
    counts = settle(counts, "pair-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def _frequent(spark: SparkSession, counts: DataFrame, total: int, most: int):
    """Counts of the pairs that hold at least one in ``most`` of all rows, sent to the tasks: key, count, best; and the
    least such count."""
    least = max(1, -(-total // most))
    found = counts.filter(F.col("count") >= least).toArrow()
    a, b, count, best = (found.column(c).to_numpy() for c in ("a", "b", "count", "best"))
    key = a.astype(np.int64) << 32 | b
    order = np.argsort(key)
    return spark.sparkContext.broadcast((key[order], count[order].astype(np.int64), best[order].astype(np.int64))), least


def _flat(batch: pa.RecordBatch, frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair and links of each pair of a batch, where the pair stands in ``frequent``, and whether it does."""
    a, b, links = (batch.column(c) for c in ("a", "b", "links"))
    sizes = np.diff(a.offsets.to_numpy())
    key = a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy()
    place = np.minimum(np.searchsorted(frequent[0], key), max(len(frequent[0]) - 1, 0))
    known = frequent[0][place] == key if len(frequent[0]) else np.zeros(len(key), bool)
    return np.repeat(np.arange(batch.num_rows), sizes), key, links.flatten().to_numpy(), place, known


def link_statistics(aligned: DataFrame, counts: DataFrame, *, most: int = FREQUENT) -> DataFrame:
    """row, n_best and count_sum of each document of ``aligned_documents``, by the ``counts`` of its pairs."""
    spark = aligned.sparkSession
    total = counts.agg(F.sum("count")).first()[0] or 0
    sent, least = _frequent(spark, counts, total, most)
    lists = aligned.select("row", "a", "b", "links")

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in batches:
            document, _, links, place, known = _flat(batch, frequent)
            best, summed = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            document, links, place = document[known], links[known], place[known]
            np.add.at(best, document, links * frequent[2][place])
            np.add.at(summed, document, links * frequent[1][place])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best), pa.array(summed)], ["row", "n_best", "count_sum"]
            )

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            document, key, links, _, known = _flat(batch, sent.value)
            rows = batch.column(0).to_numpy()[document[~known]]
            key = key[~known]
            columns = rows, (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32), links[~known]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "a", "b", "links"])

    rare = (
        lists.mapInArrow(others, "row long, a int, b int, links long")
        .join(counts.filter(F.col("count") < least), ["a", "b"])
        .select(
            "row",
            F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"),
            (F.col("links") * F.col("count")).alias("count_sum"),
        )
    )
    found = lists.mapInArrow(looked_up, "row long, n_best long, count_sum long")
    return found.unionByName(rare).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])


def alignment_digest(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, path_a: str | None = None,
    path_b: str | None = None, most: int = FREQUENT,
) -> DataFrame:
    """Identifier, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    aligned = aligned_documents(docs, id_column, text_column, path_a=path_a, path_b=path_b)
    statistics = link_statistics(aligned, settle(pair_counts(aligned), "best-pairs"), most=most)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return aligned.join(statistics, "row").select(F.col("id").alias(id_column), *names)
