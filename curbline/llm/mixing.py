"""Mixing sources to target weights.

The words of each source, its documents one after the other, are cut into blocks of fixed length. The mix is a
sequence of slots, dealt to shards of fixed size; a slot takes one block. Which source a slot belongs to is drawn at
random without replacement from all slots, so that the counts of the sources in a shard follow the
multinomial draw under the condition that the totals over all shards are met; independent draws would miss
the targets of small sources by their sampling noise. The slots of a source count through its blocks in a
pseudorandom order, another one in every pass, and are joined with the documents by block. The last slot of a
source is cut where its target is reached.

Both permutations are keyed Feistel networks on the index, so every task computes its part on its own, and
reruns agree. Positions of documents in their source come from sums per (source, bucket of the identifier),
so a source with a third of all rows is spread over all buckets.

Defined cases: a null text has no words; documents without words are never taken. A null source is a source of its
own, last in order. Repeated rows are documents of their own; rows equal in identifier and size are
interchangeable. An empty table gives an empty result. The sources (not their documents) come to the driver; a
mix names a weight for each, so they are as many as its settings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import cycle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import SPACES, WORD, partitions
from curbline.session import settle

BLOCK, SHARD, MOST, SEED = 64, 1024, 3, 17
WEIGHTS = (1.0, 2.0, 3.0)
SPACED_WORD = r"[\x20\x09-\x0D]*" + WORD


@dataclass
class Share:
    """What the mix takes of one source. ``passes`` whole ones over its blocks, then ``rest`` words."""

    number: int
    source: str | None
    size: int
    target: float
    words: int  # the target in whole words
    blocks: int
    slots: int
    first_slot: int


def targets(sizes: list[int], weights: list[float], most: int = MOST) -> list[float]:
    """Shares of the total by weight; where one exceeds ``most`` times its size, the excess is shared again."""
    total, capped = float(sum(sizes)), [False] * len(sizes)
    while True:
        left = total - sum(most * s for s, c in zip(sizes, capped) if c)
        weight = sum(w for w, c in zip(weights, capped) if not c)
        share = [float(most * s) if c else left * w / weight for s, w, c in zip(sizes, weights, capped)]
        over = [not c and t > most * s for t, s, c in zip(share, sizes, capped)]
        if not any(over):
            return share
        capped = [c or o for c, o in zip(capped, over)]


def _permuted(index: np.ndarray, size: int | np.ndarray, key: np.ndarray, turns: range) -> np.ndarray:
    """A keyed Feistel network on the next even number of bits; values outside the range go through it again."""
    size = np.broadcast_to(np.asarray(size, np.uint64), index.shape)
    key = np.broadcast_to(np.asarray(key, np.uint64), index.shape)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2).astype(np.float64)) / 2)).astype(np.uint64)
    half += (size > (np.uint64(1) << (np.uint64(2) * half))).astype(np.uint64)
    out, todo = index.astype(np.uint64).copy(), np.arange(len(index))
    while len(todo):
        h, k = half[todo], key[todo]
        mask = (np.uint64(1) << h) - np.uint64(1)
        left, right = out[todo] >> h, out[todo] & mask
        for turn in turns:
            x = (right if turns.step > 0 else left) ^ (k + np.uint64(turn * 0x9E3779B9))
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = (x ^ (x >> np.uint64(29))) & mask
            left, right = (right, left ^ x) if turns.step > 0 else (right ^ x, left)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def place_in_order(index: np.ndarray, size: int | np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of each index below ``size`` in a pseudorandom order chosen by ``key``."""
    return _permuted(index, size, key, range(4))


def index_at(place: np.ndarray, size: int | np.ndarray, key: np.ndarray) -> np.ndarray:
    """The index that comes at a place: the inverse of ``place_in_order``."""
    return _permuted(place, size, key, range(3, -1, -1))


def _key(*parts: int) -> int:
    key = 0x243F6A8885A308D3
    for part in parts:
        key = ((key ^ part) * 0x2545F4914F6CDD1D + 0x9E3779B97F4A7C15) % 2**64
        key ^= key >> 29
    return key


def shares(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> list[Share]:
    """The sources in order (code points, null last), with weights repeating."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    chosen = targets([n for _, n in ordered], [w for _, w in zip(ordered, cycle(weights))], most)
    out, first = [], 0
    for number, ((source, size), target) in enumerate(zip(ordered, chosen)):
        words, blocks = min(round(target), most * size), -(-size // BLOCK)
        slots = 0
        if size:
            whole, rest = divmod(words, size)
            slots = whole * blocks
            if rest:  # slots of the last pass, in its order, until the rest is reached
                short_at = _short_block_place(number, blocks, whole)
                lacking = blocks * BLOCK - size
                slots += -(-rest // BLOCK)
                if short_at < -(-rest // BLOCK) and (-(-rest // BLOCK)) * BLOCK - lacking < rest:
                    slots += 1
        out.append(Share(number, source, size, target, words, blocks, slots, first))
        first += slots
    return out


def _short_block_place(number: int, blocks: int, turn: int) -> int:
    """When the last block of a source, which may be short, comes in a pass."""
    return int(place_in_order(np.array([blocks - 1]), blocks, np.array([_key(SEED, number, turn)], np.uint64))[0])


class Mix:
    """A mix of ``docs``: the shares of its sources, its documents' places, and the slots that take them."""

    def __init__(
        self,
        docs: DataFrame,
        *,
        id_column: str = "doc_id",
        text_column: str = "text",
        source_column: str = "source",
        weights: tuple[float, ...] = WEIGHTS,
        most: int = MOST,
    ):
        self.spark = docs.sparkSession
        self.id_column, self.text_column = id_column, text_column
        size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
        text = F.coalesce(F.col(text_column), F.lit(""))
        sized = docs.select(
            F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), size.alias("size"),
            F.xxhash64(text).alias("version"),
        )
        sized = settle(sized, "sizes")
        buckets = 4 * partitions(self.spark)
        sized = sized.withColumn("bucket", F.pmod(F.xxhash64("id", "version"), F.lit(buckets)))
        sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        totals = [(r.source, r.words) for r in sums.groupBy("source").agg(F.sum("words").alias("words")).collect()]
        self.shares = shares(totals, weights, most)
        by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        bases = sums.select("source", "bucket", F.coalesce(F.sum("words").over(by_bucket), F.lit(0)).alias("base"))
        numbers = self._table(
            [(s.number, s.source, s.size, s.target) for s in self.shares],
            "number int, known string, source_size long, target double",
        )
        within = Window.partitionBy("source", "bucket").orderBy("id", "size", "version")
        bases = bases.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "base")
        here = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))
        placed = (
            sized.withColumn("before", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .withColumn("copy", F.row_number().over(Window.partitionBy("source", "bucket", "id", "version").orderBy("size")))
            .join(bases, here)
            .join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("known")))
        )
        #: id, version, copy, number, size, source_size, target and start: the document's first word in its source
        self.documents = settle(placed.select(
            "id", "version", "copy", "number", "size", "source_size", "target", (F.col("base") + F.col("before")).alias("start")
        ), "documents")

    def _table(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def slots(self) -> DataFrame:
        """(shard, slot, number, pass, block, words): what each slot of the mix takes."""
        plan = [s for s in self.shares if s.slots]
        total = sum(s.slots for s in plan)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = np.array([s.first_slot for s in plan])
            blocks, words, size, number = (
                np.array([getattr(s, name) for s in plan]) for name in ("blocks", "words", "size", "number")
            )
            ends = np.array([_short_block_place(s.number, s.blocks, s.words // s.size) for s in plan])
            for batch in batches:
                index = batch.column(0).to_numpy()
                which = np.searchsorted(first, index, "right") - 1
                turn, step = np.divmod(index - first[which], blocks[which])
                passes, own = np.unique(np.stack([number[which], turn]), axis=1, return_inverse=True)
                keys = np.array([_key(SEED, n, t) for n, t in passes.T.tolist()], np.uint64)[own.ravel()]
                block = index_at(step, blocks[which], keys)
                length = np.minimum(BLOCK, size[which] - block * BLOCK)
                # words that the slots before this one have taken in its pass
                lacking = blocks[which] * BLOCK - size[which]
                last = turn == words[which] // size[which]
                taken = step * BLOCK - np.where(ends[which] < step, lacking, 0)
                rest = words[which] - turn * size[which] - taken
                length = np.where(last, np.minimum(length, np.maximum(rest, 0)), length)
                place = place_in_order(index, total, np.full(len(index), _key(SEED, 1 << 40), np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place // SHARD), pa.array(place % SHARD), pa.array(number[which].astype(np.int32)),
                     pa.array(turn.astype(np.int32)), pa.array(block), pa.array(length)],
                    ["shard", "slot", "number", "pass", "block", "words"],
                )

        schema = "shard long, slot long, number int, pass int, block long, words long"
        return self.spark.range(total, numPartitions=partitions(self.spark)).mapInArrow(deal, schema)

    def pieces(self) -> DataFrame:
        """(shard, slot, pass, id, version, copy, number, size, first, last): words first to last - 1 of a document, taken by a slot."""
        spans = self.documents.where("size > 0").withColumn(
            "block", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))))
        begin = F.greatest(F.col("block") * BLOCK, F.col("start"))
        end = F.least(F.col("block") * BLOCK + F.col("words"), F.col("start") + F.col("size"))
        return (
            spans.join(self.slots(), ["number", "block"]).where(begin < end)
            .select("shard", "slot", "pass", "id", "version", "copy", "number", "size",
                    (begin - F.col("start")).alias("first"), (end - F.col("start")).alias("last"))
        )

    def taken(self) -> DataFrame:
        """One row per document: identifier, size, source_size, target, taken."""
        sums = self.pieces().groupBy("number", "id", "version", "copy").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
        named = sums.select(*[F.col(c).alias(f"t_{c}") for c in ("number", "id", "version", "copy")], "taken")
        same = F.lit(True)
        for c in ("number", "id", "version", "copy"):
            same = same & F.col(c).eqNullSafe(F.col(f"t_{c}"))
        return self.documents.join(named, same, "left").select(
            F.col("id").alias(self.id_column), "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )


def mixed_documents(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    length_column: str | None = None, **settings,
) -> DataFrame:
    """The mix as documents with the columns of ``docs``: a row for each pass that takes words of a document, its text
    being those words (the whole text where the pass takes them all). ``length_column`` is set to its length."""
    mix = Mix(docs, id_column=id_column, text_column=text_column, source_column=source_column, **settings)
    keys = ["number", "key", "version"]  # without nulls, so that rows of a key meet
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias("key")
    numbers = F.broadcast(mix._table([(s.number, s.source) for s in mix.shares], "number int, known string"))
    text = F.col(f"`{text_column}`").cast("string")
    rows = (
        docs.select(F.struct("*").alias("row"), key(f"`{id_column}`"),
                    F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"),
                    F.col(f"`{source_column}`").cast("string").alias("source"))
        .join(numbers, F.col("source").eqNullSafe(F.col("known")))
        .select(*keys, "row")
    )
    # of repeated rows one is taken, the pieces tell how often; rows that are not repeated are not sorted for that
    repeated = mix.documents.where("copy > 1").select("number", key("id"), "version").distinct()
    if not repeated.isEmpty():
        one = rows.join(repeated, keys, "left_semi").groupBy(*keys).agg(F.first("row").alias("row"))
        rows = rows.join(repeated, keys, "left_anti").unionByName(one)
    pieces = mix.pieces().groupBy("number", key("id"), "version", "copy", "pass").agg(
        F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"),
        (F.sum(F.col("last") - F.col("first")) == F.max("size")).alias("whole"),
    )
    text = F.col(f"row.`{text_column}`").cast("string")
    joined = rows.join(pieces.hint("shuffle_hash"), keys).withColumn(
        "cut", F.when(F.col("whole"), text).otherwise(words_of(text, F.col("spans")))
    )
    changed = {text_column: F.col("cut")} | ({length_column: F.length("cut")} if length_column else {})
    return joined.select(*[
        (changed[c].cast(docs.schema[c].dataType) if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns
    ])


def words_of(text: Column, spans: Column) -> Column:
    """The words in the spans (sorted, first to last - 1) with what stands between them; spans that touch are one, others
    get a new line between."""

    def joined(words: Column) -> Column:
        def part(span: Column, place: Column) -> Column:
            own = F.array_join(F.slice(words, span["first"].cast("int") + 1, (span["last"] - span["first"]).cast("int")), "")
            bare = F.ltrim(own, F.lit(SPACES))
            return (
                F.when(place == 0, bare)
                .when(F.get(spans, place - 1)["last"] == span["first"], own)
                .otherwise(F.concat(F.lit("\n"), bare))
            )

        return F.array_join(F.transform(spans, part), "")

    words = F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0))  # each with the white space before it
    return F.get(F.transform(F.array(words), joined), F.lit(0))  # a variable, so that the text is split once
