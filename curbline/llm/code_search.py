"""Exact nearest binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments. Two codes at distance d agree in some segment up to d // segments bits, so
once all segments have been probed up to radius r, every code nearer than segments * (r + 1) has been verified. A query grows r
until its k-th verified distance is covered. The values of a segment at distance r are found by probing all of them, or,
where those are more than the segment has distinct values, by comparing with these. Codes are verified only once.

The index is cut into blocks of bounded size, the distinct query codes too, and every pair of blocks is one task. There
are about as many pairs as tasks, cut so that the fewest rows are copied. The results of a query code, at most
k from each block, are merged. Of rows with equal codes only the k smallest
identifiers can be in any result, so a vector that a third of all rows share is k rows of the index, and is asked once.

Defined cases: rows with a null identifier or vector are neither indexed nor asked. Null elements and missing ones
count as not positive; elements beyond the 64th are not read. Ties go to the smaller identifier. A query finds
itself, too. Repeated rows are one. With fewer than k rows a query gets all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import partitions
from curbline.session import settle

BITS, NEAREST = 64, 10
INDEX_BLOCK, QUERY_BLOCK, QUERIES_A_TASK, ROWS_A_TASK = 1 << 20, 1 << 20, 256, 1 << 14


def sign_code(vector: Column) -> Column:
    """One bit an element, 1 where it is positive."""
    bit = lambda x: F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return F.aggregate(
        F.slice(vector, 1, BITS), F.lit(0).cast("long"), lambda code, x: F.shiftleft(code, 1).bitwiseOR(bit(x))
    )


class SegmentIndex:
    """The codes of one block by the values of each segment."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.codes, self.ids = codes[order], ids[order]  # by identifier: positions break ties
        count = int(np.clip(round(BITS / max(1.0, np.log2(max(2, len(codes))))), 2, 8))
        edges = np.linspace(0, BITS, count + 1).astype(int)
        self.segments = []
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            values = (self.codes >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
            by_value = np.argsort(values, kind="stable")
            distinct, first = np.unique(values[by_value], return_index=True)
            self.segments.append((low, high - low, distinct, np.append(first, len(values)), by_value))
        self.rings: dict[tuple[int, int], np.ndarray] = {}
        self.queries = self.verified = 0

    def _ring(self, width: int, radius: int) -> np.ndarray:
        """All values of ``width`` bits with ``radius`` of them set."""
        if (width, radius) not in self.rings:
            masks = [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]
            self.rings[width, radius] = np.array(masks, np.uint64)
        return self.rings[width, radius]

    def _probe(self, code: np.uint64, radius: int) -> np.ndarray:
        """Positions whose value differs from the code's in exactly ``radius`` bits of some segment."""
        found = [np.zeros(0, np.int64)]
        for low, width, distinct, first, by_value in self.segments:
            if radius > width:
                continue
            own = (code >> np.uint64(low)) & np.uint64((1 << width) - 1)
            if _choose(width, radius) <= len(distinct):
                wanted = own ^ self._ring(width, radius)
                at = np.minimum(np.searchsorted(distinct, wanted), len(distinct) - 1)
                at = at[distinct[at] == wanted]
            else:
                at = np.flatnonzero(np.bitwise_count(distinct ^ own) == radius)
            begin, size = first[at], first[at + 1] - first[at]
            found.append(by_value[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())])
        return np.concatenate(found)

    def nearest(self, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers and distances of the k nearest, by distance, then identifier."""
        seen = np.zeros(len(self.codes), bool)
        places, distance = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(max(width for _, width, *_ in self.segments) + 1):
            new = self._probe(code, radius)
            new = np.unique(new[~seen[new]])
            seen[new] = True
            places = np.concatenate([places, new])
            distance = np.concatenate([distance, np.bitwise_count(self.codes[new] ^ code).astype(np.int64)])
            covered = len(self.segments) * (radius + 1) - 1
            if len(places) >= k and np.partition(distance, k - 1)[k - 1] <= covered:
                break
        self.queries += 1
        self.verified += len(places)
        if len(places) > k:
            keep = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
            places, distance = places[keep], distance[keep]
        order = np.lexsort((places, distance))[:k]
        return self.ids[places[order]], distance[order]


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(min(k, n - k) if k <= n else 0):
        out = out * (n - i) // (i + 1)
    return out if k <= n else 0


def block_numbers(rows: int, codes: int, tasks: int) -> tuple[int, int]:
    """Blocks of the index and of the query codes: about ``tasks`` pairs, with few copies of either side, none too small
    to be worth a task and none too large for one."""
    fewest, most = -(-rows // INDEX_BLOCK), -(-rows // ROWS_A_TASK)
    row_blocks = max(1, fewest, min(most, round((tasks * rows / max(1, codes)) ** 0.5)))
    wanted = min(-(-tasks // row_blocks), -(-codes // QUERIES_A_TASK))
    return row_blocks, max(1, wanted, -(-codes // QUERY_BLOCK))


def nearest_codes(index: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """Both have id and code (64 bits as a long). Returns (query_id, rank, id, distance) for every query."""
    spark = index.sparkSession
    same = Window.partitionBy("code").orderBy("id")
    rows = settle(
        index.where("id IS NOT NULL AND code IS NOT NULL").distinct()
        .withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k).select("id", "code"),
        "codes",
    )
    asked = settle(queries.where("id IS NOT NULL AND code IS NOT NULL").distinct(), "queries")
    codes = settle(asked.select(F.col("code").alias("query")).distinct(), "query_codes")
    n_rows, n_codes = rows.count(), codes.count()
    row_blocks, code_blocks = block_numbers(n_rows, n_codes, partitions(spark))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("rows", F.pmod(F.xxhash64("id"), F.lit(row_blocks)).cast("int")).withColumn("asks", every(code_blocks))
    right = codes.withColumn("asks", F.pmod(F.xxhash64("query"), F.lit(code_blocks)).cast("int")).withColumn("rows", every(row_blocks))
    kind = rows.schema["id"].dataType.simpleString()

    def search(block: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query": [], "id": [], "distance": []}
        if len(block):
            found = SegmentIndex(block["code"].to_numpy(np.int64).view(np.uint64), block["id"].to_numpy())
            for query in asks["query"].to_numpy(np.int64):
                ids, distance = found.nearest(query.view(np.uint64), k)
                out["query"] += [query] * len(ids)
                out["id"] += ids.tolist()
                out["distance"] += distance.tolist()
        return pd.DataFrame(out)

    pairs = left.groupBy("rows", "asks").cogroup(right.groupBy("rows", "asks"))
    best = Window.partitionBy("query").orderBy("distance", "id")
    merged = (
        pairs.applyInPandas(search, f"query long, id {kind}, distance int")
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    )
    return asked.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(merged, "query").select(
        "query_id", F.col("rank").cast("long").alias("rank"), "id", F.col("distance").cast("long").alias("distance"))


def nearest_by_sign(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                    every: int = 20, k: int = NEAREST) -> DataFrame:
    """The k nearest rows, by Hamming distance of their sign codes, of each row whose identifier ``every`` divides."""
    coded = vectors.select(F.col(id_column).alias("id"), sign_code(F.col(vector_column)).alias("code"))
    found = nearest_codes(coded, coded.where(F.col("id") % every == 0), k)
    return found.select("query_id", "rank", F.col("id").alias(id_column), "distance")
