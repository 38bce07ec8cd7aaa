"""Lines that many documents share.

Hashes of line keys are range-partitioned and sorted by document and position, so that the first
occurrence of a key streams by before its others. Only hashes, identifiers and positions are moved. The
outcome is a bitmap per document, stored as the 64-line words that have a dropped line (all other words
keep every line); texts meet their bitmap at the end.

Keys that hold more rows than half a partition are decided from their count and largest document alone,
combined on the map side, and never sorted together.

Defined cases: a null or empty text is one empty line. A null identifier counts as one document, smaller
than all others. Rows that repeat an identifier are the same document for counting; each keeps its own
text. Lines are counted once per document, however often it repeats them. An empty table gives an empty
result. Further columns of any name are carried along unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import SPACES, hot_limit, lower_ascii, partitions
from curbline.session import settle

MIN_POINTS, MIN_DOCUMENTS = 20, 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def _identity(id_column: str, text_column: str) -> list[Column]:
    return [F.col(id_column).alias("id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("version")]


def line_bitmaps(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_points: int = MIN_POINTS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """(id, version, words): for documents that lose lines, the map from i to the bits of lines 64 i to
    64 i + 63, a set bit being a dropped line. ``version`` is the hash of the text."""
    spark = docs.sparkSession
    lines = docs.select(*_identity(id_column, text_column), F.posexplode(lines_of(F.col(text_column))))
    keyed = lines.select("id", "version", "pos", line_key(F.col("col")).alias("key")).where(
        F.length("key") >= min_points
    )
    # two independent 64-bit hashes: collisions stay out of reach for any number of lines
    seen = settle(
        keyed.select("id", "version", "pos", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g")),
        "lines",
    )
    limit = hot_limit(seen.count(), spark)
    sizes = seen.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"))
    hot = settle(sizes.where(F.col("n") > limit).select("h", "g"), "hot")  # bound: see hot_limit
    facts = (
        seen.join(F.broadcast(hot), ["h", "g"], "left_semi")
        .groupBy("h", "g", "id").agg(F.lit(1).alias("one"))
        .groupBy("h", "g").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last"))
    )
    common = (
        seen.join(F.broadcast(facts), ["h", "g"])
        .where((F.col("n_docs") >= min_documents) & ~F.col("id").eqNullSafe(F.col("last")))
    )
    streamed = Window.partitionBy("h", "g").orderBy(F.desc_nulls_last("id"), "pos")
    rare = (
        seen.join(F.broadcast(hot), ["h", "g"], "left_anti")
        .repartitionByRange(partitions(spark), "h", "g")
        .withColumn("nth", F.dense_rank().over(Window.partitionBy("h", "g").orderBy(F.desc_nulls_last("id"))))
        .withColumn("n_docs", F.max("nth").over(Window.partitionBy("h", "g")))
        .withColumn("first", F.first("id").over(streamed))
        .where((F.col("n_docs") >= min_documents) & ~F.col("id").eqNullSafe(F.col("first")))
    )
    dropped = rare.select("id", "version", "pos").unionAll(common.select("id", "version", "pos"))
    return (
        dropped.repartition(partitions(spark), "id", "version")
        .groupBy("id", "version", F.expr("pos div 64").cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
        .groupBy("id", "version")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"))
    )


def _joined(docs: DataFrame, bitmaps: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows of ``docs`` as a struct, with their bitmap. The bitmaps are hashed, the texts not sorted."""
    rows = docs.select(F.struct("*").alias("row"), *_identity(id_column, text_column))
    marks = bitmaps.select(F.col("id").alias("b_id"), F.col("version").alias("b_version"), "words")
    return rows.join(
        marks.hint("shuffle_hash"),
        F.col("id").eqNullSafe(F.col("b_id")) & (F.col("version") == F.col("b_version")),
        "left",
    )


def _kept_text(text: Column) -> Column:
    bit = lambda i: F.expr("words")[F.floor(i / 64).cast("int")].bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(i, F.lit(64)))
    )
    lines = F.filter(lines_of(text), lambda line, i: F.coalesce(bit(i), F.lit(0)) == 0)
    return F.when(F.col("words").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.concat_ws("\n", lines))


def line_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: identifier, n_lines, n_dropped, kept_sha256."""
    text = F.col(f"row.{text_column}")
    dropped = F.aggregate(
        F.map_values("words"), F.lit(0).cast("long"), lambda n, bits: n + F.bit_count(bits).cast("long")
    )
    return _joined(docs, line_bitmaps(docs, id_column, text_column), id_column, text_column).select(
        F.col("id").alias(id_column),
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.coalesce(dropped, F.lit(0).cast("long")).alias("n_dropped"),
        F.sha2(_kept_text(text), 256).alias("kept_sha256"),
    )


def drop_shared_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the shared lines taken out of the text column."""
    joined = _joined(docs, line_bitmaps(docs, id_column, text_column), id_column, text_column)
    return joined.select(*[
        _kept_text(F.col(f"row.`{c}`")).alias(c) if c == text_column else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ])
