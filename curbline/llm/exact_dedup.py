"""Exact duplicates by content sort.

Sampled splitters range-partition the normalised texts, each partition is sorted externally, equal
texts become neighbours, and full comparisons of neighbours decide. The splitters are kept small: a
text's place is its first characters and its hash, so that no long text is sent to the driver, and
the sort within a partition compares whole texts. A group of copies that is heavier than half a
partition is spread over several places, and its few leading rows are merged afterwards.

Defined cases: a null text counts as empty; empty texts (or texts of white space) are equal to each
other. Of rows with equal text and equal length the smallest identifier stays, a null identifier
last; of rows equal in all three exactly one stays. Every input row counts, repeated rows too. An empty
table gives an empty result. Further columns of any name are ignored, or carried along unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import hot_limit, partitions, without_spaces
from curbline.session import settle

HEAD = 32  # characters of a text in its sort key


def _compared(docs: DataFrame, id_column: str, text_column: str, carry: bool) -> DataFrame:
    """Rows with their run of equal neighbours: (id, points, norm, h, hot, starts, run, head, salt[, row])."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.length(text).alias("points"),
        without_spaces(text).alias("norm"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    rows = rows.withColumns({
        "head": F.substring("norm", 1, HEAD),
        "h": F.xxhash64("norm"),
        "weight": F.octet_length("norm") + F.lit(64),
    })
    # what is stored has one copy of the text: the original row when that is wanted, else the normalised text
    rows = settle(rows.drop("norm") if carry else rows, "texts")
    limit = hot_limit(rows.agg(F.sum(F.col("weight").cast("long"))).first()[0] or 0, spark)
    hot = (
        rows.groupBy("h").agg(F.sum(F.col("weight").cast("long")).alias("load"))
        .where(F.col("load") > limit)
        .select("h", F.ceil(F.col("load") / F.lit(limit)).cast("long").alias("spread"))
    )
    placed = (
        rows.join(F.broadcast(hot), "h", "left")  # bound: see hot_limit
        .withColumn("salt", F.when(F.col("spread").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64("id", "points"), F.col("spread"))))
        .withColumn("hot", F.col("spread").isNotNull())
        .drop("spread", "weight")
        .repartitionByRange(partitions(spark), "head", "h", "salt")
    )
    if carry:
        placed = placed.withColumn("norm", without_spaces(F.coalesce(F.col(f"row.{text_column}"), F.lit(""))))
    place = ["head", "h", "salt"]
    order = Window.partitionBy(*place).orderBy("norm", F.desc("points"), F.asc_nulls_last("id"))
    before = F.lag("norm").over(order)
    return placed.withColumn("starts", before.isNull() | (before != F.col("norm"))).withColumn(
        "run", F.sum(F.col("starts").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )


def _first():
    """Sorts as the rows of a group do: longest, then smallest identifier, nulls last."""
    return F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("n"), F.col("id").alias("id"))


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the identifier column, keep_id, group_size, kept, text_sha256."""
    compared = _compared(docs, id_column, text_column, carry=False)
    run = Window.partitionBy("head", "h", "salt", "run")
    local = settle(
        compared.select("head", "h", "salt", "run", "hot", "starts", "id", "points",
                        F.sha2("norm", 256).alias("sha"), _first().alias("own"))
        .withColumns({"best": F.min("own").over(run), "n": F.count(F.lit(1)).over(run)})
        .select("id", "points", "sha", "h", "salt", "hot", "starts", "best", "n"),
        "runs",
    )
    # the leading rows of spread groups: a handful for each of a bounded number of hot hashes
    merged = (
        local.where("hot AND starts").groupBy("h", "sha")
        .agg(F.min(F.struct("best", "salt")).alias("m"), F.sum("n").alias("all_n"))
        .select("h", "sha", F.col("m.best").alias("all_best"), F.col("m.salt").alias("all_salt"), "all_n")
    )
    return local.join(F.broadcast(merged), ["h", "sha"], "left").select(
        F.col("id").alias(id_column),
        F.coalesce("all_best", "best")["id"].alias("keep_id"),
        F.coalesce("all_n", "n").alias("group_size"),
        (F.col("starts") & F.coalesce(F.col("all_salt") == F.col("salt"), F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    leading = _compared(docs, id_column, text_column, carry=True).where("starts")
    one = Window.partitionBy("h", "norm").orderBy(_first(), "salt")
    spread = (
        leading.where("hot").withColumn("rank", F.row_number().over(one))
        .where("rank = 1").select("row")
    )
    return leading.where("NOT hot").select("row").unionAll(spread).select("row.*")
