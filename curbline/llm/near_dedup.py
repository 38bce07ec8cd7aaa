"""Near duplicates by bottom-k sketches of one hash function.

1. Each document keeps the ``SKETCH`` smallest hashes of its shingles, its number of shingles and a 128-bit
   fingerprint of the set. Documents with equal sets are one class from here on.
2. Inverted lists: of two sets with similarity 0.75 at least ``shared_least`` sketch values are common (always
   for small sets, whose sketch is the set; else but for a chance below 1e-8). So when each sketch leaves out
   its ``shared_least - 1`` most frequent values, such a pair still meets in the list of another one. Values
   from passages that many documents share are frequent, and drop out.
3. Every member of a list is compared with the list's most central member of about its size, the one whose
   sketch is the most common. The links found are contracted to components. A large group of near copies is
   thus settled with a number of pairs in proportion to its size.
   What is left are lists with members of different components. Their members meet again on their full sets:
   two sets that share nothing but common shingles can only be similar if neither has too many rarer ones, so
   each is listed under its rarest shingles, and the position of a shared one bounds the overlap.
4. A comparison estimates the similarity from the smallest values of the union of both sketches, and pairs
   that may reach the threshold are confirmed on their full sets, made from their texts again.

Shingles are compared as 64-bit hashes. Documents whose sets agree in size and in two 64-bit sums of mixed hashes are one
class without a comparison of the sets themselves.

Defined cases: a null text counts as empty; texts without words have an empty set, are linked with nothing and
are kept. Rows that repeat an identifier are one document; with different texts these are linked to each
other. A row with a null identifier belongs to the documents with an equal set, but starts no comparison, and is
kept when there are none. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import hot_limit, small_batches
from curbline.llm.shingles import WORDS, column_sets, mixed
from curbline.operators.intersections import connected_components
from curbline.session import settle

SKETCH = 96
SHARED = 46  # fewer common values among the 96 smallest of the union: chance below 1e-8 at similarity 0.75
PERCENT = 75


def _sketches(docs: DataFrame, id_column: str, text_column: str, words: int) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"), F.xxhash64(text).alias("version"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, kept, ends = [], [], [], [], [0]
            for s in column_sets(batch.column(1), words):
                n.append(len(s))
                one.append(int(mixed(s, 11).sum(dtype=np.uint64).astype(np.int64)))
                two.append(int(mixed(s, 12).sum(dtype=np.uint64).astype(np.int64)))
                kept.append(s[:SKETCH].astype(np.int64))
                ends.append(ends[-1] + len(kept[-1]))
            values = pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                ["id", "version", "n", "f1", "f2", "sketch"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sketch, f"id {kind}, version long, n long, f1 long, f2 long, sketch array<long>")


def shared_least(n: Column) -> Column:
    """Sketch values that a set of ``n`` shingles shares at least with any similar set."""
    small = F.ceil(n * F.lit(PERCENT) / F.lit(100)).cast("long")
    return F.when(n <= SKETCH * PERCENT // 100, small).otherwise(F.lit(SHARED).cast("long"))


def _sizes_fit(a: str, b: str) -> Column:
    """Sets whose sizes differ more cannot reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _listed(classes: DataFrame) -> DataFrame:
    """(v, node, n, common): each sketch value that the node is listed under and that another class has, too.
    ``common`` adds up how often the values of the node's sketch occur."""
    entries = classes.select("node", F.explode("sketch").alias("v"))
    counts = entries.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = entries.join(counts, "v").join(classes.select("node", "n"), "node")
    own = Window.partitionBy("node")
    size = F.least(F.col("n"), F.lit(SKETCH).cast("long"))
    place = F.row_number().over(own.orderBy("c", "v")) + size - F.count(F.lit(1)).over(own)
    return shared.withColumns({"place": place, "common": F.sum("c").over(own)}).where(
        F.col("place") <= size - shared_least(F.col("n")) + 1
    ).select("v", "node", "n", "common")


def _with_lists(entries: DataFrame, lists: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Entries joined with a row for each list, which has its number of ``members``.

    Lists above the hot limit are fewer than twice the partitions. They are sent to the entries, so that a crowded
    list is not gathered in one task; the others are joined by key.
    """
    limit = hot_limit(entries.count(), entries.sparkSession)
    lists = settle(lists, "lists")
    hot, others = lists.where(F.col("members") > limit), lists.where(F.col("members") <= limit)
    crowded = entries.join(F.broadcast(hot), keys, how)
    rest = entries.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(others, keys, how)
    return crowded.unionByName(rest).drop("members")


def _first_pairs(listed: DataFrame) -> DataFrame:
    """(a, b): every member of a list with the most central one of about its size."""
    banded = listed.withColumn("band", F.floor(F.log("n") / F.lit(math.log(100 / PERCENT))))
    heads = banded.groupBy("v", "band").agg(
        F.min(F.struct((-F.col("common")).alias("rank"), "node", "n")).alias("head"), F.count(F.lit(1)).alias("members")
    ).where("members > 1")
    return (
        _with_lists(banded, heads, ["v", "band"])
        .select(F.col("node").alias("a"), F.col("head.node").alias("b"), "n", F.col("head.n").alias("m"))
        .where((F.col("a") != F.col("b")) & _sizes_fit("n", "m"))
        .select("a", "b").distinct()
    )


def _labelled(listed: DataFrame, components: DataFrame) -> DataFrame:
    """Entries of the lists whose members are in different components, with their component as label."""
    named = listed.join(components.withColumnRenamed("component", "c"), "node", "left").withColumn(
        "label", F.coalesce("c", "node")).drop("c")
    named = settle(named, "labelled")
    several = named.groupBy("v").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count(F.lit(1)).alias("members"))
    return _with_lists(named, several.where("l < h").select("v", "members"), ["v"], "left_semi")


def _full_sets(docs: DataFrame, nodes: DataFrame, classes: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(node, n, v): all shingles of the nodes, from their texts."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.join(nodes.select(F.col("node").alias("id")), "id", "left_semi").select("text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                sets = list(column_sets(batch.column(0).slice(at, 128)))
                one, two = ([int(mixed(s, k).sum(dtype=np.uint64).astype(np.int64)) for s in sets] for k in (11, 12))
                ends = pa.array(np.r_[0, np.cumsum([len(s) for s in sets])], pa.int32())
                values = pa.array(np.concatenate(sets).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.ListArray.from_arrays(ends, values)],
                    ["f1", "f2", "shingles"],
                )

    sets = rows.mapInArrow(whole, "f1 long, f2 long, shingles array<long>")
    own = classes.select("f1", "f2", "node", "n").join(nodes, "node", "left_semi")
    one = sets.join(own, ["f1", "f2"]).groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    return settle(one, "sets").select("node", "n", F.explode("shingles").alias("v"))


def _overlap(a: Column, b: Column) -> Column:
    """The least overlap of similar sets of these sizes."""
    return F.ceil((a + b) * F.lit(PERCENT) / F.lit(100 + PERCENT)).cast("long")


def _open_pairs(
    listed: DataFrame, components: DataFrame, done: DataFrame, classes: DataFrame, docs: DataFrame,
    id_column: str, text_column: str,
) -> DataFrame:
    """(a, b): members of a list that are in different components, may be similar and were not compared."""
    nodes = settle(_labelled(listed, components).select("node").distinct(), "open")
    sets = _full_sets(docs, nodes, classes, id_column, text_column)
    counts = sets.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    own = Window.partitionBy("node")
    rarest_first = F.row_number().over(own.orderBy("c", "v")) + F.col("n") - F.count(F.lit(1)).over(own)
    smallest = F.ceil(F.col("n") * F.lit(PERCENT) / F.lit(100)).cast("long")
    entries = sets.join(counts, "v").withColumn("place", rarest_first).where(
        F.col("place") <= F.col("n") - smallest + 1).select("v", "node", "n", "place")
    entries = settle(_labelled(settle(entries, "rare"), components), "rare-open")
    # a member whose shingle comes too late for the smallest set in the list finds nothing there
    least = entries.groupBy("v").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("members"))
    may = F.col("n") - F.col("place") + 1 >= _overlap(F.col("n"), F.greatest("least", smallest))
    entries = settle(_with_lists(entries, least, ["v"]).where(may).drop("least"), "may")
    # the fullest component of a list is met by the others' members; its own members need not meet
    by_label = entries.groupBy("v", "label").agg(F.count(F.lit(1)).alias("members"))
    main = by_label.groupBy("v").agg(F.max(F.struct("members", "label")).alias("m"), F.sum("members").alias("members")).select(
        "v", F.col("m.label").alias("main"), "members")
    left = _with_lists(entries, main, ["v"]).where(F.col("label") != F.col("main"))
    right = entries.select("v", F.col("node").alias("b"), F.col("n").alias("m"), F.col("label").alias("other"), F.col("place").alias("at"))
    bound = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at")) + 1 >= _overlap(F.col("n"), F.col("m"))
    once = (F.col("other") == F.col("main")) | (F.col("node") > F.col("b"))
    pairs = left.join(right, "v").where(
        (F.col("label") != F.col("other")) & once & bound & _sizes_fit("n", "m")).select(F.col("node").alias("a"), "b")
    tested = done.unionAll(done.select("b", "a"))
    return pairs.distinct().join(tested, ["a", "b"], "left_anti")


def _may_be_similar(pairs: pa.RecordBatch) -> list[bool]:
    """Union-sketch estimate for two columns of sketches: common values among the smallest of the union. A sketch
    that is not full is a set."""
    out = []
    for left, right in zip(*(pairs.column(i) for i in (2, 3))):
        a, b = (side.values.to_numpy().view(np.uint64) for side in (left, right))
        union = np.sort(np.concatenate([a, b]))
        twice = union[1:] == union[:-1]
        whole = len(a) < SKETCH and len(b) < SKETCH
        distinct = len(union) - int(twice.sum())
        if whole:
            out.append(100 * int(twice.sum()) >= PERCENT * distinct)
        else:  # of the union's smallest values only as many are known as the shorter full sketch reaches
            first = np.cumsum(np.r_[True, ~twice])[1:]
            seen = min(SKETCH, distinct)
            common = int((twice & (first <= seen)).sum())
            out.append(common >= SHARED * seen // SKETCH)
    return out


def _is_similar(pairs: pa.RecordBatch) -> list[bool]:
    """Exact, for two columns of texts: 100 * intersection >= PERCENT * union of the full sets."""
    out = []
    for at in range(0, pairs.num_rows, 256):
        part = list(zip(*(pairs.column(i).slice(at, 256).to_pylist() for i in (2, 3))))
        texts = list(dict.fromkeys(t for pair in part for t in pair))
        sets = dict(zip(texts, column_sets(pa.array(texts, pa.string()))))
        for a, b in part:
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            out.append(100 * common >= PERCENT * (len(sets[a]) + len(sets[b]) - common) > 0)
    return out


def _pairs_where(pairs: DataFrame, test: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """(a, b) of the rows (a, b, left, right) that pass the test."""

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array(test(batch), pa.bool_()))

    return pairs.mapInArrow(passing, pairs.select("a", "b").schema)


def _confirmed(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_column: str, text_column: str, repeated: bool
) -> DataFrame:
    """The pairs that are links. ``repeated``: some rows repeat identifier and text, and one of them is enough."""
    sketch = classes.select("node", "sketch")
    near = settle(
        _pairs_where(
            pairs.join(sketch.toDF("a", "left"), "a").join(sketch.toDF("b", "right"), "b").select("a", "b", "left", "right"),
            _may_be_similar,
        ),
        "near",
    )
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    # both joins read the same exchange of the texts by identifier; only members are sent on, to their head
    members = texts.join(near.withColumnRenamed("a", "id"), "id")
    heads = texts.join(near.select(F.col("b").alias("id")).distinct(), "id", "left_semi")
    if repeated:
        one = F.xxhash64("text").alias("version")
        members = members.groupBy("id", "b", one).agg(F.first("text").alias("text"))
        heads = heads.groupBy("id", one).agg(F.first("text").alias("text"))
    members = members.select(F.col("id").alias("a"), "b", F.col("text").alias("left"))
    heads = heads.select(F.col("id").alias("b"), F.col("text").alias("right"))
    both = members.join(heads, "b").select("a", "b", "left", "right")
    return settle(_pairs_where(both, _is_similar).distinct(), "links")


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per row of ``docs``: id, version (the hash of its text), n, component, kept."""
    with small_batches(docs.sparkSession):  # all that runs Python is settled within
        return _settled_groups(docs, id_column, text_column)


def _settled_groups(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    sketches = settle(_sketches(docs, id_column, text_column, WORDS), "sketches")
    classes = settle(
        sketches.where("n > 0 AND id IS NOT NULL").groupBy("f1", "f2")
        .agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "classes",
    )
    listed = settle(_listed(classes), "listed")
    first = settle(_first_pairs(listed), "pairs")
    rows = sketches.where("id IS NOT NULL").groupBy("id", "version").agg(F.count(F.lit(1)).alias("c"))
    repeated = not rows.where("c > 1").isEmpty()
    links = _confirmed(first, classes, docs, id_column, text_column, repeated)
    # rows that share an identifier but not their set are versions of one document
    versions = sketches.where("n > 0 AND id IS NOT NULL").join(classes.select("f1", "f2", "node"), ["f1", "f2"])
    several = versions.groupBy("id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    links = settle(links.unionAll(versions.join(several, "id").select("id", "node").distinct()), "links")
    components = connected_components(links)
    more = _open_pairs(listed, components, first, classes, docs, id_column, text_column)
    more = _confirmed(more, classes, docs, id_column, text_column, repeated)
    if not more.isEmpty():
        components = connected_components(links.unionAll(more))
    components = components.withColumnRenamed("node", "c_node")
    named = classes.select("f1", "f2", "node").join(components, F.col("node") == F.col("c_node"), "left").select(
        "f1", "f2", F.coalesce("component", "node").alias("component"))
    found = sketches.drop("sketch").join(named, ["f1", "f2"], "left")
    component = F.when((F.col("n") > 0), F.col("component")).otherwise(F.col("id"))
    return found.select(
        "id", "version", "n", component.alias("component"), component.eqNullSafe(F.col("id")).alias("kept")
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: identifier, n_shingles, component_id, kept."""
    return _grouped(docs, id_column, text_column).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept"
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group. The identifiers are hashed, the texts not sorted."""
    kept = settle(
        _grouped(docs, id_column, text_column).where("kept")
        .select(F.col("id").alias("kept_id"), F.col("version").alias("kept_version")).distinct(),
        "kept",
    )
    version = F.xxhash64(F.coalesce(docs[text_column].cast("string"), F.lit("")))
    same = docs[id_column].eqNullSafe(kept["kept_id"]) & (version == kept["kept_version"])
    return docs.join(kept.hint("shuffle_hash"), same, "left_semi")
