"""Exact, line and near duplicates against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from curbline.llm import exact_dedup, line_dedup, near_dedup
from tests.llm.helpers import SPACES, UPPER, awkward, components, documents, prose, shingles

LAST = 10**9


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def expected_exact(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(SPACES, "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), i == 0, sha) for i, m in enumerate(members)]
    return sorted(out, key=repr)


EXACT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_exact_duplicates_of_awkward_rows(spark):
    rows = awkward()
    docs = documents(spark, rows)
    assert rows_of(exact_dedup.exact_duplicates(docs), *EXACT) == expected_exact(rows)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    want = sorted((r[0] for r in expected_exact(rows) if r[3]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want


def test_a_hot_group_of_copies_is_spread_and_merged(spark):
    rows = [(i, "copy of\x0bone  text" + " " * (i % 3)) for i in range(400)] + [(1000 + i, prose(i, 5)) for i in range(100)]
    docs = documents(spark, rows, extra=False)
    compared = exact_dedup._compared(docs, "doc_id", "text", False)
    assert compared.where("hot").select("salt").distinct().count() > 2
    assert rows_of(exact_dedup.exact_duplicates(docs), *EXACT) == expected_exact(rows)
    assert exact_dedup.drop_exact_duplicates(docs).count() == len({re.sub(SPACES, "", t) for _, t in rows})


def test_equal_heads_and_hashes_are_told_apart_by_full_comparison(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    rows = [(i, "the same first characters of a text " * 3 + str(i // 2)) for i in range(20)]
    docs = documents(spark, rows, extra=False)
    assert rows_of(exact_dedup.exact_duplicates(docs), *EXACT) == expected_exact(rows)


def expected_lines(rows):
    holders, lines = defaultdict(set), [(r[0], (r[1] or "").split("\n")) for r in rows]
    key = lambda line: re.sub(f"^{SPACES}+|{SPACES}+$", "", line).translate(UPPER)
    rank = lambda d: (-1 if d is None else d)
    for doc_id, parts in lines:
        for line in parts:
            if len(key(line)) >= 20:
                holders[key(line)].add(rank(doc_id))
    out = []
    for doc_id, parts in lines:
        kept = [x for x in parts if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == rank(doc_id)]
        out.append((doc_id, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


LINES = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


@pytest.mark.parametrize("hot", [False, True])
def test_shared_lines(spark, hot):
    rows = awkward()
    if hot:  # one line in most rows, and one document with many lines
        rows += [(500 + i, f"a line that nearly every document has\nown {i}\n") for i in range(300)]
        rows += [(900, "\n".join(f"line number {i % 150} of a long document" for i in range(500)))]
        rows += [(901 + i, "\n".join(f"line number {j} of a long document" for j in range(i, 150, 3))) for i in range(3)]
    docs = documents(spark, rows)
    assert rows_of(line_dedup.line_digest(docs), *LINES) == expected_lines(rows)
    cleaned = line_dedup.drop_shared_lines(docs)
    assert cleaned.columns == docs.columns
    hashes = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in cleaned.collect())
    assert hashes == sorted(r[3] for r in expected_lines(rows))


def test_bitmaps_hold_only_words_with_dropped_lines(spark):
    rows = [(i, "\n".join(["own"] * 200 + ["a line of more than twenty characters"])) for i in range(3)]
    bitmaps = {r.id: r.words for r in line_dedup.line_bitmaps(documents(spark, rows)).collect()}
    assert bitmaps == {0: {3: 1 << 8}, 1: {3: 1 << 8}}


NEAR = ["doc_id", "n_shingles", "component_id", "kept"]


def near_rows(seed, families=6, members=8):
    rng, rows = random.Random(seed), []
    passage = prose(999, 60).split(" ")
    for f in range(families):
        base = prose(seed * 100 + f, rng.randint(5, 300)).split(" ")
        for m in range(members):
            words = list(base)
            for _ in range(int(len(words) * rng.choice([0, 0.01, 0.03, 0.05, 0.08]))):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append((f * 100 + m, " ".join(words)))
    rows += [(5000 + i, " ".join(passage + prose(seed + 7000 + i, rng.randint(10, 80)).split(" "))) for i in range(60)]
    rows += [(6000 + i, " ".join(f"a{i}" for i in range(i, i + rng.randint(1, 7)))) for i in range(12)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = near_rows(seed)
    want = components(dict(rows))
    found = rows_of(near_dedup.near_duplicates(documents(spark, rows)), *NEAR)
    assert found == sorted(((k, len(shingles(t)), want[k], want[k] == k) for k, t in rows), key=repr)


def test_near_duplicates_of_awkward_rows(spark):
    rows = awkward()
    docs = documents(spark, rows)
    want = components({r[0]: r[1] for r in rows if r[0] is not None})
    found = near_dedup.near_duplicates(docs)
    assert found.count() == len(rows)
    for r in found.where("doc_id IS NOT NULL").collect():
        assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id), r
    nulls = {(r.n_shingles, r.component_id, r.kept) for r in found.where("doc_id IS NULL").collect()}
    assert nulls == {(0, None, True), (len(shingles(rows[5][1])), 6, False)}
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want_kept = sorted((r.doc_id for r in found.where("kept").collect()), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want_kept


def test_versions_of_one_identifier_are_linked(spark):
    one, two = prose(1, 50), prose(2, 50)
    found = near_dedup.near_duplicates(documents(spark, [(1, one), (5, one), (5, two), (9, two)]))
    assert {r.component_id for r in found.collect()} == {1}


def test_a_large_group_of_near_copies_needs_few_pairs(spark):
    rng, base = random.Random(3), prose(5, 200).split(" ")
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(words)))
    docs = documents(spark, rows, extra=False)
    sketches = near_dedup._sketches(docs, "doc_id", "text", 5).where("n > 0")
    classes = sketches.select(sketches.id.alias("node"), "n", "f1", "f2", "sketch")
    assert near_dedup._first_pairs(near_dedup._listed(classes)).count() < 10 * len(rows)
    assert {r.component_id for r in near_dedup.near_duplicates(docs).collect()} == {0}


@pytest.mark.parametrize("operator", [
    exact_dedup.exact_duplicates, exact_dedup.drop_exact_duplicates, line_dedup.line_digest,
    line_dedup.drop_shared_lines, near_dedup.near_duplicates, near_dedup.drop_near_duplicates,
])
def test_empty_tables(spark, operator):
    assert operator(documents(spark, [(1, "a")]).limit(0)).collect() == []
