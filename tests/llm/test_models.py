"""Language network, packing, mixing, URL templates, code search and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from curbline.llm import code_search, language_id, mixing, packing, queries, url_filter
from curbline.llm.queries import RULES
from tests.llm.helpers import WORD, awkward, components, documents, prose

# ---- language -------------------------------------------------------------------------------------------------------


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(found) > 30 and (found.lang_pred == found.lang).mean() > 0.95
    assert found.score.between(0, 1).all()


def test_language_cases(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        lang, letters = (("xx", "abcde "), ("yy", "vwxyzé "))[i % 2]
        rows.append((i, "".join(rng.choices(letters, k=rng.randint(20, 900))) + "a" * (i % 2 == 0) + "v" * (i % 2), lang))
    rows += [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 !?", "xx"), (None, "abcabc abc", None), (1003, "vwx " * 9000, None)]
    docs = documents(spark, rows)
    net = language_id.fit_language_model(docs)
    assert net.languages == ["xx", "yy"]
    found = language_id.identify_languages(docs).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for i, lang, *_ in ((r[0], r[2]) for r in rows[:300]):
        assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and by_id[i].lang_pred == lang
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, None, 1003)] == ["und", "und", "und", "xx", "yy"]
    assert by_id[1000].score == 0 and by_id[None].held_out is False
    kept = language_id.keep_known_languages(docs, net)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    # neither language nor source nor identifier is an input of a prediction
    blind = docs.select(F.lit(7).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit("s").alias("source"))
    blind = language_id.identify_languages(blind, net=net)
    assert Counter(r.lang_pred for r in blind.collect()) == Counter(r.lang_pred for r in found)


def test_pair_tables_equal_the_plain_convolution():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (20, language_id.WINDOW)).astype(np.uint8)
    net = language_id.train(windows, np.array(["a", "b"] * 10))
    x, pooled = net.classes[windows], []
    for f in net.filters:
        width = len(f)
        z = sum(f[t][x[:, t : language_id.WINDOW - width + 1 + t]] for t in range(width))
        pooled.append(z.max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0)
    want = language_id._softmax(hidden @ net.dense + net.dense_bias)
    assert np.allclose(language_id.Predictor(net).windows(windows), want, atol=1e-4)


def test_without_labels_nothing_is_predicted(spark):
    docs = documents(spark, [(1, "abc", None), (2, "abd", None)])
    assert {(r.lang_pred, r.score) for r in language_id.identify_languages(docs).collect()} == {("und", 0.0)}
    assert language_id.identify_languages(docs.limit(0)).collect() == []


# ---- packing --------------------------------------------------------------------------------------------------------


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(reference_ids, "of"):
        reference_ids.of = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        reference_ids.of.encode_special_tokens = True
    return np.array(reference_ids.of.encode(text or "", add_special_tokens=False).ids + [packing.END], "<u4").tobytes()


@pytest.mark.parametrize("text", [
    "", " ", "a  b", " a b ", "a \n b", "it 's 12ab\n\nc d", "x" * 5000, "<|endoftext|> a", "日本 語 é x y\u3000z", "a\x85 b \x1c c", "a\r\nb\tc",
    "l'été d'un\xa0jour, ça va?!", "1 2  3\n 4", "tail\n",
])
def test_tokens_equal_the_tokenizer(text):
    assert packing.token_ids(text) + packing.END.to_bytes(4, "little") == reference_ids(text)


def test_special_tokens_are_packed_as_the_tokenizer_reads_them(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "a  <|endoftext|>  b\n\n", "x\n<|endoftext|><|endoftext|>\ny <|endoftext", "no\u3000<|endoftext|>\x85z", "it's", " <|endoftext|>s"]
    found = packing.pack_documents(documents(spark, list(enumerate(texts)))).collect()
    ids = defaultdict(list)
    for r in sorted(found, key=lambda r: r.start):
        ids[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    for i, text in enumerate(texts):
        want = reference.encode(text, add_special_tokens=False).ids
        assert ids[i] == want + [packing.END] and want.count(50256) == text.count("<|endoftext|>")


def check_packing(pieces, texts):
    own = defaultdict(list)
    for r in pieces:
        own[r.sequence_id].append(r)
    padding = 0
    for rows in own.values():
        rows.sort(key=lambda r: r.offset)
        size = sum(r.length for r in rows)
        assert [r.offset for r in rows] == np.r_[0, np.cumsum([r.length for r in rows])[:-1]].tolist()
        assert 0 < size <= packing.LENGTH
        padding += 0 if size & (size - 1) == 0 else packing.LENGTH - size
    assert padding == 0
    parts = Counter((r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens) for r in pieces)
    tokens = Counter()
    for (doc_id, start, length, ids, total), times in parts.items():
        assert len(ids) == 4 * length and any(
            t[4 * start : 4 * (start + length)] == ids and len(t) == 4 * total for t in texts[doc_id])
        tokens[doc_id] += times * length
    assert tokens == {k: sum(len(t) // 4 for t in v) for k, v in texts.items()}


def test_packing_round_trip(spark):
    rows = awkward()
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(reference_ids(r[1]))
    docs = documents(spark, rows)
    check_packing(packing.pack_documents(docs).collect(), texts)
    assert packing.pack_documents(docs.limit(0)).collect() == []


def test_assignment_covers_every_token_and_balances_cost():
    rng = random.Random(2)
    sizes = [rng.choice([1, 5, 100, 700, 2048, 2049, 9000]) + rng.randrange(50) for _ in range(800)]
    pieces, count = packing.assign(sizes)
    used, cost = Counter(), Counter()
    for doc, _, size, sequence, offset in pieces:
        assert offset == used[sequence]
        used[sequence] += size
        cost[sequence] += size + size * size / 1024
    assert sorted(used) == list(range(count))
    assert sum(n for n in used.values() if n < packing.LENGTH and n & (n - 1)) == 0
    covered = defaultdict(list)
    for doc, start, size, *_ in pieces:
        covered[doc].append((start, size))
    for doc, parts in covered.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) == sizes[doc]
    shared = [cost[s] for s in used if used[s] == packing.LENGTH and sum(p[3] == s for p in pieces) > 1]
    whole = packing.LENGTH + packing.LENGTH**2 / 1024
    assert max(shared) < whole and np.std(shared) < 0.25 * np.mean(shared)


def test_documents_are_cut_only_where_none_has_room():
    rng = random.Random(4)
    for length in (1, 7, 64):
        sizes = [rng.randint(1, length * 2) for _ in range(400)] + [1] * 30
        rest = sorted((-(s % length), d) for d, s in enumerate(sizes) if s % length)
        first = sum(s // length for s in sizes)
        cost = lambda n: n * (1.0 + n / 1024)
        room = packing.capacities(-sum(s for s, _ in rest), length)
        spent, want = [cost(length - r) for r in room], []
        for size, doc in rest:
            size = -size
            while size:
                among = [i for i, r in enumerate(room) if r >= size] or [i for i, r in enumerate(room) if r]
                i = min(among, key=lambda i: (spent[i], i))
                part = min(size, room[i])
                want.append((doc, part, first + i))
                room[i], spent[i], size = room[i] - part, spent[i] + cost(part), size - part
        found = [(d, n, s) for d, _, n, s, _ in packing.assign(sizes, length)[0] if s >= first]
        assert found == want and not any(room)


# ---- mixing ---------------------------------------------------------------------------------------------------------


def test_targets_reshare_what_exceeds_the_bound():
    assert mixing.targets([10, 100, 100], [1, 2, 3]) == [30, 72, 108]
    assert mixing.targets([1, 1, 98], [1, 2, 3]) == [3, 3, 94]
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0, 0]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000])
def test_orders_are_permutations(size):
    index = np.arange(size)
    place = mixing.place_in_order(index, size, np.uint64(9))
    assert sorted(place) == index.tolist() and (mixing.index_at(place, size, np.uint64(9)) == index).all()


def check_mix(spark, rows):
    docs = documents(spark, rows)
    sizes, totals = [len(WORD.findall(r[1] or "")) for r in rows], Counter()
    sources = [r[3] if len(r) > 3 else "s" for r in rows]
    for s, n in zip(sources, sizes):
        totals[s] += n
    ordered = sorted(totals, key=lambda s: (s is None, s or ""))
    want = dict(zip(ordered, mixing.targets([totals[s] for s in ordered], [1.0 + i % 3 for i in range(len(ordered))])))
    found = mixing.Mix(docs).taken().collect()
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((r[0], n) for r, n in zip(rows, sizes))
    assert all(0 <= r.taken <= 3 * r["size"] for r in found)
    assert abs(sum(r.taken for r in found) - sum(sizes)) <= len(totals)
    for r in found:
        assert math.isclose(r.target, min(want.values(), key=lambda t: abs(t - r.target)), abs_tol=1e-6)
    again = mixing.Mix(docs.repartition(5)).taken().collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    mix = mixing.Mix(docs)
    by_source = Counter()
    for r in mix.pieces().join(spark.createDataFrame([(s.number, s.source) for s in mix.shares], "number int, source string"), "number").collect():
        by_source[r.source] += r["last"] - r["first"]
    assert all(abs(by_source[s] - want[s]) <= 0.5 for s in totals)
    mixed = mixing.mixed_documents(docs, length_column="n_chars")
    assert mixed.columns == docs.columns
    texts = Counter(r[1] for r in rows)
    taken = Counter()
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        taken[r.doc_id] += len(WORD.findall(r.text))
    want_taken = Counter()
    for r in found:
        want_taken[r.doc_id] += r.taken
    assert taken == +want_taken and texts
    return mix


def test_mix_of_awkward_rows(spark):
    check_mix(spark, awkward())


def test_mix_with_a_hot_and_a_small_source(spark):
    rows = [(i, prose(i, 40 + i % 90), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(120)]
    rows += [(900, "three words only", "en", "tiny"), (901, prose(5, 3000), "en", None)]
    mix = check_mix(spark, rows)
    slots = mix.slots().toPandas()
    total = sum(s.slots for s in mix.shares)
    assert sorted(slots.shard * mixing.SHARD + slots.slot) == list(range(total))
    assert mixing.Mix(documents(spark, rows).limit(0)).taken().collect() == []


# ---- URLs -----------------------------------------------------------------------------------------------------------


def url_templates(leaves, max_children=50, z=1.96, depth=6):
    """leaves: (host, segments) to (labelled, good)."""
    template, closed = {leaf: () for leaf in leaves}, set()
    for level in range(max(len(parts) for _, parts in leaves) if leaves else 0):
        nodes = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for (host, parts), (n, g) in leaves.items():
            if level < len(parts) and (host, parts) not in closed:
                branch = nodes[host, template[host, parts]][parts[level]]
                branch[0] += n
                branch[1] += g
        names, shut = {}, set()
        for node, branches in nodes.items():
            n, g = (sum(v[i] for v in branches.values()) for i in (0, 1))
            if level >= depth and not 0 < g < n:
                shut.add(node)
                continue
            if len(branches) > max_children:
                continue
            for labelled in (False, True):
                groups = []
                for _, s, n, g in sorted((g / n if n else 0, s, n, g) for s, (n, g) in branches.items() if (n > 0) == labelled):
                    if groups:
                        n0, g0, _ = groups[-1]
                        p, p0 = (g + 1) / (n + 2), (g0 + 1) / (n0 + 2)
                        noise = p * (1 - p) / (n + 2) + p0 * (1 - p0) / (n0 + 2)
                    if not groups or labelled and abs(p - p0) > z * math.sqrt(noise):
                        groups.append([0, 0, []])
                    groups[-1][0] += n
                    groups[-1][1] += g
                    groups[-1][2].append(s)
                for *_, group in groups:
                    names.update({(node, s): "|".join(sorted(group)) for s in group})
        for leaf in leaves:
            if level < len(leaf[1]) and leaf not in closed:
                node = leaf[0], template[leaf]
                if node in shut:
                    closed.add(leaf)
                template[leaf] += ("**" if node in shut else names.get((node, leaf[1][level]), "*"),)
    return template


def brute_force_urls(pages, rules, labels=None, max_children=50, z=1.96, strength=2.0, least=0.5):
    def parsed(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        return (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")

    def lexical(path):
        parts = ["{id}" if re.fullmatch("[0-9a-f-]{16,}", p) else re.sub("[0-9]+", "{n}", p) for p in path.split("/") if p]
        return tuple(parts)

    def rule_of(host, path):
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: len(r.text), default=None)

    leaves = defaultdict(lambda: [0, 0])
    for _, url in pages:
        host, path = parsed(url)
        rule = rule_of(host, path)
        leaves[host, lexical(path)]
        if labels is None and rule:
            leaves[host, lexical(path)][0] += 1
            leaves[host, lexical(path)][1] += rule.verdict == "allow"
    for url, good in labels or []:
        host, path = parsed(url)
        leaves[host, lexical(path)][0] += 1
        leaves[host, lexical(path)][1] += good
    template = url_templates(leaves, max_children, z)
    total, good = (sum(v[i] for v in leaves.values()) for i in (0, 1))
    prior, sums = good / total if total else 1.0, defaultdict(lambda: [0, 0])
    for (host, parts), (n, g) in leaves.items():
        sums[host, template[host, parts]][0] += n
        sums[host, template[host, parts]][1] += g
    out = []
    for page, url in pages:
        host, path = parsed(url)
        rule = rule_of(host, path)
        n, g = sums[host, template[host, lexical(path)]]
        judged = "block" if (g + strength * prior) / (n + strength) < least else "allow"
        out.append((page, host, path, rule.text if rule else None, rule.verdict if rule else judged))
    return sorted(out, key=repr)


def url_rows(seed):
    rng = random.Random(seed)
    hosts = ["Example.net", "a.example.com", "example.com", "b.org", "spam.info", "hot.io", "xnet", "a.net"]
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://EXAMPLE.net/en/1?x=/de/"), (5, "http://EXAMPLE.net/en/1?x=/de/"),
            (6, "x://y.net#/en/"), (7, "ftp://example.net.evil.io/en/"), (None, "https://a.org/fr/x/y/z/1/2/3/4/5"), (8, "http://hot.io/" + "a/" * 3000)]
    for i in range(300):
        host = rng.choice(hosts + ["hot.io"] * 8)
        first = rng.choice(["en", "de", "fr", "p" + "abcdefghij"[i % 10], "0123456789abcdef0123"])
        rows.append((100 + i, f"http://{host}/{first}/{rng.choice(['', 'x/', 'y/'])}{rng.randrange(9)}{rng.choice(['', '.html', '?q', '#f'])}"))
    return rows


@pytest.mark.parametrize("labelled, max_children", [(False, 50), (True, 50), (True, 4)])
def test_url_verdicts_equal_brute_force(spark, labelled, max_children):
    rows, rng = url_rows(3), random.Random(5)
    labels = None
    if labelled:
        bad = lambda u: "/de/" in u or "spam" in u
        labels = [(u, int(not bad(u) if rng.random() < 0.9 else bad(u))) for _, u in rows if u and "://" in u and rng.random() < 0.5]
    pages = spark.createDataFrame([r + (0, "x") for r in rows], "page_id long, url string, segments long, host string")
    known = spark.createDataFrame(labels, "url string, good int") if labels else None
    found = url_filter.judge_urls(pages, RULES, known, max_children=max_children)
    have = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()), key=repr)
    want = brute_force_urls(rows, RULES, labels, max_children)
    assert have == want
    if labelled:
        assert {v for *_, rule, v in want if rule is None} == {"allow", "block"}
    assert url_filter.judge_urls(pages.limit(0), RULES).collect() == []


def inherited_purity(leaves, strength=2.0):
    """leaves: (host, segments) to (labelled, good)."""
    def scopes(host):
        parts = host.split(".")
        return ["", *(".".join(parts[-i:]) for i in range(1, min(8, len(parts) - 1) + 1)), "/" + host]

    trees = defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for (host, segments), (n, g) in leaves.items():
        for scope in {*scopes(host), host}:
            trees[scope][segments][0] += n
            trees[scope][segments][1] += g
    template = url_templates({(scope, segments): v for scope, tree in trees.items() for segments, v in tree.items()})
    counts = defaultdict(lambda: [0, 0])
    for scope, tree in trees.items():
        for segments, (n, g) in tree.items():
            for i in range(len(template[scope, segments]) + 1):
                counts[scope, template[scope, segments][:i]][0] += n
                counts[scope, template[scope, segments][:i]][1] += g
    prior, out = sum(v[1] for v in leaves.values()) / sum(v[0] for v in leaves.values()), {}
    for host, segments in leaves:
        nodes = [(i, rank, scope) for rank, scope in enumerate(scopes(host)) for i in range(len(template[scope, segments]) + 1)]
        purity = prior
        for i, _, scope in sorted(nodes):
            n, g = counts[scope, template[scope, segments][:i]]
            purity = (g + strength * purity) / (n + strength)
        out[host, segments] = template["/" + host, segments], purity
    return out


def test_purity_is_inherited_from_the_same_path_elsewhere(spark):
    rng = random.Random(7)
    leaves = {}
    for host in ["a.b.com", "b.com", "x.b.com", "c.com", "y.org", "org", "", "z.c.com.", "q." * 300 + "io", "com"]:
        for _ in range(14):
            segments = tuple(rng.choice("uvw") for _ in range(rng.choice([0, 1, 1, 2, 3, 9])))
            labelled = rng.choice([0, 0, 0, 1, 9])
            leaves[host, segments] = (labelled, rng.randint(0, labelled))
    table = spark.createDataFrame([(*k, *v) for k, v in leaves.items()], "host string, segments array<string>, labelled long, good long")
    found = url_filter.template_purity(table, inherit=True).collect()
    assert len(found) == len(leaves)
    want = inherited_purity(leaves)
    for r in found:
        template, purity = want[r.host, tuple(r.segments)]
        assert tuple(r.template) == template and math.isclose(r.purity, purity, abs_tol=1e-12)


def test_branches_are_compared_with_the_whole_group(spark):
    # neighbours differ little, the ends a lot
    leaves = [("h", [f"s{i:02d}"], 100, 5 * i) for i in range(21)] + [("k", ["a"], 1, 0), ("k", ["b"], 1, 1)]
    table = spark.createDataFrame(leaves, "host string, segments array<string>, labelled long, good long")
    found = {(r.host, r.segments[0]): r.template[0] for r in url_filter.template_purity(table).collect()}
    assert found["h", "s00"] != found["h", "s10"] != found["h", "s20"]
    assert found["k", "a"] == found["k", "b"] == "a|b"  # one label each tells nothing


def test_urls_of_one_host_get_two_verdicts(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = queries.op2_url_filter(spark, sf_dir).where("rule IS NULL").toPandas()
    assert found.verdict.nunique() == 2 and len(found) < pages.count()
    assert (found.groupby("host").verdict.nunique() == 2).any()
    # the rules block /de/ below one domain and most of another, and no rule allows it anywhere
    assert (found[found.path.str.startswith("/de/")].verdict == "block").all()


def test_templates_next_to_rules_get_their_verdict(spark, tmp_path):
    urls = ["http://a.example.com/de/1", "http://a.example.com/en/1", "http://new.example.com/en/1", "http://b.org/fr/1", "http://b.org/en/1", "http://c.org/"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: r.verdict for r in queries.op2_url_filter(spark, str(tmp_path)).collect()}
    assert found == {0: "block", 1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


# ---- codes ----------------------------------------------------------------------------------------------------------


def nearest(rows, queries, k):
    out = []
    for q, code in set(queries):
        best = sorted(((bin(code ^ c).count("1"), i) for i, c in set(rows)))[:k]
        out += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("noise, block", [(2, 1 << 20), (20, 100), (64, 100)])
def test_codes_equal_brute_force(spark, monkeypatch, noise, block):
    monkeypatch.setattr(code_search, "INDEX_BLOCK", block)
    monkeypatch.setattr(code_search, "QUERIES_A_TASK", 8)
    rng = random.Random(noise)
    centres = [rng.getrandbits(63) for _ in range(5)]
    rows = [(i, rng.choice(centres) ^ sum(1 << rng.randrange(63) for _ in range(rng.randrange(noise)))) for i in range(1500)]
    rows = [(i, c & (2**63 - 1)) for i, c in rows] + [(5000 + i, centres[0]) for i in range(700)] + [(7, rows[7][1])]
    index = spark.createDataFrame(rows + [(None, 5), (9999, None)], "id long, code long")
    queries = index.where("id % 20 = 0")
    found = sorted(map(tuple, code_search.nearest_codes(index, queries, 10).collect()))
    assert found == nearest(rows, [r for r in rows if r[0] % 20 == 0], 10)


def test_probing_stops_only_when_covered():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, 40000, dtype=np.uint64)
    codes[:50] = codes[0] ^ (np.uint64(1) << rng.integers(0, 63, 50).astype(np.uint64))
    index = code_search.SegmentIndex(codes, np.arange(40000))
    ids, distance = index.nearest(codes[3], 10)
    want = np.lexsort((np.arange(40000), np.bitwise_count(codes ^ codes[3])))[:10]
    assert ids.tolist() == want.tolist() and max(distance) <= 2
    assert index.rings and max(radius for _, radius in index.rings) < 3  # found by probes, not by a scan


def test_every_query_stops_when_its_neighbours_are_covered(monkeypatch):
    rng = np.random.default_rng(8)
    for count in (1, 9, 500, 3000, 1 << 17):
        codes = rng.integers(0, 1 << 64, count, dtype=np.uint64)
        index, radii = code_search.SegmentIndex(codes, np.arange(count)), []
        inner = code_search.SegmentIndex._probe
        monkeypatch.setattr(index, "_probe", lambda code, radius: radii.append(radius) or inner(index, code, radius))
        for query in (codes[0], codes[-1], np.uint64(0), np.uint64(2**64 - 1)):
            radii.clear()
            ids, distance = index.nearest(query, 10)
            every = np.bitwise_count(codes ^ query)
            assert ids.tolist() == np.lexsort((np.arange(count), every))[:10].tolist()
            if count >= 10:  # one ring less would not have covered the tenth distance
                assert len(index.segments) * radii[-1] - 1 < distance[-1] <= len(index.segments) * (radii[-1] + 1) - 1
        if count > 10000:
            assert index.verified < 0.5 * count * index.queries  # even of random codes most are never looked at


def test_index_blocks():
    assert code_search.block_numbers(0, 0, 200) == (1, 1)
    assert code_search.block_numbers(2000, 100, 8) == (1, 1)
    for rows, codes, tasks in ((10**6, 5 * 10**4, 200), (10**9, 5 * 10**7, 2000), (10**7, 10**7, 200)):
        a, b = code_search.block_numbers(rows, codes, tasks)
        assert rows / a <= code_search.INDEX_BLOCK and codes / b <= code_search.QUERY_BLOCK
        assert a * b <= max(2 * tasks, -(-rows // code_search.INDEX_BLOCK) * -(-codes // code_search.QUERY_BLOCK))


def test_vector_cases(spark):
    rows = [(0, [1.0, -1.0] * 32), (20, None), (None, [1.0] * 64), (21, [1.0, None] * 32), (22, []), (40, [0.5] * 70)]
    vectors = spark.createDataFrame([r + (1, 2) for r in rows], "vec_id long, embedding array<float>, id long, code long")
    found = code_search.nearest_by_sign(vectors, k=3).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 0, 0), (0, 2, 21, 0), (0, 3, 22, 32), (40, 1, 40, 0), (40, 2, 0, 32), (40, 3, 21, 32)]
    assert code_search.nearest_by_sign(vectors.limit(0)).collect() == []


# ---- pipeline -------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, sf_dir), name)
        kept[name] = docs.toPandas()
        assert list(docs.columns) == ["doc_id", "text", "lang", "source", "n_chars"]
    letters = kept["language_id"]
    assert letters.text.map(lambda t: any(map(str.isalpha, t))).all() and len(letters) >= 0.99 * spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    normal = letters.text.map(lambda t: re.sub(r"[\x20\x09-\x0D]", "", t))
    assert len(kept["exact_dedup"]) == normal.nunique()
    exact = dict(zip(kept["exact_dedup"].doc_id, kept["exact_dedup"].text))
    want = components(exact)
    assert sorted(kept["near_dedup"].doc_id) == sorted(k for k, c in want.items() if k == c)
    size = lambda frame: frame.text.map(lambda t: len(WORD.findall(t))).sum()
    assert abs(size(kept["mixing"]) - size(kept["near_dedup"])) <= 20
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).toPandas()
    assert pieces.length.sum() == sum(len(reference_ids(t)) // 4 for t in kept["mixing"].text)


def test_pipeline_of_an_empty_table(spark):
    docs = documents(spark, [(1, "a")], extra=False).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []


def test_pipeline_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, ""), name)
        assert docs.columns == columns
    assert docs.count() > 10
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 10
