"""Fill-in-the-middle forms, token alignment and byte-level encoding against plain versions."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from curbline.llm import byte_bpe, fill_in_middle, token_alignment
from tests.llm.helpers import SCHEMA, awkward, documents

ODD = [
    "", " ", "\n\n", "a", "ä", "💥", "áb", "日本語テキスト" * 40, "x" * 9000, "ab" * 6000, "0123456789" * 900, "\x00\x01 nul",
    "▁ taken ▁ as space", "<|endoftext|> <s> </s> <unk> <0x41>", "don't we'll I'd", "tab\t\ttab \r\n  end  ", "　wide spaces\xa0",
    "ﬁ ﬀ ①", "!!!???***" * 300, "a<P>b", "x<S", "<M>", "<" * 50, "e‍🏽" * 700,
]


def noise(seed, count=150):
    rng = random.Random(seed)
    letters = ["ab c<PSM>", "é日💥x \n", "0123456789abcdef", "the of and ing ed ", "▁ ab", "\t\n  xyz'sé"]
    return ["".join(rng.choices(rng.choice(letters), k=rng.randint(1, 400))) for _ in range(count)]


def cases():
    rows = [r[:2] for r in awkward()]
    rows += [(1000 + i, t) for i, t in enumerate(ODD + noise(5))]
    return rows + [(1000, "again"), (1001, "again")]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def same(frame, expected, columns):
    found = Counter(tuple(row[c] for c in columns) for row in frame.collect())
    assert found == Counter(expected)


# fill in the middle


def rearranged(doc_id, text):
    text, digest = text or "", sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        form, output = "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    else:
        form, output = "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    return doc_id, n, form, a, b - a, sha(output), sha(text)


def test_fill_in_middle(spark):
    rows = cases() + [(5000 + i, "é" * 30000 + "x" * i) for i in range(4)]
    frame = fill_in_middle.fill_in_middle_digest(documents(spark, rows))
    expected = [rearranged(*r) for r in rows]
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    same(frame, expected, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])


def test_sentinels_half_cut_are_restored(spark):
    rows = [(i, "<S<P<M>"[i % 5 :] + "><" * (i % 7)) for i in range(300)]
    frame = fill_in_middle.fill_in_middle_digest(documents(spark, rows, extra=False))
    assert {(r.doc_id, r.restored_sha256) for r in frame.collect()} == {(i, sha(t)) for i, t in rows}


def test_chunks_follow_content():
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh é", k=6000)).encode()
    first, second = passage, b"some words before " + passage
    data = np.frombuffer(first + second, np.uint8)
    ends = fill_in_middle.chunk_ends(data, np.array([len(first), len(first) + len(second)]))
    mine = {first[a:b] for a, b in zip([0, *ends], ends) if b <= len(first)}
    moved = ends[ends > len(first)] - len(first)
    theirs = {second[a:b] for a, b in zip([0, *moved], moved)}
    assert len(mine) > 10 and len(mine - theirs) <= 2  # all but those at the head
    assert max(np.diff(ends, prepend=0)) <= fill_in_middle.LONGEST
    counts = fill_in_middle.ChunkCounts()
    texts = fill_in_middle.CutTexts(first + second, np.array([len(first), len(first) + len(second)]), counts)
    assert counts.shared >= len(mine) - 2 and texts.length(1) == len(second.decode())
    for k in range(0, texts.length(1), 97):
        assert second[: texts.place(1, k) - len(first)].decode() == second.decode()[:k]


def test_forgotten_chunks_change_nothing():
    data = "".join(noise(9)).encode()
    documents_ = np.array([len(data) // 2, len(data)])
    while data[documents_[0]] & 0xC0 == 0x80:
        documents_[0] += 1
    small, large = (fill_in_middle.CutTexts(data, documents_, fill_in_middle.ChunkCounts(n)) for n in (500, 1 << 26))
    assert [small.place(1, k) for k in range(200)] == [large.place(1, k) for k in range(200)]


# byte-level encoding


@pytest.fixture(scope="module")
def plain_encoding():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, plain_encoding):
    rows, expected = cases(), []
    for doc_id, text in rows:
        ids = plain_encoding.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text or "")))
    frame = byte_bpe.byte_bpe_digest(documents(spark, rows))
    same(frame, expected, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def test_every_token_and_random_bytes(plain_encoding):
    bpe = byte_bpe.byte_bpe()
    ids = np.arange(plain_encoding.n_vocab if plain_encoding.n_vocab < 50257 else 50256, dtype="<u4")
    assert bpe.decode(ids.tobytes()) == b"".join(plain_encoding.decode_single_token_bytes(int(i)) for i in ids)
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x250), rng.randrange(0x3000, 0xD800), rng.randrange(0x1F300, 0x1FA00)])) for _ in range(80))
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == plain_encoding.encode_ordinary(text)


def test_other_vocabulary_long_text_and_forgetting(monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(byte_bpe, "PART", 1000)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 500)
    text = " ".join(noise(11)) + "".join(ODD)
    bpe = byte_bpe.ByteBpe(path, None)
    ids = bpe.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text)
    assert bpe.decode(ids).decode() == text


# alignment


def aligned(texts):
    """n_a, n_b, groups as lists of (A ids, B ids) by the libraries themselves."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    out = []
    for text in texts:
        groups, a, b = [], [], []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            bytes_a = [ranks[i] for i in a]
            bytes_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                a = b = []
        if a:
            ends_a, ends_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
            i = j = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                i2, j2 = ends_a.index(end) + 1, ends_b.index(end) + 1
                groups.append((a[i:i2], b[j:j2]))
                i, j = i2, j2
        out.append((len(a), len(b), groups))
    return out


def expected_alignment(rows):
    found = aligned([t for _, t in rows])
    held, highest = Counter(), defaultdict(int)
    for _, _, groups in found:
        held.update({(x, y) for a, b in groups for x in a for y in b})
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    for (doc_id, _), (n_a, n_b, groups) in zip(rows, found):
        links = [(x, y) for a, b in groups for x in a for y in b]
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (
            doc_id, n_a, n_b, len(groups), len(links), sum(held[p] == highest[p[0]] for p in links),
            sum(held[p] for p in links), sha(written) if groups else "",
        )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("most", [1, 50, 1 << 18])
def test_alignment(spark, most, monkeypatch):
    monkeypatch.setattr(token_alignment, "CROWDED", 6)
    rows = [r for r in cases() if r[1] is None or len(r[1]) < 10000]
    frame = token_alignment.alignment_digest(documents(spark, rows), most=most)
    expected = list(expected_alignment(rows))
    assert any(e[1] == 0 and r[1] for e, r in zip(expected, rows))  # some texts are not spelt by B
    same(frame, expected, COLUMNS)


def test_groups_of_the_general_interface(spark):
    rows = [(i, t) for i, t in enumerate(noise(4, 30))]
    found = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in token_alignment.aligned_groups(documents(spark, rows)).collect()}
    assert found == {i: groups for (i, _), (_, _, groups) in zip(rows, aligned([t for _, t in rows]))}


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 10**6])
def test_merge_pieces_do_not_change_groups(piece):
    rng = np.random.default_rng(piece)
    for share in (0.1, 0.5, 0.9, 1.0):
        a, b = (np.unique(np.append(np.flatnonzero(rng.random(400) < share), 400)) for _ in range(2))
        i, j = token_alignment.common_ends(a, b, piece)
        assert a[i - 1].tolist() == b[j - 1].tolist() == sorted(set(a) & set(b))
    # a run of ends that only one side has, longer than many pieces
    a, b = np.array([500]), np.arange(1, 501)
    assert [x.tolist() for x in token_alignment.common_ends(a, b, piece)] == [[1], [500]]


def test_diagonals_divide_the_merge():
    rng = np.random.default_rng(2)
    a, b = np.unique(rng.integers(0, 90, 60)), np.unique(rng.integers(0, 90, 50))
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    at = np.arange(len(merged) + 1)
    assert token_alignment.diagonals(a, b, at).tolist() == [sum(side == 0 for _, side in merged[:d]) for d in at]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for digest in (fill_in_middle.fill_in_middle_digest, byte_bpe.byte_bpe_digest, token_alignment.alignment_digest):
        assert digest(empty).collect() == []
