"""Personal data and secrets against the plain patterns, and the confirmed candidates."""

import base64
import hashlib
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from curbline.llm import personal_data, secret_scan
from tests.llm.helpers import awkward, documents


def digest(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def personal(text):
    text, out = text or "", []
    number = lambda m: re.sub("[^0-9]", "", m[0])
    for kind, pattern, good in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(number(m)) <= 19 and luhn(number(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(number(m)) <= 15),
    ):
        out += [(kind, *m.span()) for m in re.finditer(pattern, text) if good(m)]
    return sorted(out, key=lambda s: (s[1], personal_data.BASE_KINDS.index(s[0])))


def secrets(text):
    text, out = text or "", []
    named = r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [("assign", *m.span()) for m in re.finditer(named, text) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], secret_scan.BASE_KINDS.index(s[0])))


def noise(seed):
    rng = random.Random(seed)
    letters = ["ab.@_%+- 0123456789().é\n💥", "0123456789 -.+", "0123456789abcdefAKI=: '\"", "a@b.c+1 (2)-3"]
    words = ["password", "TOKEN=", "api_key: ", "AKIA", "secret", "deadbeef" * 3, "4111 1111 1111 1111", "1.2.3.4.5.6.7.8.9"]
    texts = ["".join(rng.choices(rng.choice(letters), k=rng.randint(1, 120))) for _ in range(300)]
    return texts + ["".join(rng.choice(words + list("= :'x9")) for _ in range(12)) for _ in range(300)]


LONG = ["x" * 20000 + "@y.z" + ".z" * 5000, "1" * 30000, "+1" + "(2) " * 4000, "a1" * 20000, "token=" * 5000]


@pytest.mark.parametrize("rows", [
    awkward(), list(enumerate(noise(1))), list(enumerate(noise(2))), list(enumerate(LONG)),
    [(1, "0255.1.1.1 256.1.1.1 a@b.co_x@y.zz"), (1, "0255.1.1.1 256.1.1.1 a@b.co_x@y.zz"), (2, "ſecret=abcdefghijklmn")],
])
def test_base_spans(spark, rows):
    docs = documents(spark, [r[:2] for r in rows])
    for frame, base, kinds in (
        (personal_data.personal_data_digest(docs), personal, personal_data.BASE_KINDS),
        (secret_scan.secret_digest(docs), secrets, secret_scan.BASE_KINDS),
    ):
        columns = ["doc_id", *[f"n_{k}" for k in kinds], "base_sha256"]
        want = []
        for doc_id, text, *_ in rows:
            spans = base(text)
            counts = [sum(s[0] == k for s in spans) for k in kinds]
            want.append((doc_id, *counts, hashlib.sha256(digest(spans).encode()).hexdigest()))
        found = frame.collect()
        assert sorted((tuple(r[c] for c in columns) for r in found), key=repr) == sorted(want, key=repr)
        texts = {digest(base(r[1])) for r in rows}
        for r in found:  # base spans stay among all spans
            kept = [s for s in r["spans"].split(",") if s.split(":")[0] in kinds]
            assert ",".join(kept) in texts


def test_candidates_of_personal_data(spark):
    real = ["Call me at (415) 555-1234 now", "my ssn 123-45-6789, mail a@b.com", "joe (at) ex (dot) com", "Dr. Jane Smith, tel 212-555-7788"]
    found = [r.spans for r in personal_data.personal_data_digest(documents(spark, list(enumerate(real)))).orderBy("doc_id").collect()]
    assert found == [
        "local_phone:11:25", "identity:7:18,email:25:32", "masked_email:0:21", "name:0:14,local_phone:20:32"]


def test_a_text_with_very_many_spans(spark):
    lines = [f"call 212-555-{i % 10000:04d} or a{i}@b.de" if i % 2 else f"10.0.{i % 256}.7 é 📞 (415) 555-{i % 10000:04d}" for i in range(25000)]
    text = "\n".join(lines)
    start = time.time()
    row = personal_data.personal_data_digest(documents(spark, [(1, text), (2, lines[1])], extra=False)).where("doc_id = 1").first()
    assert time.time() - start < 60
    spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in row.spans.split(","))]
    assert len(spans) >= 50000 - 1 and spans == sorted(spans, key=lambda s: (s[1], personal_data.KINDS.index(s[0])))
    assert row.base_sha256 == hashlib.sha256(digest(personal(text)).encode()).hexdigest()
    phones = [text[a:b] for k, a, b in spans if k == "local_phone"]
    assert len(phones) == 25000 and all(re.fullmatch(r"[(]?\d{3}[)]?[ -]\d{3}-\d{4}", p) for p in phones)


def test_contexts_come_from_blocks(spark, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choices("ab é💥\n", k=900))
    places = [(0, 5), (3, 3), (39, 41), (511, 512), (512, 530), (513, 600), (551, 552), (899, 900), (900, 900)]
    df = spark.createDataFrame([(text, a, b) for a, b in places], "text string, a int, b int").withColumn(
        "blocks", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{personal_data.BLOCK}}}"), F.lit(0)))
    found = df.select("a", "b", personal_data._context(F.col("blocks"), F.col("a"), F.col("b")).alias("c")).collect()
    assert [(r.c.before, r.c.after) for r in found] == [(text[max(0, r.a - 40) : r.a], text[r.b : r.b + 1]) for r in found]


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng, patterns = random.Random(4), {}
    for _ in range(4000):
        real = rng.random() < 0.4
        votes = tuple(int(rng.random() < (good if real else 1 - good)) for good in (0.95, 0.9, 0.55)) + (None,)
        patterns[votes] = patterns.get(votes, 0) + 1
    share, rates, posterior = personal_data.reliabilities(patterns)
    assert abs(share - 0.4) < 0.05
    assert rates[0][0] > 0.9 and rates[1][0] > 0.85 and abs(rates[2][0] - 0.55) < 0.1
    assert posterior[1, 1, 0, None] > 0.9 > 0.1 > posterior[0, 0, 1, None]


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


KEY = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01")), der(4, bytes(range(200))))
CURVE = der(0x30, der(2, b"\1"), der(4, bytes(range(32))))
SSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + b"\0\0\0\1" + b"".join(
    len(x).to_bytes(4, "big") + x for x in (b"public", b"private"))


def token(header, payload):
    return ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=").decode() for x in (header, payload)) + ".c2ln"


@pytest.mark.parametrize("secret, kind", [
    (base64.b64encode(KEY).decode(), "key"), (CURVE.hex().upper(), "key"), (base64.b64encode(SSH).decode(), "key"),
    (token({"alg": "HS256"}, {"sub": 1}), "token"),
    ("-----BEGIN PRIVATE KEY-----\n" + base64.encodebytes(KEY).decode() + "-----END PRIVATE KEY-----", "block"),
    (base64.b64encode(KEY[:-1]).decode(), None), (base64.b64encode(KEY + b"\0").decode(), None),
    (base64.b64encode(bytes(range(100))).decode(), None), (token({"typ": "x"}, {"sub": 1}), None), (token({"alg": "x"}, [1]), None),
])
def test_structure_decides(secret, kind):
    text = f"before {secret} after"
    found = [s for s in secret_scan.secret_spans(text) if s[0] not in secret_scan.BASE_KINDS]
    if kind is None:
        assert found == []
    else:
        # an armoured block may hold its key on a line of its own
        assert (kind, 7, 7 + len(secret)) in found


PBES = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30, der(5))), der(4, bytes(64)))
DIGEST = der(0x30, der(0x30, der(6, bytes.fromhex("608648016503040201")), der(5)), der(4, bytes(32)))


def armour(name, body, headers="", end="\n"):
    lines = base64.encodebytes(body).decode().strip().replace("\n", end)
    return f"-----BEGIN {name}PRIVATE KEY-----{end}{headers}{lines}{end}-----END {name}PRIVATE KEY-----"


@pytest.mark.parametrize("text, kind, secret", [
    (json.dumps({"private_key": armour("", KEY)}), "block", armour("", KEY, end="\\n")),
    ("a " + armour("ENCRYPTED ", PBES) + " z", "block", armour("ENCRYPTED ", PBES)),
    ("a " + armour("RSA ", bytes(64), "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n"), "block",
     armour("RSA ", bytes(64), "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n")),
    ("key 0x" + KEY.hex() + " end", "key", "0x" + KEY.hex()),
    ("path/to/" + base64.b64encode(KEY).decode(), "key", base64.b64encode(KEY).decode()),
    ("my-key_" + base64.b64encode(SSH).decode(), "key", base64.b64encode(SSH).decode()),
    ('"x\\n' + base64.b64encode(CURVE).decode() + '"', "key", base64.b64encode(CURVE).decode()),
    ("the.example." + token({"alg": "HS256"}, {"sub": 1}), "token", token({"alg": "HS256"}, {"sub": 1})),
    (base64.b64encode(DIGEST).decode(), None, None),
    (armour("RSA ", bytes(61), "Proc-Type: 4,ENCRYPTED\n\n"), None, None),
    (armour("ENCRYPTED ", DIGEST), None, None),
])
def test_usual_forms_of_keys(text, kind, secret):
    found = [(k, text[a:b]) for k, a, b in secret_scan.secret_spans(text) if k not in secret_scan.BASE_KINDS]
    assert (kind, secret) in found if kind else found == []


def test_long_runs_take_linear_time():
    head = "-----BEGIN PRIVATE KEY-----"
    long = [
        ".e" + "x" * 10**6, "e" * 10**6 + ".e", ".e" * 300000, head + " " * 10**6, (head + "\nA: b\n") * 30000, "/M" * 400000,
        "/MIIE" * 200000, "A1" * 500000, head + "\\n" * 400000,
    ]
    start = time.process_time()
    for text in long:
        secret_scan.secret_spans(text)
    assert time.process_time() - start < 20


def test_empty_tables(spark):
    none = documents(spark, [(1, "a")]).limit(0)
    assert personal_data.personal_data_digest(none).collect() == []
    assert secret_scan.secret_digest(none).collect() == []
