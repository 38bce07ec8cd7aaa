"""Secrets in texts: pattern matches, and candidates that their structure confirms.

The base patterns are reported as they match. Further candidates (long base64 or hex runs, dotted tokens,
armoured blocks) are decoded and only reported when the bytes parse: a private key in DER whose nested
lengths add up exactly, an OpenSSH key container whose length-prefixed fields fit, or a signed token with a
JSON header naming its algorithm and a JSON payload.

Defined cases: a null text counts as empty and has no spans. Texts are read whole, whatever their length. One
row per input row, repeated rows and null identifiers included. An empty table gives an empty result. Only
the identifier and the text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "token", "key", "block")
SPANS = "array<struct<kind:string,start:int,end:int>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# a run of the class is always matched whole, so the least length can stand in the pattern
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
# Looked for at each start of a run, also behind a dotted word: both objects begin with an opening brace, so with e.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?=((e[A-Za-z0-9_-]+)\.(e[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+))")
# line ends may be written out, as in JSON; a few header lines may come first
_BLOCK = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----(?:\s|\\[nr])*+((?:[A-Za-z0-9-]++: [^\n\\]*+(?:\\[nr]|\n)(?:\s|\\[nr])*+){0,4}+)"
    r"((?:[A-Za-z0-9+/=\s]|\\[nr])++)-----END \1PRIVATE KEY-----"
)
_LINE_END = re.compile(r"\\[nr]|\s+")
_INNER_START = re.compile(r"(?<=[+/_-])(?=M|b3Bl)")
_HEX_RUN = re.compile(r"[0-9A-Fa-f]+")


def _decoded(run: str) -> bytes | None:
    """Base64 of either alphabet, padded or not; None when it is neither."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The DER items that fill ``data`` exactly, as (tag, content); None when lengths do not add up."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            wide = size & 0x7F
            if not 1 <= wide <= 4 or at + wide > len(data):
                return None
            size, at = int.from_bytes(data[at : at + wide], "big"), at + wide
            if size < 0x80:
                return None  # DER asks for the shortest form
        if at + size > len(data):
            return None
        found.append((tag, data[at : at + size]))
        at += size
    return found


INTEGER, BITS, OCTETS, OBJECT, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


#: How the identifiers of the password-based encryption schemes begin.
_ENCRYPTION = bytes.fromhex("2a864886f70d01")


def _is_der_private_key(data: bytes) -> bool:
    outer = _items(data) if data[:1] == bytes([SEQUENCE]) else None
    if not outer or len(outer) != 1 or not (parts := _items(outer[0][1])):
        return False
    tags, version = [tag for tag, _ in parts], parts[0][1]
    if tags == [SEQUENCE, OCTETS]:  # an encrypted key with its scheme
        scheme = _items(parts[0][1])
        return bool(scheme) and scheme[0][0] == OBJECT and scheme[0][1][:8] in (
            _ENCRYPTION + b"\x05", _ENCRYPTION + b"\x0c") and len(parts[1][1]) >= 16
    if tags[0] != INTEGER or version not in (b"\0", b"\1"):
        return False
    if tags[1:3] == [SEQUENCE, OCTETS]:  # algorithm and wrapped key
        algorithm = _items(parts[1][1])
        return bool(algorithm) and algorithm[0][0] == OBJECT and len(parts[2][1]) >= 16
    if tags[1:2] == [OCTETS] and version == b"\1":  # elliptic curve
        return len(parts[1][1]) >= 16
    return len(parts) >= 6 and set(tags) == {INTEGER} and max(len(v) for _, v in parts) >= 16


def _is_ssh_container(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for step in range(5):  # cipher, derivation, its options; number of keys; public key
        if at + 4 > len(data):
            return False
        size, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if step == 3:
            if not 1 <= size <= 16:
                return False
        elif (at := at + size) > len(data):
            return False
    return at + 4 <= len(data) and at + 4 + int.from_bytes(data[at : at + 4], "big") <= len(data)


def _is_key(data: bytes | None) -> bool:
    return data is not None and (_is_der_private_key(data) or _is_ssh_container(data))


def _may_be_key(run: str, at: int) -> bool:
    """Whether the length at the head of a DER sequence is that of the rest of the run; always for other containers."""
    head = _decoded(run[at : at + 8])
    if not head or head[0] != SEQUENCE:
        return run.startswith("b3Bl", at)
    wide = head[1] & 0x7F if head[1] & 0x80 else 0
    if wide > 4:
        return False
    size = int.from_bytes(head[2 : 2 + wide], "big") if wide else head[1]
    return 2 + wide + size == (len(run.rstrip("=")) - at) * 3 // 4


def _key_start(run: str, after_escape: bool) -> int | None:
    """Where in a base64 run a key begins that reaches to the run's end: at its start, or behind a sign that may
    as well be a path's or a name's."""
    starts = [0] if run[0] in "Mb" else []
    if after_escape and run[0] in "nr":
        starts.append(1)
    for at in [*starts, *(m.start() for m in _INNER_START.finditer(run))]:
        if _may_be_key(run, at) and _is_key(_decoded(run[at:])):
            return at
    return None


def _is_block(headers: str, body: str) -> bool:
    """An armoured key: its bytes parse, or its headers say that they are encrypted in whole cipher blocks."""
    data = _decoded(_LINE_END.sub("", body))
    if "ENCRYPTED" in headers:
        return bool(data) and len(data) >= 16 and len(data) % 8 == 0
    return _is_key(data)


def _is_object(part: str, *names: str) -> bool:
    data = _decoded(part)
    if data is None or data.lstrip()[:1] != b"{":
        return False
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and all(isinstance(value.get(n), str) for n in names)


def secret_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as in ``KINDS``."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    for m in _RUN.finditer(text):
        run, start = m[0], m.start()
        digits = run[2:] if run[:2] in ("0x", "0X") else run
        if _HEX_RUN.fullmatch(digits) and len(digits) % 2 == 0 and _is_key(bytes.fromhex(digits)):
            found.append(("key", *m.span()))
        elif (at := _key_start(run, text[start - 1 : start] == "\\")) is not None:
            found.append(("key", start + at, m.end()))
    if ".e" in text:
        for m in _TOKEN.finditer(text):
            if _is_object(m[2], "alg") and _is_object(m[3]):
                found.append(("token", *m.span(1)))
    if "-----BEGIN " in text:
        found += [("block", *m.span()) for m in _BLOCK.finditer(text) if _is_block(m[2], m[3])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in secret_spans(text or "")]
                for text in part.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(spans, _ARROW_SPANS)], ["id", "spans"]
            )


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the identifier column and ``spans``, an array of (kind, start, end)."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_scan, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_column)


def span_digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the array's order."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def secret_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Identifier, n_assign, n_access, n_hex, base_sha256, spans (as text)."""
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return find_secrets(docs, id_column, text_column).select(
        id_column,
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(span_digest(of(*BASE_KINDS)), 256).alias("base_sha256"),
        span_digest(F.col("spans")).alias("spans"),
    )
