"""Secrets in texts: patterns, and encoded keys and signed tokens that are confirmed by their structure.

The base kinds (assign, access, hex) are patterns with a length. Candidates of the
other kinds are runs of base64 or hex characters. A candidate is decoded and its
structure followed to its last byte before it is reported: the nested lengths of a
DER private key (PKCS#1, PKCS#8, SEC1, encrypted PKCS#8), the length-prefixed
fields of an OpenSSH key, the JSON header and payload of a signed token. A run that
only looks like a key (a digest, an image, a public key) fails and is left alone.
A task reads its texts in slices of bounded size and nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.llm.common import slices

KINDS = ("assign", "access", "hex", "private_key", "signed_token")
SLICE_ROWS, SLICE_BYTES = 512, 8 << 20
LEAST_KEY = 40  # bytes of the shortest private key here: a SEC1 or PKCS#8 key of 32 bytes has more

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # a run is matched whole, so only its length counts
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:[^-]|-(?!----))*+)-----END \1-----")
BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{56,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{80,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-]|\.[A-Za-z0-9_-])")
DER_HEAD = re.compile("^(?:30|M[A-P])")  # first characters of a SEQUENCE in hex and in base64
SSH_MAGIC = b"openssh-key-v1\0"

INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the items that fill ``data`` exactly, or None where a length doesn't fit."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if n >= 0x80:
            more = n & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            n, at = int.from_bytes(data[at:at + more], "big"), at + more
            if n < 0x80 or n >> 8 * (more - 1) == 0:
                return None  # DER takes the shortest form
        if at + n > len(data):
            return None
        items.append((tag, data[at:at + n]))
        at += n
    return items


def is_der_key(data: bytes) -> bool:
    """Whether ``data`` is one private key: PKCS#1 RSA, SEC1 EC, PKCS#8, plain or encrypted."""
    top = der_items(data)
    if not top or len(top) != 1 or top[0][0] != SEQUENCE:
        return False
    items = der_items(top[0][1]) or []
    tags = [t for t, _ in items]
    if tags[:1] == [INTEGER] and len(items[0][1]) == 1:
        version = items[0][1][0]
        if len(tags) == 9 and set(tags) == {INTEGER} and version == 0:
            n, e, _, p, q = (int.from_bytes(v, "big") for _, v in items[1:6])
            return e > 1 and p * q == n
        if tags[1:2] == [OCTETS] and version == 1:
            return len(items[1][1]) in (28, 32, 48, 66) and all(t in (0xA0, 0xA1) for t in tags[2:])
        if tags[1:3] == [SEQUENCE, OCTETS] and version in (0, 1):
            algorithm = der_items(items[1][1])
            inner = der_items(items[2][1])
            return bool(algorithm and algorithm[0][0] == OID and inner and all(t in (0xA0, 0x81) for t in tags[3:]))
        return False
    if tags == [SEQUENCE, OCTETS]:  # encrypted: the algorithm names a password scheme (1.2.840.113549.1.5 or .12)
        algorithm = der_items(items[0][1])
        scheme = algorithm[0] if algorithm else (0, b"")
        return scheme[0] == OID and scheme[1].startswith((b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c"))
    return False


def is_ssh_key(data: bytes) -> bool:
    """Whether ``data`` is an OpenSSH private key: every length-prefixed field fits and the last ends the data."""
    if not data.startswith(SSH_MAGIC):
        return False

    def field(at: int) -> tuple[bytes, int]:
        (n,) = struct.unpack_from(">I", data, at)
        if at + 4 + n > len(data):
            raise ValueError("field beyond the end")
        return data[at + 4:at + 4 + n], at + 4 + n

    try:
        at = len(SSH_MAGIC)
        for _ in range(3):  # cipher, key derivation, its options
            _, at = field(at)
        (keys,), at = struct.unpack_from(">I", data, at), at + 4
        if not 1 <= keys <= 64:
            return False
        for _ in range(keys + 1):  # public keys, then the private part
            part, at = field(at)
        return at == len(data) and len(part) >= 8
    except (struct.error, ValueError):
        return False


def is_key(data: bytes | None) -> bool:
    return data is not None and len(data) >= LEAST_KEY and (is_der_key(data) or is_ssh_key(data))


def from_base64(run: str) -> bytes | None:
    """Bytes of a base64 run in either alphabet, padded or not; None if it isn't one."""
    plain = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """Whether three parts are a signed token: a header that names its algorithm, a JSON payload, a signature that this algorithm can have."""
    first = from_base64(header)
    try:
        head = json.loads(first) if first and first[:1] == b"{" else None
        if not isinstance(head, dict) or not isinstance(head.get("alg"), str):
            return False
        if head.get("b64", True) and head.get("cty") != "JWT" and not isinstance(json.loads(from_base64(payload) or b""), dict):
            return False
    except (ValueError, RecursionError):
        return False
    mac = from_base64(signature)
    bits = {"256": 32, "384": 48, "512": 64}.get(head["alg"][-3:])
    if head["alg"].startswith("HS"):
        return mac is not None and len(mac) == bits
    return mac is not None and len(mac) >= 32


def _encoded(text: str) -> Iterator[tuple[int, int]]:
    """Spans of private keys: armoured ones with their armour, then bare runs outside them."""
    armoured = []
    if "PRIVATE KEY" in text:
        for m in ARMOUR.finditer(text):
            # Header lines (``Proc-Type: 4,ENCRYPTED``) go before the body; their body is not DER but cipher text.
            lines = [line.strip() for line in re.split(r"\\n|\n", m[2])]
            locked = any(line.startswith("Proc-Type:") and line.endswith("ENCRYPTED") for line in lines)
            data = from_base64("".join(line for line in lines if ":" not in line))
            if data and (is_key(data) or locked and len(data) >= LEAST_KEY and len(data) % 8 == 0):
                armoured.append((m.start(), m.end()))
    yield from armoured
    for pattern, decode in ((BASE64_RUN, from_base64), (HEX_RUN, lambda s: bytes.fromhex(s) if len(s) % 2 == 0 else None)):
        for m in pattern.finditer(text):
            head = m[0][:2]
            if (DER_HEAD.match(head) or m[0].startswith("b3BlbnNzaC1rZXkt") or m[0][:12].lower() == "6f70656e7373") and not any(
                    a < m.end() and m.start() < b for a, b in armoured) and is_key(decode(m[0])):
                yield m.start(), m.end()


def secret_spans(text: str | None) -> list[tuple[int, int, int]]:
    """Sorted (start, kind, end) of all secrets of a text, in code points, end exclusive; ``kind`` numbers ``KINDS``."""
    if not text:
        return []
    found = {(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6}
    found |= {(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20}
    found |= {(m.start(), 2, m.end()) for m in HEX.finditer(text)}
    found |= {(a, 3, b) for a, b in _encoded(text)}
    if "." in text:
        found |= {(m.start(), 4, m.end()) for m in TOKEN.finditer(text) if is_signed_token(*m.groups())}
    return sorted(found)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _counts(n_base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_ROWS, SLICE_BYTES):
            every = [secret_spans(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in spans if s[1] < n_base] for spans in every]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([sum(s[1] == k for s in spans) for spans in every], pa.int64()) for k in range(len(KINDS))],
                 pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([listed(s) for s in every], pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])
    return run


def secret_documents(docs: DataFrame) -> DataFrame:
    """doc_id, number of secrets by kind, base_sha256 of the base kinds' spans, and all spans as text, of every document.

    A span is kind:start:end in code points, ordered by start, then kind. A null
    text is empty: no spans. Repeated rows and null ids keep a row each; other
    columns are not read, whatever their names. An empty table gives none.
    """
    n_base = KINDS.index("hex") + 1
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _counts(n_base), f"doc_id {id_type}, {counts}, base_sha256 string, spans string")


def redacted_text(text: str) -> str:
    """The text with each secret replaced by a mark of its kind; spans that overlap get one mark, that of the first."""
    out, at = [], 0
    for a, k, b in secret_spans(text):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """Documents with secrets replaced by marks; rows and all other columns stay. Null texts stay null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_ROWS, SLICE_BYTES):
            texts = pa.array([t if t is None else redacted_text(t) for t in batch.column("text").to_pylist()], batch.schema.field("text").type)
            yield batch.set_column(batch.schema.get_field_index("text"), "text", texts)

    return docs.mapInArrow(run, docs.schema)


def has_secret(spans: Column) -> Column:
    """Whether the ``spans`` column of ``secret_documents`` has any span."""
    return F.length(spans) > 0
