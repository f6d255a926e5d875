"""Secret scans with structural confirmation.

Base rules find assignments, access ids and hex runs by their form alone. On top of them, candidates
in base64, base64url or hex are decoded, and reported only if what they hold parses: a signed token's
header is a JSON object with an algorithm, key encodings are nested lengths that fit one another to
the last byte (ASN.1 DER of private and public keys, the length-prefixed fields of an SSH key).
Spans are code points, end exclusive, and carry the kind. Each text is read whole.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusweave.llm.common import by_step, texts

# The base rules, in order
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # a run of 24 and more is the whole of a run: the same spans as all runs, cut by length
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
# Structural kinds, in order after the base ones
STRUCTURAL = ["signed_token", "pem", "ssh_key", "der_key"]
KINDS = [*BASE, *STRUCTURAL]

TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----([A-Za-z0-9+/=\s\\]+)-----END \1-----")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}(?![0-9A-Fa-f])")
# DER object ids of RSA, elliptic-curve, Ed25519, X25519 and DSA keys
KEY_OIDS = {bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce3d0201", "2b6570", "2b656e", "2a8648ce380401")}
SSH_MAGIC = b"openssh-key-v1\x00"


def decoded(text: str) -> bytes | None:
    """Bytes of a base64 or base64url run, with or without padding; None if it is neither."""
    body = text.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) items that fill `data` to its end, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def der_key(data: bytes) -> bool:
    """Whether `data` is one DER sequence laid out as a key: PKCS#1, SEC 1, PKCS#8 or a subject public key."""
    top = der_items(data)
    if not top or len(top) != 1 or top[0][0] != 0x30 or not (items := der_items(top[0][1])):
        return False
    tags = [t for t, _ in items]
    if tags[0] == 0x02 and len(tags) >= 6 and set(tags) == {0x02}:  # version or numbers of RSA and DSA keys
        return all(x for _, x in items)
    if tags[:2] == [0x02, 0x04] and items[0][1] == b"\x01" and len(items[1][1]) >= 16:  # SEC 1
        return True
    algorithm = items[1] if tags[:2] == [0x02, 0x30] else items[0]
    if algorithm[0] != 0x30 or not (inner := der_items(algorithm[1])) or inner[0][0] != 0x06:
        return False
    rest = tags[2:] if algorithm is items[1] and len(items) > 1 else tags[1:]
    return inner[0][1] in KEY_OIDS and bool(rest) and rest[0] in (0x03, 0x04)


def ssh_key(data: bytes) -> bool:
    """Whether `data` is an SSH key: length-prefixed fields, the first one a key or cipher name."""
    private = data.startswith(SSH_MAGIC)
    at, fields = len(SSH_MAGIC) if private else 0, []
    while at + 4 <= len(data) and len(fields) < 3:
        size = int.from_bytes(data[at : at + 4], "big")
        if size > len(data) - at - 4:
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    if len(fields) < 2 or not re.fullmatch(rb"[a-z0-9@.-]{3,64}", fields[0]):
        return False
    return private or fields[0].startswith((b"ssh-", b"ecdsa-sha2-", b"sk-"))


def token_header(text: str) -> bool:
    """Whether `text` is the header of a signed token: base64url of a JSON object that names its algorithm."""
    raw = decoded(text)
    if raw is None or not raw.startswith(b"{"):
        return False
    try:
        head = json.loads(raw)
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, (rule, group, least) in BASE.items():
        out += [(kind, *m.span()) for m in rule.finditer(text) if m.end(group) - m.start(group) >= least]
    return out


def structural_spans(text: str) -> list[tuple[str, int, int]]:
    """Candidates whose decoded content parses as a key or signed token."""
    out = [("signed_token", *m.span()) for m in TOKEN.finditer(text) if token_header(m[1])] if "ey" in text else []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            data = decoded(re.sub(r"\\[nr]|\s", "", m[2]))
            if data is not None and (der_key(data) or ssh_key(data)):
                out.append(("pem", *m.span()))
    for rule, read in ((BASE64, decoded), (HEX, lambda x: bytes.fromhex(x) if len(x) % 2 == 0 else None)):
        for m in rule.finditer(text):
            data = read(m[0])
            if data is None or any(s <= m.start() and m.end() <= e for _, s, e in out):
                continue
            if ssh_key(data):
                out.append(("ssh_key", *m.span()))
            elif data[:1] == b"\x30" and der_key(data):
                out.append(("der_key", *m.span()))
    return out


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in ordered(spans))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans count as one, of the first kind."""
    out, at, end = [], 0, 0
    for kind, start, stop in ordered(spans):
        if start >= end:
            out += [text[at:start], f"[{kind}]"]
        end = at = max(end, stop)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, base and all spans, for every row of `docs` (doc_id, text).

    Null and empty texts have no spans: counts 0 and empty strings. Rows that repeat a doc_id each give a row.
    """

    def run(batch):
        out = []
        for raw in batch.column("text").to_pylist():
            text = raw.decode()
            base = base_spans(text)
            kinds = [k for k, _, _ in base]
            out.append([kinds.count(k) for k in BASE] + [joined(base), joined(base + structural_spans(text))])
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"],
        )

    return by_step(texts(docs), run, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string")


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with all found spans replaced by their kind and n_chars made to fit; no row is dropped.

    Null texts stay null, texts without secrets and all other columns stay as they are.
    """
    schema = docs.schema
    counted = "n_chars" in schema.names

    def run(batches):
        for batch in batches:
            found = [t if t is None else redacted(t, base_spans(t) + structural_spans(t)) for t in batch.column("text").to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"text": pa.array(found, pa.string())}
            if counted:
                counts = batch.column("n_chars").to_pylist()
                old = batch.column("text").to_pylist()
                kind = batch.schema.field("n_chars").type
                columns["n_chars"] = pa.array([n if a == b else len(b) for n, a, b in zip(counts, old, found, strict=True)], kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, schema)

