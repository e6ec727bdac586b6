"""Secret scan with structural confirmation.

Base patterns propose spans; then base64 and hex candidates are decoded and
their structure parsed: DER key encodings by their nested lengths, the framed
fields of an OpenSSH private key, PEM armour (with the header lines of an encrypted
key, too, and once more inside base64), and the header of a signed token. A DER key
may be broken into lines: its own length tells how much of what follows belongs to
it. A structure that holds adds a span of its own kind (``der``, ``pem``, ``jwt``)
and confirms the base spans it overlaps; base spans always stay.

Defined results: null text is the empty text (no spans); every text is scanned
whole; offsets are code points, ends exclusive; repeated rows give repeated
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import field, map_batches, on_workers, slices

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE, LEAST_ACCESS = 12, 18
ASSIGN_HINTS = ("passw", "secret", "token", "api")

BASE_KINDS = ("assign", "access", "hex")
METHOD_KINDS = ("jwt", "pem", "der")
RANK = {kind: i for i, kind in enumerate(BASE_KINDS + METHOD_KINDS)}

#: A JSON object begins with "e" in base64, then "y" or "w" for a quote, a blank or a line break.
JWT = re.compile(r"(?<![A-Za-z0-9_-])e[yw][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----(\s*(?:[A-Za-z0-9-]+:[^\r\n]*\r?\n)*)"
                 r"([A-Za-z0-9+/=\s\\]+)-----END \1-----")
PEM_ENCRYPTED = re.compile(r"Proc-Type:\s*4,ENCRYPTED\s*\n(?:.*\n)*?DEK-Info:\s*[A-Z0-9-]+,((?:[0-9A-Fa-f]{2}){8,16})\s")
#: Base64 of "-----BEGIN ".
PEM_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])LS0tLS1CRUdJTi(?:[A-Za-z0-9+/_-]|\r?\n[ \t]*(?=[A-Za-z0-9+/_-]))+={0,2}")
#: A DER sequence starts with 0x30: "M" in base64, "30" in hex.
DER_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])M[A-Za-z0-9+/_-]{31,}")
DER_HEX = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{46,}(?![0-9A-Fa-f])")
#: Base64 characters, or a line break between them.
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]+|\r?\n[ \t]*(?=[A-Za-z0-9+/_-])")
OPENSSH_MAGIC = b"openssh-key-v1\x00"


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    confirmed: bool


def der_holds(data: bytes, depth: int = 0) -> bool:
    """True if ``data`` is one or more DER elements whose lengths nest exactly:
    every constructed element is filled by its children to the last byte."""
    if depth > 16 or not data:
        return False
    at = 0
    while at < len(data):
        if at + 2 > len(data):
            return False
        tag, size = data[at], data[at + 1]
        at += 2
        if tag == 0 or tag & 0x1F == 0x1F:
            return False
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data) or data[at] == 0:
                return False
            size = int.from_bytes(data[at:at + width], "big")
            at += width
            if size < 0x80:
                return False
        if at + size > len(data):
            return False
        if tag & 0x20 and size and not der_holds(data[at:at + size], depth + 1):
            return False
        at += size
    return True


def is_der_key(data: bytes) -> bool:
    """One outer sequence over all bytes that holds at least two elements, of
    which the first is an integer (a version) or a sequence (an algorithm)."""
    if len(data) < 24 or data[0] != 0x30 or not der_holds(data):
        return False
    head = 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    total = int.from_bytes(data[2:head], "big") if data[1] & 0x80 else data[1]
    return head + total == len(data) and data[head] in (0x02, 0x30)


def is_openssh_key(data: bytes) -> bool:
    """The magic, then three length-framed names and a key count of one or more."""
    if not data.startswith(OPENSSH_MAGIC):
        return False
    at = len(OPENSSH_MAGIC)
    for _ in range(3):
        size = int.from_bytes(data[at:at + 4], "big")
        at += 4 + size
        if at + 4 > len(data):
            return False
    return 1 <= int.from_bytes(data[at:at + 4], "big") <= 64


def decode_base64(text: str) -> bytes | None:
    body = re.sub(r"\s|\\n|\\r|=+$", "", text).replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(text: str) -> bool:
    """The first part decodes to a JSON object that names its algorithm, the
    second to a JSON object."""
    head, body = text.split(".")[:2]
    try:
        header, claims = (json.loads(decode_base64(x) or b"null") for x in (head, body))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict)


def der_size(head: bytes) -> int:
    """Bytes of the DER element that begins so, its head included; 0 if it is none."""
    if len(head) < 6 or head[1] == 0x80 or head[1] > 0x84:
        return 0
    if head[1] < 0x80:
        return 2 + head[1]
    width = head[1] & 0x7F
    return 2 + width + int.from_bytes(head[2:2 + width], "big")


def wrapped_der(text: str, start: int) -> int | None:
    """End of the DER key in base64 that begins at ``start``, which may go on over
    line breaks; None if what its length says is not one."""
    size = der_size(decode_base64(text[start:start + 8]) or b"")
    need, taken, at = -(-size * 4 // 3), [], start
    while need > 0:
        m = WRAPPED.match(text, at)
        if not m:
            return None
        body = m[0].strip()[:need]
        taken.append(body)
        need -= len(body)
        at = m.start() + len(body) if body else m.end()
    data = decode_base64("".join(taken))
    if not data or not is_der_key(data):
        return None
    return at + len(re.compile(r"(?:\r?\n)?={1,2}|").match(text, at)[0])


def is_armoured_key(headers: str, body: str) -> bool:
    """What stands between the lines of a PEM key: a DER or OpenSSH key, or, after
    the header lines of an encrypted one, whole blocks of its cipher."""
    data = decode_base64(body)
    if not data:
        return False
    encrypted = PEM_ENCRYPTED.search(headers)
    return len(data) % (len(encrypted[1]) // 2) == 0 if encrypted else is_der_key(data) or is_openssh_key(data)


def encoded_pem(text: str) -> int | None:
    """Of base64 text: the number of characters up to the end of the PEM key in it."""
    places = [i for i, c in enumerate(text) if not c.isspace()]
    body = "".join(text[i] for i in places).rstrip("=")
    data = decode_base64(body[:len(body) - (len(body) % 4 == 1)])
    m = PEM.match((data or b"").decode("latin-1"))
    if not m or not is_armoured_key(m[2], m[3]):
        return None
    return places[min(len(places), -(-m.end() * 4 // 3)) - 1] + 1


def structures(text: str) -> list[tuple[int, int, str]]:
    """Spans whose content holds as a key or a signed token."""
    out: list[tuple[int, int, str]] = []
    if "ey" in text or "ew" in text:
        out += [(*m.span(), "jwt") for m in JWT.finditer(text) if is_signed_token(m[0])]
    if "PRIVATE KEY-----" in text:
        out += [(*m.span(), "pem") for m in PEM.finditer(text) if is_armoured_key(m[2], m[3])]
    if "LS0tLS1CRUdJTi" in text:
        for m in PEM_BASE64.finditer(text):
            end = encoded_pem(m[0])
            if end:
                out.append((m.start(), m.start() + end, "pem"))
    ends = [(a, b) for a, b, _ in out]
    for pattern, end_of in ((DER_BASE64, lambda m: wrapped_der(text, m.start())),
                            (DER_HEX, lambda m: m.end() if is_der_key(_decode_hex(m[0]) or b"") else None)):
        for m in pattern.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in ends):
                end = end_of(m)
                if end:
                    out.append((m.start(), end, "der"))
                    ends.append((m.start(), end))
    return out


def _decode_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    low = text.lower()
    out = []
    if any(hint in low for hint in ASSIGN_HINTS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return out


def scan(text: str) -> list[Span]:
    """All spans by start, then kind. A base span counts as confirmed when a
    structure overlaps it, or when it is an access id (its form is its proof)."""
    found = structures(text)
    spans = [Span(a, b, kind, kind == "access" or any(x < b and a < y for x, y, _ in found))
             for a, b, kind in base_spans(text)]
    spans += [Span(a, b, kind, True) for a, b, kind in found]
    return sorted(spans, key=lambda s: (s.start, RANK[s.kind], s.end))


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with every maximal stretch covered by spans replaced by a mark."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i].start, spans[i].end, spans[i].kind
        while i + 1 < len(spans) and spans[i + 1].start < end:
            i += 1
            end = max(end, spans[i].end)
        out += [text[at:start], f"<secret:{kind}>"]
        at, i = end, i + 1
    return "".join(out) + text[at:]


SPAN_DDL = "array<struct<start:int,end:int,kind:string,confirmed:boolean>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id`` and ``spans``. A map over rows, no shuffle."""
    ddl = f"id {field(docs, id_col)}, spans {SPAN_DDL}"

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            return {"id": batch["id"], "spans": [[s._asdict() for s in scan(t or "")]
                                                 for t in batch["text"].to_pylist()]}
        return step

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, make, ddl)


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with their secrets masked; null text stays null, all other
    columns and all rows stay as they are."""
    on_workers(docs.sparkSession)
    types = docs.schema

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            at = batch.schema.get_field_index(text_col)
            texts = [t if t is None or not (s := scan(t)) else mask(t, s)
                     for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, types)


def joined(kinds: tuple[str, ...] | None = None):
    """Spans as ``kind:start:end``, comma-joined, of the given kinds or all."""
    spans = F.col("spans")
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(BASE_KINDS), 256).alias("base_sha256"), joined().alias("spans"),
        F.size(F.filter("spans", lambda s: s["confirmed"])).cast("bigint").alias("n_confirmed"))
