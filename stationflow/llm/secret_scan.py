"""Secrets in texts: base patterns, and candidates confirmed by their decoded structure."""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import ids_and_text, of_texts, per_row

#: Base kinds in the order of ties: pattern, group whose length counts, least length.
BASE = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),  # runs are whole, so the least length may stand in the pattern
}
#: Kinds that only a decoded structure confirms.
CONFIRMED = ("pem", "jwt", "ssh", "der")
KINDS = (*BASE, *CONFIRMED)
PEM_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}KEY)-----")
PEM_BODY = re.compile(r"(?:[A-Za-z0-9+/=\s:,.-]++|\\++[nrt/])++")
#: Header lines of a PEM body; an encrypted key in the old layout names its cipher there.
PEM_HEADER = re.compile(r"(?:\s|\\+[nrt])*([A-Za-z][A-Za-z-]*):[ \t]*([A-Za-z0-9,. -]*)(?=\s|\\+[nrt])")
#: What a PEM body has between base64 signs: breaks, real or escaped, and escapes of slashes.
PEM_GAP = re.compile(r"\s+|\\+[nrt]|\\+(?=/)")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*")
#: Where a key may begin in base64: DER with long lengths, the same with a short one after a separator or an escape, the SSH container, a PEM text.
START = re.compile(r"MI[GHI](?=[A-Za-z0-9+/_-])|(?:(?<![A-Za-z0-9])|(?<=\\[nrt]))M[A-H](?=[A-Za-z0-9+/_-])|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
BREAK = re.compile(r"[ \t]*\\?(?:\r\n?|\n)[ \t]*|(?:\\+[nr])+|\\+(?=/)")
HEX = re.compile(r"[0-9a-fA-F]{48,}")
SSH_MAGIC = b"openssh-key-v1\0"
# Ciphers and key derivations of the SSH container, block bytes of old PEM ciphers, object identifiers of password-based encryption.
SSH_CIPHERS = {b"none", b"3des-cbc", b"aes128-cbc", b"aes192-cbc", b"aes256-cbc", b"aes128-ctr", b"aes192-ctr", b"aes256-ctr", b"aes128-gcm@openssh.com", b"aes256-gcm@openssh.com", b"chacha20-poly1305@openssh.com"}
SSH_KDFS = {b"none", b"bcrypt"}
PEM_BLOCKS = {"DES-CBC": 8, "DES-EDE3-CBC": 8, "AES-128-CBC": 16, "AES-192-CBC": 16, "AES-256-CBC": 16}
PBE_OIDS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
SSH_NAME = re.compile(rb"(?:ssh-[a-z0-9]+|ecdsa-sha2-[a-z0-9]+|sk-[a-z0-9-]+)(?:@[a-z.]+)?")
SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def b64(text: str) -> bytes:
    """Decoded standard or URL-safe base64 without regard to padding; empty if it isn't base64."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (ValueError, binascii.Error):
        return b""


def tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the DER value at ``at``, if its length fits into ``end``."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end or data[at] == 0:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def der_values(data: bytes, at: int, end: int, depth: int = 0) -> list[tuple] | None:
    """The DER values that fill ``data[at:end]`` exactly, as tag and bytes, or tag and values below; None if lengths don't nest."""
    out: list[tuple] = []
    while at < end:
        got = tlv(data, at, end)
        if got is None or depth > 12:
            return None
        tag, start, at = got
        below = der_values(data, start, at, depth + 1) if tag & 0x20 else data[start:at]
        if below is None:
            return None
        out.append((tag, below))
    return out


INT, OCTETS, OID, SEQ = 0x02, 0x04, 0x06, 0x30


def is_private_der(data: bytes) -> bool:
    """A private key by its structure: PKCS#1, PKCS#8 (plain or encrypted), SEC 1 or DSA; public keys and signatures are none."""
    if len(data) < 24 or data[0] != SEQ:
        return False
    whole = der_values(data, 0, len(data))
    if not whole or len(whole) != 1 or not isinstance(whole[0][1], list):
        return False
    parts = whole[0][1]
    tags = [t for t, _ in parts]
    version = parts[0][1] if tags[:1] == [INT] else None
    algorithm = next((v for t, v in parts[:2] if t == SEQ and v and v[0][0] == OID), None)
    if version in (b"\0", b"\1"):
        if set(tags) == {INT} and len(tags) in (6, 9):  # DSA, RSA
            return True
        if tags[:3] == [INT, SEQ, OCTETS] and algorithm:  # PKCS#8
            return all(t in (0xA0, 0x81, 0xA1) for t in tags[3:])
        if version == b"\1" and tags[:2] == [INT, OCTETS] and len(parts[1][1]) >= 16:  # SEC 1
            return all(t in (0xA0, 0xA1) for t in tags[2:])
    return tags == [SEQ, OCTETS] and bool(algorithm) and algorithm[0][1].startswith(PBE_OIDS)  # encrypted PKCS#8


def _strings(data: bytes, at: int, count: int) -> tuple[list[bytes], int] | None:
    """``count`` length-prefixed strings from ``at`` on and where they end."""
    out = []
    for _ in range(count):
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out, at


def is_ssh_private(data: bytes) -> bool:
    """The SSH container: known cipher and key derivation, as many public keys as it says, and one private part that fills it.

    Each public key's own fields must fill it, the first naming a key type; a private part that
    isn't encrypted must begin with two equal numbers and the key's type.
    """
    head = _strings(data, len(SSH_MAGIC), 3) if data.startswith(SSH_MAGIC) else None
    if head is None or head[0][0] not in SSH_CIPHERS or head[0][1] not in SSH_KDFS or len(data) < head[1] + 4:
        return False
    keys = int.from_bytes(data[head[1] : head[1] + 4], "big")
    rest = _strings(data, head[1] + 4, keys + 1) if 0 < keys < 64 else None
    if rest is None or rest[1] != len(data):
        return False
    for key in rest[0][:-1]:
        fields, at = [], 0
        while at < len(key):
            got = _strings(key, at, 1)
            if got is None:
                return False
            fields += got[0]
            at = got[1]
        if len(fields) < 2 or not SSH_NAME.fullmatch(fields[0]):
            return False
    secret = rest[0][-1]
    if head[0][0] != b"none":
        return len(secret) >= 16
    name = _strings(secret, 8, 1)
    return secret[:4] == secret[4:8] and name is not None and bool(SSH_NAME.fullmatch(name[0][0]))


def is_pem_body(body: str) -> bool:
    """Whether a PEM body holds a private key: its base64 decodes to one, or its headers name a cipher that its length fits."""
    headers, at = {}, 0
    while m := PEM_HEADER.match(body, at):
        headers[m[1].lower()], at = m[2].strip(), m.end()
    data = b64(PEM_GAP.sub("", body[at:]))
    if headers.get("proc-type", "").replace(" ", "") == "4,ENCRYPTED":
        cipher, _, start = headers.get("dek-info", "").partition(",")
        block = PEM_BLOCKS.get(cipher.strip(), 0)
        return bool(block) and bool(re.fullmatch(f"[0-9A-Fa-f]{{{2 * block}}}", start.strip())) and len(data) >= 32 and len(data) % block == 0
    return is_private_der(data) or is_ssh_private(data)


def pem_spans(text: str) -> list[tuple[int, int]]:
    """Where private keys begin and end that stand between an opener and the closer that follows it as the next mark; each sign is read once."""
    found, last = [], None
    for m in PEM_MARK.finditer(text):
        if m[1] == "END" and last and last[1] == "BEGIN" and last[2] == m[2] and PEM_BODY.fullmatch(text, last.end(), m.start()) and is_pem_body(text[last.end() : m.start()]):
            found.append((last.start(), m.end()))
        last = m
    return found


def last_pem(data: bytes) -> int:
    """Where the last private key's PEM begins in bytes that are a text; -1 if there is none."""
    spans = pem_spans(data.decode("latin-1")) if b"-----END" in data else []
    return spans[-1][0] if spans else -1


class Wrapped:
    """One run of base64 lines, decoded at most once for each of the four ways to divide its signs."""

    def __init__(self, text: str, at: int) -> None:
        self.at, self.starts, self.before, parts, have = at, [], [], [], 0
        while m := LINE.match(text, at):
            self.starts.append(at)
            self.before.append(have)
            parts.append(m[0])
            have, at = have + len(m[0]), m.end()
            self.end = at
            if gap := BREAK.match(text, at):
                at = gap.end()
            else:
                break
        self.signs = "".join(parts)
        while self.end < len(text) and text[self.end] == "=":
            self.end += 1
        self.last: dict[int, int] = {}

    def holds_pem(self, at: int) -> bool:
        """Whether what is encoded from place ``at`` of the text on holds a private key's PEM."""
        k = bisect_right(self.starts, at) - 1
        sign = self.before[k] + at - self.starts[k]
        turn = sign % 4
        if turn not in self.last:
            self.last[turn] = last_pem(b64(self.signs[turn:]))
        return self.last[turn] >= (sign - turn) // 4 * 3


class Joined:
    """The base64 from a place of a text on, decoded as far as asked, across line breaks, real or escaped."""

    def __init__(self, text: str, at: int) -> None:
        self.text, self.at = text, at

    def signs(self, most: int) -> tuple[str, int]:
        """``most`` signs, or all if there are fewer, and where they end."""
        parts, have, at, end = [], 0, self.at, self.at
        while have < most and (m := LINE.match(self.text, at, at + most - have)):
            parts.append(m[0])
            have, end = have + len(m[0]), m.end()
            if have < most and (gap := BREAK.match(self.text, end)):
                at = gap.end()
            else:
                break
        return "".join(parts), end

    def bytes(self, n: int) -> tuple[bytes, int]:
        """The first ``n`` bytes and where their signs end; no bytes if there are fewer."""
        need = -(-n * 4 // 3)
        if need > len(self.text) - self.at:
            return b"", self.at
        signs, end = self.signs(need)
        while end < len(self.text) and self.text[end] == "=" and (need + 1) % 4 != 1 and need % 4:
            need, end = need + 1, end + 1
        return (b64(signs)[:n], end) if len(signs) >= -(-n * 4 // 3) else (b"", end)

    def field(self, at: int) -> int:
        """Where the length-prefixed field at byte ``at`` ends; 0 if it isn't there."""
        data, _ = self.bytes(at + 4)
        return at + 4 + int.from_bytes(data[at:], "big") if data else 0


def key_at(text: str, at: int) -> tuple[str, int] | None:
    """Kind and end of the private key whose base64 begins at ``at``: its own lengths say how long it is."""
    here = Joined(text, at)
    if text[at] == "M":
        first = b64(here.signs(12)[0])
        head = tlv(first, 0, 1 << 40) if len(first) == 9 else None
        if head is None or head[2] < 30 or first[head[1]] not in (INT, SEQ):
            return None
        data, end = here.bytes(head[2])
        return ("der", end) if data and is_private_der(data) else None
    n = len(SSH_MAGIC)
    for _ in range(3):
        n = n and here.field(n)
    count, _ = here.bytes(n + 4) if n else (b"", 0)
    keys = int.from_bytes(count[n:], "big") if count else 0
    n = n + 4 if 0 < keys < 64 else 0
    for _ in range(keys + 1 if n else 0):
        n = n and here.field(n)
    data, end = here.bytes(n) if n else (b"", 0)
    return ("ssh", end) if data and is_ssh_private(data) else None


def is_signed_token(head: str, body: str) -> bool:
    """The header is a JSON object that names its algorithm, and the body is a JSON object."""
    try:
        header, claims = json.loads(b64(head)), json.loads(b64(body))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict)


def confirmed(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded bytes parse as a private key or a signed token."""
    found = []
    pems = pem_spans(text) if "-----BEGIN" in text else []
    found += [("pem", s, e) for s, e in pems]
    if "eyJ" in text:
        found += [("jwt", m.start(), m.end()) for m in JWT.finditer(text) if is_signed_token(m[1], m[2])]
    over, k, run = 0, 0, None
    for m in START.finditer(text):
        at = m.start()
        while k < len(pems) and pems[k][1] <= at:
            k += 1
        if at < over or (k < len(pems) and pems[k][0] <= at):
            continue
        if text[at] == "L":  # a PEM text
            run = run if run and run.at <= at < run.end else Wrapped(text, at)
            key = ("pem", run.end) if run.holds_pem(at) else None
        else:
            key = key_at(text, at)
        if key:
            kind, over = key
            found.append((kind, at, over))
    for m in HEX.finditer(text):
        if len(m[0]) % 2 == 0 and (kind := hex_kind(m[0].lower())):
            found.append((kind, m.start(), m.end()))
    return found


def hex_kind(digits: str) -> str | None:
    """Which private key hex digits encode, if any."""
    if digits.startswith("30"):
        return "der" if is_private_der(bytes.fromhex(digits)) else None
    if digits.startswith(SSH_MAGIC.hex()):
        return "ssh" if is_ssh_private(bytes.fromhex(digits)) else None
    return "pem" if digits.startswith(b"-----BEGIN".hex()) and last_pem(bytes.fromhex(digits)) >= 0 else None


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of every secret in code points, by start, then kind as listed."""
    if not text:
        return []
    found = confirmed(text)
    for kind, (pattern, group, least) in BASE.items():
        if kind == "assign" and "=" not in text and ":" not in text:
            continue
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row; ``spans`` is an array of ``kind, start, end`` (end exclusive).

    Base kinds are reported as they match; the others only if the decoded bytes have a private
    key's structure or a signed token's header (public keys and signatures have neither), in
    base64 or hex, also where lines are wrapped or escaped. Spans go by start, then by kind as
    in KINDS, then by end; spans of several kinds may overlap. Null and empty texts have no span;
    texts of any length are scanned whole; rows without an id stay, with a null id; repeated rows
    stay; other columns are left out; an empty table gives an empty result. One pass over the
    table, no shuffle.
    """
    schema = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"
    return per_row(ids_and_text(docs, id_col, text_col), lambda ids, texts: (ids, [find_secrets(t) for t in texts]), schema, pa.schema([("doc_id", pa.int64()), ("spans", SPAN)]))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def blank_out(text: str, mark: str) -> str:
    """The text with every run of overlapping secret spans replaced by ``mark``."""
    parts, at = [], 0
    for _, start, end in find_secrets(text):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with the secrets of the text column blanked out; null and empty texts, all columns and repeated rows stay."""

    def redact(texts: list) -> list:
        return [blank_out(t, mark) if t else t for t in texts]

    return docs.withColumn(text_col, of_texts(redact, "string", pa.string())(F.col(text_col).cast("string")))
