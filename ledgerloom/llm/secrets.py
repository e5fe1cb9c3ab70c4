"""Secret scans (4): patterns find candidates, and structure confirms what the method itself reports.

Base kinds, as the contract has them: `assign`, `access` and `hex`. The method's kinds are reported only after the
candidate decodes and its structure holds all the way through:

- `pem`: an armoured block (line ends may be escaped; header lines of an encrypted key may stand before the body) whose
  body is base64 of a DER key structure or of an OpenSSH private key.
- `der`: a run of base64 (either alphabet, wrapped over lines or not) or of hex, outside armour, whose bytes are a DER key
  structure.
- `ssh`: a run of base64 whose bytes are length-prefixed fields that fill it, the first a known key type and the others
  those of that type, or an OpenSSH private key.
- `jwt`: three base64url parts, of which the first decodes to a JSON object that names an algorithm and the second to a
  JSON object.

Key structures are read field by field, every nested length to the last byte: RSA, DSA and EC private keys, PKCS#8 keys,
encrypted or not, and public keys (RSA alone or with an algorithm identifier of a known object identifier). Certificates,
signatures and other DER values are none.

Spans are code points, end exclusive, ordered by start, then by kind as listed. Null texts count as empty and, like
empty ones, have no spans. Repeated rows fare alike.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import map_batches

#: Base kinds in the order of the contract, then the method's.
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
_RANK = {k: i for i, k in enumerate(KINDS)}

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Each match of _ASSIGN holds one of these, in either case.
_ASSIGN_HINT = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_BREAK = r"(?:\s|\\[rn])"
#: Armour is walked from each opening mark: lines of headers, then base64. No part can be read in two ways or goes past
#: the next mark, so a text costs its length.
_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----")
_BREAKS = re.compile(_BREAK + "*+", re.ASCII)
_PEM_HEADER = re.compile(r"[A-Za-z-]++: (?:[^\n\\-]|-(?!----))*+(?=\n|\\[rn])")
_PEM_BODY = re.compile(r"(?:" + _BREAK + r"|[A-Za-z0-9+/=])*+", re.ASCII)
#: A run of base64 of one alphabet, 32 characters or more; wrapped: full lines of one length and a last one, parted by
#: line ends, escaped or not.
_RUN = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
_WRAP = re.compile(r"(?:[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t]*)")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_HEX_ANY = re.compile(r"[0-9a-f]{48,}|[0-9A-F]{48,}")
#: The first part of a token is base64url of text that opens with a brace, or with white space before one.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(?:e[w-z0-9]|[CID][A-Za-z])[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
# Key types of SSH with the number of fields after the type, and object identifiers of key algorithms
# (RSA, RSA-PSS, DSA, DH, EC, X25519, X448, Ed25519, Ed448) and of encryption (PBES2 and older password schemes).
_SSH_FIELDS = {
    b"ssh-rsa": 2, b"ssh-dss": 4, b"ssh-ed25519": 1, b"ecdsa-sha2-nistp256": 2, b"ecdsa-sha2-nistp384": 2, b"ecdsa-sha2-nistp521": 2,
    b"sk-ssh-ed25519@openssh.com": 2, b"sk-ecdsa-sha2-nistp256@openssh.com": 3,
}
_KEY_OIDS = ("1.2.840.113549.1.1.1", "1.2.840.113549.1.1.10", "1.2.840.10040.4.1", "1.2.840.113549.1.3.1", "1.2.840.10045.2.1", "1.3.101.110", "1.3.101.111", "1.3.101.112", "1.3.101.113")
_SEAL_OIDS = ("1.2.840.113549.1.5.13", "1.2.840.113549.1.5.3", "1.2.840.113549.1.5.10", "1.2.840.113549.1.12.1.1", "1.2.840.113549.1.12.1.3", "1.2.840.113549.1.12.1.6")


def _oid(dotted: str) -> bytes:
    """The content of a DER object identifier."""
    first, second, *rest = map(int, dotted.split("."))
    out = b""
    for n in (40 * first + second, *rest):
        part = bytes([n & 0x7F])
        while n := n >> 7:
            part = bytes([n & 0x7F | 0x80]) + part
        out += part
    return out


_KEYS, _SEALS = frozenset(map(_oid, _KEY_OIDS)), frozenset(map(_oid, _SEAL_OIDS))


def _header(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """tag, start and end of the content of the DER value at `at`, if it fits before `end`."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n == 0x80 or n > 0x84:  # indefinite, or longer than any key
        return None
    if n > 0x80:
        width = n - 0x80
        if at + width > end:
            return None
        n = int.from_bytes(data[at : at + width], "big")
        if n < 0x80 or data[at] == 0:  # not the shortest form
            return None
        at += width
    return (tag, at, at + n) if at + n <= end else None


def _parts(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The values that fill the bytes from `at` to `end`; None if they don't."""
    out = []
    while at < end:
        part = _header(data, at, end)
        if not part:
            return None
        out.append(part)
        at = part[2]
    return out


def _algorithm(data: bytes, part: tuple[int, int, int], known: frozenset) -> bool:
    """A sequence that begins with a known object identifier."""
    inner = _parts(data, part[1], part[2]) if part[0] == 0x30 else None
    return bool(inner) and inner[0][0] == 0x06 and data[inner[0][1] : inner[0][2]] in known


def is_key(data: bytes) -> bool:
    """Whether the bytes are one DER sequence, filled by the fields of a key."""
    top = _header(data, 0, len(data))
    if not top or top[0] != 0x30 or top[2] != len(data):
        return False
    fields = _parts(data, top[1], top[2])
    if not fields or len(fields) < 2:
        return False
    kinds = bytes(f[0] for f in fields)
    content = [data[a:b] for _, a, b in fields]
    number = lambda k: int.from_bytes(content[k], "big")
    if kinds[0] == 0x02 and set(kinds) == {0x02}:
        if any(not c or len(c) > 1 and c[0] == 0 and c[1] < 0x80 or c[0] >= 0x80 for c in content):
            return False
        if len(fields) == 9:  # RSA private key: version, modulus, exponents, primes
            return number(0) == 0 and number(1) == number(4) * number(5)
        if len(fields) == 6:  # DSA private key: version, p, q, g, public, private
            return number(0) == 0 and number(1) > number(2) > number(5) and (number(1) - 1) % max(1, number(2)) == 0
        # RSA public key: an odd modulus of 512 bits or more, and a small odd exponent
        return len(fields) == 2 and number(0).bit_length() >= 512 and number(0) % 2 == 1 and 3 <= number(1) < 1 << 64 and number(1) % 2 == 1
    if kinds[:2] == b"\x02\x04" and content[0] == b"\x01":  # EC private key: version 1, number, curve and point
        return 14 <= len(content[1]) <= 72 and all(k in (0xA0, 0xA1) for k in kinds[2:]) and len(fields) <= 4
    if kinds[:3] == b"\x02\x30\x04" and content[0] in (b"\0", b"\x01"):  # PKCS#8
        return bool(content[2]) and _algorithm(data, fields[1], _KEYS) and all(k in (0xA0, 0xA1, 0x81) for k in kinds[3:])
    if kinds == b"\x30\x04":  # PKCS#8, encrypted
        return len(content[1]) >= 8 and _algorithm(data, fields[0], _SEALS)
    # public key with its algorithm: a bit string without unused bits
    return kinds == b"\x30\x03" and len(content[1]) > 16 and content[1][0] == 0 and _algorithm(data, fields[0], _KEYS)


def ssh_fits(data: bytes) -> bool:
    """A public key that its type's fields fill, or an OpenSSH private key whose fields fill it."""
    private = data.startswith(b"openssh-key-v1\0")
    at, fields = 15 if private else 0, []
    while at + 4 <= len(data):
        if private and len(fields) == 3:  # the number of keys stands between the options and the keys
            n_keys = int.from_bytes(data[at : at + 4], "big")
            fields.append(n_keys)
            at += 4
            continue
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data) or (not private and not fields and data[at + 4 : at + 4 + n] not in _SSH_FIELDS):
            return False
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    if at != len(data):
        return False
    if private:  # cipher, derivation, its options, number of keys, public keys, and what is secret
        return len(fields) >= 6 and 1 <= fields[3] <= 64 and len(fields) == 5 + fields[3]
    return len(fields) >= 2 and len(fields) - 1 == _SSH_FIELDS[fields[0]] and all(fields)


def _decode(text: str) -> bytes | None:
    """Bytes of base64 of one alphabet, whatever its padding."""
    body = text.rstrip("=")
    if len(body) % 4 == 1:
        return None
    if "-" in body or "_" in body:
        if "+" in body or "/" in body:
            return None
        body = body.translate(_STANDARD)
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


_STANDARD = str.maketrans("-_", "+/")


def _wrapped(text: str, m: re.Match) -> list[tuple[str, int]]:
    """(body, end) of what begins at the run m: the run alone, and with the lines of its length that follow it."""
    body, end = m[0], m.end()
    out = [(body, end)]
    wide = len(body)
    while not body.endswith("=") and (gap := _WRAP.match(text, end)) and (line := _LINE.match(text, gap.end())) and len(line[0]) <= wide:
        body += line[0]
        end = line.end()
        if len(line[0]) < wide or body.endswith("="):
            break
    if end != m.end():
        out.append((body, end))
    return out


def _json_part(text: str) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(text + "=" * (-len(text) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _armoured(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _BEGIN.finditer(text):
        at = _BREAKS.match(text, m.end()).end()
        headers = []
        while line := _PEM_HEADER.match(text, at):
            headers.append(line[0])
            at = _BREAKS.match(text, line.end()).end()
        body = _PEM_BODY.match(text, at)
        mark = f"-----END {m[1]}-----"
        if not text.startswith(mark, body.end()):
            continue
        data = _decode(re.sub(_BREAK, "", body[0]))
        # with header lines the body may be ciphertext, so only its alphabet shows
        sealed = "PRIVATE KEY" in m[1] and any(h.startswith("Proc-Type: 4,ENCRYPTED") for h in headers)
        if data and (is_key(data) or ssh_fits(data) or sealed and len(data) % 8 == 0):
            out.append((m.start(), body.end() + len(mark)))
    return out


def confirmed(text: str) -> list[tuple[str, int, int]]:
    """Spans of the method's kinds."""
    armour = _armoured(text) if "-----BEGIN " in text else []
    out = [("pem", a, b) for a, b in armour]
    ends = [b for _, b in armour]
    outside = lambda at: not ((k := bisect_right(ends, at)) < len(armour) and armour[k][0] <= at)
    done = seen = 0
    for m in _RUN.finditer(text):
        # a key opens with a sequence (M) or with the length of its type (AAAA); what stands before it may be its name
        first = m[0][0]
        if m.start() < done or first != "M" and not m[0].startswith(("AAAA", "b3BlbnNzaC1rZXktdjE")) or not outside(m.start()):
            continue
        kind, fits = ("der", is_key) if first == "M" else ("ssh", ssh_fits)
        # lines are joined from the first that could be a key's, so a block of lines is walked once
        candidates = _wrapped(text, m) if m.start() >= seen else [(m[0], m.end())]
        seen = max(seen, candidates[-1][1])
        for body, end in candidates:
            if (data := _decode(body)) and fits(data):
                out.append((kind, m.start(), end))
                done = end
                break
    for m in _HEX_ANY.finditer(text):
        at = m[0].find("30")
        while 0 <= at <= 1:  # a key begins with the run or, at an odd place, after a character that isn't its own
            body = m[0][at : len(m[0]) - (len(m[0]) - at) % 2]
            if is_key(bytes.fromhex(body)):
                out.append(("der", m.start() + at, m.start() + at + len(body)))
                break
            at = m[0].find("30", at + 1)
    if "." in text:
        for m in _JWT.finditer(text):
            head, body, _ = m[0].split(".")
            claims = _json_part(head)
            if claims and isinstance(claims.get("alg"), str) and _json_part(body) is not None:
                out.append(("jwt", *m.span()))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if _ASSIGN_HINT.search(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], _RANK[s[0]], s[2])))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_confirmed for each row of docs."""

    def make():
        def one(batch: pa.RecordBatch) -> dict:
            out: dict = {"doc_id": batch.column(0), "n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": [], "n_confirmed": []}
            for text in batch.column(1).to_pylist():
                base, more = base_spans(text or ""), confirmed(text or "")
                kinds = [k for k, _, _ in base]
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(kinds.count(kind))
                out["base_sha256"].append(hashlib.sha256(_listed(base).encode()).hexdigest())
                out["spans"].append(_listed(base + more))
                out["n_confirmed"].append(len(more))
            return out

        return one

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, make, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long")


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: spans of secrets for each document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
