"""Secret scans: a keyword prefilter, anchored patterns near its hits, checksums.

One Aho-Corasick pass over a text with A-Z lower-cased (code points keep their
places) finds keywords: the names of assigned secrets, the fixed beginnings of keys
and tokens, and, for hexadecimal runs, every group of three hexadecimal digits.  A
pattern is tried only at a hit, anchored at the keyword's beginning:

* assign, access, hex (the base kinds): as a leftmost, non-overlapping search for
  their patterns finds them; a match that is too short is dropped as a whole;
* github, npm: a token whose last six characters are the base-62 CRC-32 of the thirty before;
* xprv: an extended private key of 111 base-58 characters whose last four bytes are
  the beginning of the double SHA-256 of the others;
* jwt: three base64url parts of which the first two decode to JSON objects, the first with ``alg``;
* pem: a private key block whose base64 body is a DER sequence of the stated
  length, or an OpenSSH key.

The last five are checked by what they carry, so they need no dictionary of
exceptions; tokens that fail the check are no spans of theirs.  After a failed or
dropped match the search for its kind goes on behind the characters it has read, so
the work is linear in the text.

Defined results: a null or empty text has no spans; texts are read whole; repeated
rows are handled alike; an empty table gives an empty result; columns that clash with
result columns are left out of ``scan_secrets`` and pass through ``mask_secrets`` unchanged.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from stratum.llm.common import ASCII_LOWER, map_rows, read_table, without

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("github", "npm", "xprv", "jwt", "pem")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
TOKEN = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]+)")
XPRV = re.compile(r"xprv[A-Za-z0-9]+")
URL64 = re.compile(r"[A-Za-z0-9_-]+")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )?PRIVATE KEY)-----([A-Za-z0-9+/=\s]*)", re.ASCII)

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = {c: k for k, c in enumerate("123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz")}


def base62(n: int) -> str:
    digits = ""
    while n:
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits


def token_valid(body: str) -> bool:
    """Thirty characters and the base-62 form of their CRC-32 in six."""
    return len(body) == 36 and base62(zlib.crc32(body[:30].encode())).rjust(6, "0") == body[30:]


def base58check(text: str) -> bool:
    """Whether 82 bytes in base 58 end with the checksum of the others."""
    n = 0
    for c in text:
        if c not in BASE58:
            return False
        n = n * 58 + BASE58[c]
    if n.bit_length() > 82 * 8:
        return False
    raw = n.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def jwt_part(text: str) -> dict | None:
    try:
        found = json.loads(base64.urlsafe_b64decode(text + "=" * (-len(text) % 4)))
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def key_block(body: str) -> bool:
    """A DER sequence that is as long as it says, or an OpenSSH key."""
    try:
        raw = base64.b64decode("".join(body.split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if raw.startswith(b"openssh-key-v1\0"):
        return True
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == 2 + raw[1]
    n = raw[1] & 0x7F
    return 1 <= n <= 8 and len(raw) == 2 + n + int.from_bytes(raw[2 : 2 + n], "big")


def parse_assign(text: str, at: int) -> tuple[int, bool]:
    """Each parser: (where the search goes on, whether that is a span's end); the
    first is 0 if the pattern doesn't match."""
    m = ASSIGN.match(text, at)
    return (m.end(), m.end() - m.start(1) >= MIN_VALUE) if m else (0, False)


def parse_access(text: str, at: int) -> tuple[int, bool]:
    m = ACCESS.match(text, at)
    return (m.end(), m.end() - at >= MIN_ACCESS) if m else (0, False)


def parse_hex(text: str, at: int) -> tuple[int, bool]:
    m = HEX.match(text, at)
    return (m.end(), m.end() - at >= MIN_HEX) if m else (0, False)


def parse_token(text: str, at: int) -> tuple[int, bool]:
    m = TOKEN.match(text, at)
    return (m.end(), token_valid(m[1])) if m else (0, False)


def parse_xprv(text: str, at: int) -> tuple[int, bool]:
    m = XPRV.match(text, at)
    return (m.end(), m.end() - at == 111 and base58check(m[0])) if m else (0, False)


def parse_jwt(text: str, at: int) -> tuple[int, bool]:
    parts, end = [], at
    for k in range(3):
        m = URL64.match(text, end + (k > 0)) if not k or text[end : end + 1] == "." else None
        if not m:
            break
        parts.append(m[0])
        end = m.end()
    if not parts:
        return 0, False
    if len(parts) < 3:
        return at + len(parts[0]), False
    head = jwt_part(parts[0])
    if head is None or "alg" not in head or jwt_part(parts[1]) is None:
        return at + len(parts[0]), False
    return end, True


def parse_pem(text: str, at: int) -> tuple[int, bool]:
    m = PEM.match(text, at)
    if not m:
        return 0, False
    tail = f"-----END {m[1]}-----"
    if text.startswith(tail, m.end()) and key_block(m[2]):
        return m.end() + len(tail), True
    return m.end(), False


PARSERS = {
    "assign": parse_assign, "access": parse_access, "hex": parse_hex, "github": parse_token,
    "npm": parse_token, "xprv": parse_xprv, "jwt": parse_jwt, "pem": parse_pem,
}
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "hex": tuple(a + b + c for a in "0123456789abcdef" for b in "0123456789abcdef" for c in "0123456789abcdef"),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "xprv": ("xprv",),
    "jwt": ("eyj",),
    "pem": ("-----begin ",),
}


def make_keywords() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def find_secrets(text: str | None, keywords: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, in code points, end exclusive.  The keywords of a kind don't
    hold one another, so its hits come in the order of their beginnings; a run of
    hexadecimal digits is first hit at its beginning."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return spans
    read = dict.fromkeys(KINDS, 0)
    lowered = text.encode(errors="surrogatepass").translate(ASCII_LOWER).decode(errors="surrogatepass")
    for last, (kind, size) in keywords.iter(lowered):
        at = last + 1 - size
        if at < read[kind]:
            continue
        end, good = PARSERS[kind](text, at)
        if end:
            read[kind] = end
            if good:
                spans[kind].append((at, end))
    return spans


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then in the order of ``kinds``, comma-joined."""
    ordered = sorted((a, k, b) for k, kind in enumerate(kinds) for a, b in spans[kind])
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in ordered)


def scan_secrets(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all others, if None), the number of spans of each kind, a
    digest of the base spans and all spans as text; one pass, no shuffle."""
    counts = [f"n_{k}" for k in KINDS]
    if keep is None:
        keep = without(docs, *counts, "base_sha256", "spans").columns

    def make():
        keywords = make_keywords()

        def one(text):
            spans = find_secrets(text, keywords)
            base = joined(spans, BASE_KINDS)
            return *(len(spans[k]) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), joined(spans, KINDS)

        return lambda rows: [one(x) for (x,) in rows]

    schema = ", ".join(f"{c} bigint" for c in counts) + ", base_sha256 string, spans string"
    return map_rows(docs, make, ["text"], schema, keep)


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle brackets; of
    overlapping spans the one that starts first, then the longer, is replaced."""

    def make():
        keywords = make_keywords()

        def one(text):
            if text is None:
                return (None,)
            found = sorted((a, -b, k) for k, v in find_secrets(text, keywords).items() for a, b in v)
            out, at = [], 0
            for a, b, k in found:
                if a >= at:
                    out += [text[at:a], f"<{k}>"]
                    at = -b
            return ("".join([*out, text[at:]]),)

        return lambda rows: [one(x) for (x,) in rows]

    rest = [c for c in docs.columns if c != "text"]
    return map_rows(docs, make, ["text"], "text string", rest).select(*[f"`{c}`" for c in docs.columns])


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"), ["doc_id"])
