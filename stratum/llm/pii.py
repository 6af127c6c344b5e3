"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, scheme
marks (``://``, ``www.``), digits, and the cue words of account numbers.  A small
deterministic parser for each kind expands an anchor to the left and right as
far as its alphabet goes, then validates what it has:

* email: the run of local characters before the sign, labels joined by single dots after it;
* ip: a chain of digit runs joined by dots, taken four runs at a time, each at most 255;
* card: digits with at most one blank or hyphen between them, 16 to 19 of them, Luhn sum 0;
* phone: a plus sign, a digit, and what follows of digits, blanks, dots, hyphens and
  parentheses up to the last digit, 8 to 15 digits;
* url: a scheme mark with a known scheme, to the next white space or quote, without closing punctuation;
* account: letters, digits, dots, dashes and slashes after a cue word such as
  ``IBAN`` or ``account``, if they hold at least four digits; an IBAN must pass its checksum.

Base kinds (the first four) are found exactly where a leftmost, non-overlapping
search for their pattern finds them: the expansion starts at the first character
of a maximal run, and a failed candidate is dropped as a whole.

Defined results: a null or empty text has no spans; nothing is cut from long
texts; repeated rows are handled alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from stratum.llm.common import map_rows, read_table

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("url", "account")
KINDS = BASE_KINDS + EXTRA_KINDS
DIGITS = frozenset("0123456789")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
LOCAL = LABEL | frozenset("._%+")
PHONE = DIGITS | frozenset(" ().-")
SCHEMES = ("https", "http", "ftps", "ftp")
CUES = ("iban", "account", "acct", "passport", "routing", "swift", "bic", "ssn")
URL_END = frozenset(" \t\n\x0b\x0c\r\"'<>`{}|\\^")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def octet(digits: str) -> bool:
    """Whether a digit run of any length is at most 255."""
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def iban_valid(text: str) -> bool:
    """The mod-97 checksum of ISO 13616."""
    if not (15 <= len(text) <= 34 and text[:2].isalpha() and text[2:4].isdigit() and text.isascii() and text.isalnum()):
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def parse_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the sign at ``at``; its start is not before ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end, n = at + 1, len(text)
    while end < n and text[end] in LABEL:
        end += 1
    if start == at or end == at + 1:
        return None
    dots = 0
    while end + 1 < n and text[end] == "." and text[end + 1] in LABEL:
        end += 1
        dots += 1
        while end < n and text[end] in LABEL:
            end += 1
    return (start, end) if dots else None


def digit_runs(text: str, at: int, between: str, n: int) -> list[tuple[int, int]]:
    """The digit runs from ``at`` on that single characters of ``between`` join."""
    runs, start = [], at
    while True:
        end = start
        while end < n and text[end] in DIGITS:
            end += 1
        runs.append((start, end))
        if not (end + 1 < n and text[end] in between and text[end + 1] in DIGITS):
            return runs
        start = end + 1


def parse_phone(text: str, at: int) -> tuple[int, int] | None:
    """The number whose plus sign is at ``at``."""
    n = len(text)
    if at + 1 >= n or text[at + 1] not in DIGITS:
        return None
    end = at + 2
    while end < n and text[end] in PHONE:
        end += 1
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    digits = sum(c in DIGITS for c in text[at + 1 : end])
    return (at, end) if end >= at + 4 and 8 <= digits <= 15 else None


def parse_url(text: str, at: int, mark: str) -> tuple[int, int] | None:
    """The address whose scheme mark starts at ``at``."""
    start = at
    if mark == "://":
        head = text[max(0, at - 5) : at].lower()
        scheme = next((s for s in SCHEMES if head.endswith(s)), None)
        if scheme is None:
            return None
        start = at - len(scheme)
    first = end = at + len(mark)
    n = len(text)
    while end < n and text[end] not in URL_END:
        end += 1
    while end > first and text[end - 1] in ".,;:!?)]":
        end -= 1
    return (start, end) if end > first else None


BEFORE_ACCOUNT = re.compile(r"[ \t]*(?:(?:no|nr|number)\b\.?)?[ \t]*[:#=]?[ \t]*", re.ASCII | re.IGNORECASE)
ACCOUNT_WORD = re.compile(r"[A-Za-z0-9](?:[./-]?[A-Za-z0-9])*", re.ASCII)
IBAN_LENGTH = 34  # the longest there is


def parse_iban(text: str, at: int) -> tuple[int, int] | None:
    """The longest valid number from ``at`` on, with single separators in it."""
    best, body, k = None, "", at
    while k < len(text) and len(body) < IBAN_LENGTH:
        c = text[k]
        if c.isascii() and c.isalnum():
            body += c.upper()
            if iban_valid(body):
                best = (at, k + 1)
        elif not (c in " ./-" and k > at and text[k - 1].isalnum()):
            break
        k += 1
    return best


def parse_account(text: str, end: int, cue: str) -> tuple[int, int] | None:
    """The identifier after the cue word that ends at ``end``: words with a digit in
    them, joined by single blanks, as many as there are."""
    start = end - len(cue)
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return None
    a = BEFORE_ACCOUNT.match(text, end).end()
    if cue == "iban":
        return parse_iban(text, a)
    b, at, digits = None, a, 0
    while word := ACCOUNT_WORD.match(text, at):
        here = sum(c in DIGITS for c in word.group())
        if not here:
            break
        b, digits = word.end(), digits + here
        if text[b : b + 1] != " ":
            break
        at = b + 1
    return (a, b) if digits >= 4 else None


def make_anchors() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    for kind, marks in (("email", "@"), ("phone", "+"), ("digit", sorted(DIGITS)), ("url", ("://", "www.")), ("account", CUES)):
        for mark in marks:
            for form in {mark, mark.upper(), mark.capitalize()}:
                anchors.add_word(form, (kind, form.lower()))
    anchors.make_automaton()
    return anchors


def find_spans(text: str | None, anchors: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, in code points, end exclusive."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return spans
    n = len(text)
    taken = dict.fromkeys(KINDS, 0)
    chain = {"ip": 0, "card": 0}  # up to where digits have been parsed

    def add(kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] >= taken[kind]:
            spans[kind].append(span)
            taken[kind] = span[1]

    for last, (kind, mark) in anchors.iter(text):
        if kind == "digit":
            if last >= chain["ip"]:
                runs = digit_runs(text, last, ".", n)
                chain["ip"] = runs[-1][1]
                for k in range(0, len(runs) - 3, 4):
                    four = runs[k : k + 4]
                    if all(octet(text[a:b]) for a, b in four):
                        add("ip", (four[0][0], four[3][1]))
            if last >= chain["card"]:
                runs = digit_runs(text, last, " -", n)
                chain["card"] = runs[-1][1]
                if 16 <= sum(b - a for a, b in runs) <= 19 and luhn("".join(text[a:b] for a, b in runs)):
                    add("card", (runs[0][0], runs[-1][1]))
        elif kind == "email":
            add(kind, parse_email(text, last, taken[kind]))
        elif kind == "phone":
            add(kind, parse_phone(text, last))
        elif kind == "url":
            add(kind, parse_url(text, last + 1 - len(mark), mark))
        elif last >= taken[kind]:  # a cue inside an identifier begins no other
            add(kind, parse_account(text, last + 1, mark))
    return spans


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def pii_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, the number of spans of each base kind, a digest of the base
    spans, all spans as ``kind:start:end``, comma-joined, the numbers of the other kinds and of
    all; one pass, no shuffle."""

    def make():
        anchors = make_anchors()

        def one(text):
            spans = find_spans(text, anchors)
            base = joined(spans, BASE_KINDS)
            return *(len(spans[k]) for k in BASE_KINDS), hashlib.sha256(base.encode()).hexdigest(), joined(spans, KINDS), \
                *(len(spans[k]) for k in EXTRA_KINDS), sum(map(len, spans.values()))

        return lambda rows: [one(x) for (x,) in rows]

    schema = (
        "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, "
        "n_url bigint, n_account bigint, n_spans bigint"
    )
    return map_rows(docs, make, ["text"], schema, keep)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle brackets;
    of overlapping spans the one that starts first, then the longer, is replaced."""

    def make():
        anchors = make_anchors()

        def one(text):
            if text is None:
                return (None,)
            found = sorted((a, -b, k) for k, v in find_spans(text, anchors).items() for a, b in v)
            out, at = [], 0
            for a, b, k in found:
                if a >= at:
                    out += [text[at:a], f"<{k}>"]
                    at = -b
            return ("".join([*out, text[at:]]),)

        return lambda rows: [one(x) for (x,) in rows]

    rest = [c for c in docs.columns if c != "text"]
    return map_rows(docs, make, ["text"], "text string", rest).select(*[f"`{c}`" for c in docs.columns])


def op6_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(read_table(spark, sf_dir, "documents"), ["doc_id"])
