"""Plain single-process versions of the operators' contracts, for comparison."""

import hashlib
import random
import re
import zlib
from collections import Counter

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality_counts(text):
    text = text or ""
    words = plain_words(text)
    chars = sum(map(len, words))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if plain_words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    return len(words), chars, symbols, dup, len(inside)


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items):
    """items: (item_id, text) rows."""
    words = item_words(text)
    hit, found = set(), set()
    for item, content in items:
        w = item_words(content)
        windows = [w[i : i + 13] for i in range(len(w) - 12)] if len(w) >= 13 else [w] if w else []
        for window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add("" if item is None else str(item))
    names = ",".join(sorted(found))
    return (
        len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
        len(hit) > 0 and 20 * len(hit) >= len(words),
    )


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def pii(text):
    spans, counts = [], []
    for kind, pattern in PII.items():
        n = 0
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            spans.append(f"{kind}:{m.start()}:{m.end()}")
            n += 1
        counts.append(n)
    return *counts, hashlib.sha256(",".join(spans).encode()).hexdigest(), spans


def near_duplicates(rows, size=2, percent=80):
    """doc_id -> (number of shingles, component), rows of (doc_id, text)."""
    sets = {}
    for doc, text in rows:
        w = (text or "").translate(LOWER)
        w = plain_words(w)
        sets[doc] = frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()
    head = {d: d for d in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    classes = {}
    for d, s in sets.items():
        if s:
            classes.setdefault(s, []).append(d)
    postings = {}
    for k, s in enumerate(classes):
        for x in s:
            postings.setdefault(x, []).append(k)
    every = list(classes)
    for k, s in enumerate(every):
        both = Counter(j for x in s for j in postings[x] if j > k)
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(every[j]) - n):
                a, b = find(classes[s][0]), find(classes[every[j]][0])
                head[max(a, b)] = min(a, b)
    for members in classes.values():
        for d in members[1:]:
            a, b = find(members[0]), find(d)
            head[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def crc(text):
    return zlib.crc32((text or "").encode())


def fuzzy_lines(rows, size=9, percent=80):
    """(doc_id, line number) of the lines to drop, rows of (doc_id, text)."""
    places = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for at, line in enumerate((text or "").split("\n")) if text is not None else ():
            if plain_words(line):
                places.setdefault(line, []).append((doc, at))
    every = list(places)
    sets = [{x[i : i + size] for i in range(max(1, len(x) - size + 1))} for x in every]  # a short line is its own shingle
    head = list(range(len(every)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    postings = {}
    for k, s in enumerate(sets):
        for x in s:
            postings.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in postings[x] if j > k).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(k), find(j)
                head[max(a, b)] = min(a, b)
    groups = {}
    for k, line in enumerate(every):
        groups.setdefault(find(k), []).extend(places[line])
    return {p for g in groups.values() for p in sorted(g)[1:]}


def prose(words, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(words))


def same_rows(df, rows, columns=15):
    key = lambda r: [(x is None, str(x)) for x in r]
    assert sorted((tuple(r)[:columns] for r in df.collect()), key=key) == sorted(rows, key=key)
