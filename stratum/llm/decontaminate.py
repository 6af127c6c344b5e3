"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``window`` consecutive words (a shorter
item is one window).  The shingles of a window are its word pairs (its only word,
if it has one).  Shingles are ordered by rarity, i.e. by the number of documents
that hold them, counted over all documents.  A window occurs in a document only
if all its shingles do, so the necessary prefix has length one: the rarest
shingle.  Documents are joined with windows on that shingle; the position of the
shingle in the document and in the window gives the only possible place, which
must lie inside the document (positional and length bounds), and there the
window's words are compared one by one.

The benchmark is the query set.  It is read in blocks of at most
``block_words`` words, and one item is held whole.  A block's index is broadcast; each
block counts its shingles in one pass over the documents, and all blocks are matched
in one more, so b blocks take b + 1 passes, and documents are never shuffled.

Defined results: null texts have no words and are clean; an item without words
has no window; rows that repeat an item_id count as one item; a null item_id
counts as the item ''; an empty benchmark leaves every document clean.  Input
columns that clash with result columns are replaced by them in the report, and
the filter returns the input columns unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import fresh_name, map_rows, read_table, share

WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: At most so many candidate places are compared in one array operation.
COMPARE_ROWS = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of all other non-ASCII characters."""
    return text.encode().translate(WORD_BYTES).split() if text else []


class WindowIndex:
    """The distinct windows of a block of items, and their shingles."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at : at + window]), set()).add(item)
        self.base = len(self.vocabulary) + 1
        self.items = [sorted(x) for x in found.values()]
        self.size = np.array([len(w) for w in found], np.int64)
        self.words = np.zeros((len(found), window), np.int64)
        for k, w in enumerate(found):
            self.words[k, : len(w)] = w
        self.single = bool((self.size == 1).any())
        each = [self.shingles(self.words[k, :n])[0] for k, n in enumerate(self.size)]
        self.known = np.unique(np.concatenate(each)) if each else np.zeros(0, np.int64)

    def shingles(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and places of the word pairs (and of single words, where an item
        has only one) that consist of benchmark words; word id 0 is any other word."""
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        keys = ids[at] * self.base + ids[at + 1]
        if self.single or len(ids) == 1:
            alone = np.flatnonzero(ids)
            keys, at = np.concatenate([keys, ids[alone]]), np.concatenate([at, alone])
        return keys, at

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def order(self, frequency: dict[int, int]) -> None:
        """Choose each window's prefix, its rarest shingle, and index it."""
        n = len(self.size)
        prefix, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k in range(n):
            keys, at = self.shingles(self.words[k, : self.size[k]])
            if self.size[k] > 1:
                keys, at = keys[: self.size[k] - 1], at[: self.size[k] - 1]
            prefix[k], offset[k] = min((frequency.get(x, 0), x, y) for x, y in zip(keys.tolist(), at.tolist()))[1:]
        by = np.argsort(prefix, kind="stable")
        self.prefix, self.first = np.unique(prefix[by], return_index=True)
        self.last = np.append(self.first[1:], n)
        self.by, self.offset = by, offset

    def matches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and window of every occurrence of a window in a document."""
        keys, at = self.shingles(ids)
        empty = np.zeros(0, np.int64)
        if not len(keys) or not len(self.prefix):
            return empty, empty
        slot = np.minimum(np.searchsorted(self.prefix, keys), len(self.prefix) - 1)
        joined = self.prefix[slot] == keys
        slot, at = slot[joined], at[joined]
        starts, wins = [empty], [empty]
        many = self.last[slot] - self.first[slot]
        ends = np.cumsum(many)
        lo = 0
        while lo < len(slot):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + COMPARE_ROWS, "right")))
            n = many[lo:hi]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            win = self.by[np.repeat(self.first[slot[lo:hi]], n) + within]
            start = np.repeat(at[lo:hi], n) - self.offset[win]
            fits = (start >= 0) & (start + self.size[win] <= len(ids))
            start, win = start[fits], win[fits]
            same = np.ones(len(win), bool)
            for k in range(self.words.shape[1]):
                live = np.flatnonzero(same & (self.size[win] > k))
                if not len(live):
                    break
                same[live] = ids[start[live] + k] == self.words[win[live], k]
            starts.append(start[same])
            wins.append(win[same])
            lo = hi
        return np.concatenate(starts), np.concatenate(wins)


def shingle_frequencies(docs: DataFrame, index) -> dict[int, int]:
    """Number of documents for each shingle of the block (shared ``index``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = index()
        total = np.zeros(len(block.known), np.int64)
        for batch in batches:
            for text in batch.column(0):
                keys, _ = block.shingles(block.ids(words_of(text.as_py())))
                if len(keys) and len(total):
                    slot = np.minimum(np.searchsorted(block.known, keys), len(total) - 1)
                    total[np.unique(slot[block.known[slot] == keys])] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(block.known[some]), pa.array(total[some])], names=["shingle", "n"])

    rows = docs.select("text").mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {r["shingle"]: r["n"] for r in rows.collect()}  # at most the block's shingles


REPORT = "n_words bigint, n_hit bigint, n_items bigint, items array<string>, items_sha256 string, contaminated boolean"


def contamination_report(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], names: str = REPORT,
    window: int = 13, hit_parts: int = 20, block_words: int = 400_000,
) -> DataFrame:
    """``keep`` columns and, for every document, the number of its words, of those
    inside an occurrence of a window, of items with an occurring window, these
    items, a digest of them, and whether hits are at least one in ``hit_parts``
    words."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    n_words = items.agg(F.sum(F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")))).first()[0] or 0
    blocks = -(-n_words // block_words) or 1
    state = fresh_name("hits", docs.columns)
    state_of = f"{state} array<bigint>, {state}_items array<string>"
    source = docs.select("text")  # the frequencies don't wait for earlier blocks' matches
    for b in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        index = WindowIndex([tuple(r) for r in block.collect()], window)
        index.order(shingle_frequencies(source, share(spark, index)) if len(index.size) else {})
        shared = share(spark, index)
        last, first = b == blocks - 1, b == 0

        def make(shared=shared, last=last, first=first):
            found = shared()

            def one(text, places=None, names_=None):
                words = words_of(text)
                ids = found.ids(words)
                start, win = found.matches(ids)
                touched = {x for k in np.unique(win).tolist() for x in found.items[k]} | set(names_ or ())
                runs = np.stack([start, start + found.size[win]], 1).reshape(-1).tolist() + list(places or ())
                if not last:
                    return runs, sorted(touched)
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, runs[0::2], 1)
                np.add.at(change, runs[1::2], -1)
                hit = int((np.cumsum(change) > 0).sum())
                names = sorted(touched)
                digest = hashlib.sha256(",".join(names).encode()).hexdigest()
                return len(words), hit, len(names), names, digest, hit > 0 and hit_parts * hit >= len(words)

            return lambda rows: [one(*r) for r in rows]

        before = [] if first else [state, f"{state}_items"]
        kept = keep if last else list(dict.fromkeys([*keep, "text"]))
        docs = map_rows(docs, make, ["text", *before], names if last else state_of, kept)
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents that are not contaminated, with the input's columns."""
    prefix = fresh_name("hit", docs.columns)
    names = ", ".join(f"{prefix}_{x.strip()}" for x in REPORT.split(", "))
    judged = contamination_report(docs, benchmark, docs.columns, names, **params)
    return judged.where(~F.col(f"{prefix}_contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination_report(docs, read_table(spark, sf_dir, "benchmark"), ["doc_id"]).drop("items")
