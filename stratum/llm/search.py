"""Ranked lexical search of many queries at once, with shared partial sums.

A query (an item) is a set of terms; the score of a document is the sum of one
integer for each of the item's terms that it holds.  Items share terms, so the sums
are planned together, as common subexpressions:

* mining: the pair of terms (or of sums made before) that most items have in common
  becomes a sum of its own and takes the pair's place in them, until no pair is in
  two items.  What is left is a query-sharing graph: terms are its leaves, each
  inner node is the sum of two others, each item a sum of a few nodes.
* evaluation: for a chunk of documents, the value of each leaf is computed and each
  inner node is added up once, level by level; items are then combined from them.

Texts are read once a block of items: a pass counts each document's terms of the
block's vocabulary, and writes them with its length; statistics (documents with a term,
all terms, document frequencies) are aggregates of that table, over all documents.
The second pass evaluates the graph and keeps, in each task, the best documents of
each item; windows over salted groups, then over items, keep the best of these.

Items are the query set, read in blocks of at most ``block_words`` words; each block is
one such double pass, so a benchmark of any size is handled (one item is held
whole on the driver, however long).  Long items are mined in stretches of ``stretch`` terms,
which bounds the pairs and changes no score.

Defined results: a null or empty text has no terms, and its document is in no
result; an item without terms has no rows; rows that repeat a document are documents
of their own, with equal scores and ranks one after the other; rows with a null doc_id
come last among equal scores; each row of the benchmark is an item, also if it repeats an
item_id or has none; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import map_rows, read_table, share, spool
from stratum.llm.decontaminate import WORD_BYTES

PIECE = 1 << 20
#: Values (of nodes, by documents) held at once when the graph is evaluated.
CELLS = 1 << 22
SALTS = 64


def term_pieces(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about a megabyte: maximal runs of ASCII letters
    and digits and of non-ASCII characters, A-Z lower-cased."""
    data = text.encode(errors="replace").translate(WORD_BYTES) if text else b""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def mine_shared_sums(items: list[list[int]], n_terms: int, stretch: int = 64) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """(nodes, parts): node ``n_terms + k`` is the sum of the two in ``nodes[k]``, which
    come before it, and an item is the sum of its ``parts``.  ``items`` hold distinct
    numbers below ``n_terms``."""
    often = Counter(t for item in items for t in item)
    units: list[set[int]] = []
    unit_of: list[list[int]] = []
    for item in items:
        ordered = sorted(item, key=lambda t: (-often[t], t))
        unit_of.append([])
        for at in range(0, len(ordered), stretch):
            unit_of[-1].append(len(units))
            units.append(set(ordered[at : at + stretch]))
    holders: dict[tuple[int, int], set[int]] = {}
    for u, terms in enumerate(units):
        shared = sorted(t for t in terms if often[t] > 1)
        for i, a in enumerate(shared):
            for b in shared[i + 1 :]:
                holders.setdefault((a, b), set()).add(u)
    heap = [(-len(us), pair) for pair, us in holders.items() if len(us) > 1]
    heapq.heapify(heap)
    nodes: list[tuple[int, int]] = []
    while heap:
        n, pair = heapq.heappop(heap)
        us = holders.get(pair, ())
        if len(us) < 2 or len(us) != -n:
            if len(us) > 1:
                heapq.heappush(heap, (-len(us), pair))
            continue
        new = n_terms + len(nodes)
        nodes.append(pair)
        fresh = set()
        for u in list(us):
            units[u] -= set(pair)
            for other in units[u]:
                for old in pair:
                    gone = holders.get((min(old, other), max(old, other)))
                    if gone:
                        gone.discard(u)
                holders.setdefault((other, new), set()).add(u)
                fresh.add((other, new))
            units[u].add(new)
        holders.pop(pair)
        for made in fresh:
            if len(holders[made]) > 1:
                heapq.heappush(heap, (-len(holders[made]), made))
    return nodes, [[x for u in us for x in sorted(units[u])] for us in unit_of]


class QueryGraph:
    """The plan of a block of items: vocabulary, shared sums by level, items' parts."""

    def __init__(self, texts: list[str | None], stretch: int):
        self.vocabulary: dict[bytes, int] = {}
        items = []
        for text in texts:
            words = dict.fromkeys(w for piece in term_pieces(text) for w in piece)
            items.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
        self.n_terms = len(self.vocabulary)
        nodes, parts = mine_shared_sums(items, self.n_terms, stretch)
        self.size = self.n_terms + len(nodes)
        level = [0] * self.size
        for k, (a, b) in enumerate(nodes):
            level[self.n_terms + k] = 1 + max(level[a], level[b])
        self.levels = []
        pairs, depth = np.array(nodes, np.int64).reshape(-1, 2), np.array(level[self.n_terms :], np.int64)
        for d in range(1, max(level, default=0) + 1):
            at = np.flatnonzero(depth == d)
            self.levels.append((at + self.n_terms, pairs[at, 0], pairs[at, 1]))
        self.with_parts = np.array([k for k, p in enumerate(parts) if p], np.int64)
        some = [p for p in parts if p]
        self.parts = np.array([x for p in some for x in p], np.int64)
        self.starts = np.cumsum([0] + [len(p) for p in some])[:-1]
        self.weights = np.zeros(self.n_terms, np.int64)

    def additions(self) -> tuple[int, int]:
        """Additions a document, with shared sums and without."""
        inner = sum(len(n) for n, _, _ in self.levels)
        widths = np.diff(np.append(self.starts, len(self.parts)))
        leaves = np.ones(self.size, np.int64)
        for n, a, b in self.levels:
            leaves[n] = leaves[a] + leaves[b]
        return inner + int((widths - 1).sum()), int(leaves[self.parts].sum()) - len(widths)

    def scores(self, terms: np.ndarray, doc: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores of ``with_parts`` by documents, from the values of (term, document)."""
        values = np.zeros((self.size, n_docs), np.int64)
        values[terms, doc] = value
        for n, a, b in self.levels:
            values[n] = values[a] + values[b]
        return np.add.reduceat(values[self.parts], self.starts, axis=0)


def count_terms(docs: DataFrame, graph) -> DataFrame:
    """(doc_id, n, terms, counts): the number of a document's terms, and those of the
    block's vocabulary with their occurrences."""

    def make():
        vocabulary = graph().vocabulary

        def one(text):
            n, counts = 0, Counter()
            for words in term_pieces(text):
                n += len(words)
                counts.update(words)
            known = sorted((vocabulary[w], c) for w, c in counts.items() if w in vocabulary)
            return n, [t for t, _ in known], [c for _, c in known]

        return lambda rows: [one(x) for (x,) in rows]

    return map_rows(docs, make, ["text"], "n bigint, terms array<int>, counts array<bigint>", ["doc_id"])


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def best_of(item, score, doc, null, k):
    """Positions of the ``k`` best entries of each item."""
    order = np.lexsort((doc, null, -score, item))
    sorted_items = item[order]
    first = np.searchsorted(sorted_items, sorted_items, "left")
    return order[np.arange(len(order)) - first < k]


def evaluate(counted: DataFrame, graph, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, score, doc_id): the best ``k`` documents of each item in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = graph()
        n_items = len(plan.with_parts)
        empty = np.zeros(0, np.int64)
        item, score, doc, null = empty, empty, empty, empty
        least = np.ones(n_items, np.int64)  # what a score must reach
        step = max(16, CELLS // max(1, plan.size))

        def shrink():
            nonlocal item, score, doc, null
            kept = best_of(item, score, doc, null, k)
            item, score, doc, null = item[kept], score[kept], doc[kept], null[kept]
            full = np.bincount(item, minlength=n_items) >= k
            lowest = np.full(n_items, np.iinfo(np.int64).max)
            np.minimum.at(lowest, item, score)
            least[full] = lowest[full]

        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists, counts = part.column(2), part.column(3)
                sizes = np.diff(lists.offsets.to_numpy())
                if not n_items or not sizes.sum():
                    continue
                terms, tf = lists.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy()
                which = np.repeat(np.arange(len(sizes)), sizes)
                m = np.array([10 + 90 * n * n_docs // n_terms for n in part.column(1).to_pylist()], np.int64)
                value = plan.weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m[which]))
                found = plan.scores(terms, which, value, len(sizes))
                rows, columns = np.nonzero(found >= least[:, None])
                ids = part.column(0)
                no_id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                item, score = np.concatenate([item, rows]), np.concatenate([score, found[rows, columns]])
                doc, null = np.concatenate([doc, ids[columns]]), np.concatenate([null, no_id[columns]])
                if len(item) > 4 * k * n_items:
                    shrink()
        if len(item):
            shrink()
        yield pa.RecordBatch.from_arrays(
            [pa.array(plan.with_parts[item], pa.int32()), pa.array(score, pa.int64()), pa.array(doc, pa.int64(), mask=null.astype(bool))],
            names=["item", "score", "doc_id"],
        )

    return counted.mapInArrow(run, "item int, score bigint, doc_id bigint")


def search_block(docs: DataFrame, texts: list[str | None], k: int, stretch: int) -> DataFrame | None:
    """(item, rank, doc_id, score): the best documents of the items, by number."""
    spark = docs.sparkSession
    graph = QueryGraph(texts, stretch)
    counted = spool(count_terms(docs, share(spark, graph)))
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_terms:
        return None
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for r in frequency.collect():  # at most the block's vocabulary
        graph.weights[r.term] = term_weight(n_docs, r.df)
    graph.vocabulary = {}
    found = evaluate(counted, share(spark, graph), n_docs, n_terms, k)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = Window.partitionBy("item", "salt").orderBy(*order)
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    found = found.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return found.where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_words: int = 200_000, stretch: int = 64) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    docs, items = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), items.select("item_id", "text")
    n_words = items.agg(F.sum(F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")))).first()[0] or 0
    blocks = -(-n_words // block_words) or 1
    id_type = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {id_type}, rank int, doc_id bigint, score bigint"
    result = None
    for b in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = block.collect()
        found = search_block(docs, [r.text for r in rows], k, stretch) if rows else None
        if found is None:
            continue
        names = spark.createDataFrame([(n, r.item_id) for n, r in enumerate(rows)], f"item int, item_id {id_type}")
        named = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        result = named if result is None else result.unionAll(named)
    return spark.createDataFrame([], schema) if result is None else result


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
