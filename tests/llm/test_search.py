import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm.search import QueryGraph, mine_shared_sums, op11_ranked_search, search, term_pieces

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k=10):
    """[(item position, rank, doc_id, score)], rows of (doc_id, text) and of texts."""
    counted = [(d, len(terms(t)), Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(n > 0 for _, n, _ in counted), sum(n for _, n, _ in counted)
    df = Counter(t for *_, c in counted for t in c)
    rows = []
    for at, text in enumerate(items):
        scored = []
        for d, n, c in counted:
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + ((90 * n * n_docs) // total)
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0))
        rows += [(at, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return rows


def test_terms_in_pieces():
    text = "Aé-b_C9\x00\x85 İ " * 200_000
    assert [w for piece in term_pieces(text) for w in piece] == [t.encode() for t in terms(text)]
    assert list(term_pieces(None)) == list(term_pieces("")) == []


@pytest.mark.parametrize("stretch", [1, 5, 64])
def test_shared_sums_keep_each_item(stretch):
    rng = random.Random(stretch)
    items = [rng.sample(range(40), rng.randint(0, 30)) for _ in range(30)] + [list(range(40))] * 3
    nodes, parts = mine_shared_sums(items, 40, stretch)

    def leaves(x):
        return [x] if x < 40 else leaves(nodes[x - 40][0]) + leaves(nodes[x - 40][1])

    for item, part in zip(items, parts):
        assert sorted(t for x in part for t in leaves(x)) == sorted(item)
    if stretch > 1:  # each shared sum is used, and saves additions
        assert nodes and sum(map(len, parts)) + len(nodes) < sum(map(len, items))


def test_graph_scores():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randint(0, 30)}" for _ in range(25)) for _ in range(20)] + [None, "", "-"]
    graph = QueryGraph(texts, 64)
    shared, single = graph.additions()
    assert shared < single
    values = np.random.default_rng(1).integers(0, 1000, (graph.n_terms, 7))
    t, d = np.indices(values.shape).reshape(2, -1)
    found = graph.scores(t, d, values.reshape(-1), 7)
    for row, at in zip(found, graph.with_parts):
        expected = sum(values[graph.vocabulary[w.encode()]] for w in set(terms(texts[at])))
        assert (row == expected).all()
    assert list(graph.with_parts) == list(range(20))


def test_small_tables(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    expected = {(items[at][0], *rest) for at, *rest in plain_search(docs, [t for _, t in items])}
    assert {tuple(r) for r in op11_ranked_search(spark, small).collect()} == expected


def test_odd_tables_and_blocks(spark, odd, odd_rows, none):
    texts = ["one a x", "", None, odd_rows[4][1][:3000], "nobody owns", "one a x", "zzz"] + [odd_rows[6][1][k : k + 60] for k in range(0, 240, 40)]
    items = spark.createDataFrame([(k if k != 4 else None, t, k) for k, t in enumerate(texts)], "item_id int, text string, rank int").coalesce(2)
    expected = {(at if at != 4 else None, *rest) for at, *rest in plain_search([(r[0], r[1]) for r in odd_rows], texts)}
    for params in ({}, {"block_words": 60}, {"stretch": 3}):
        found = search(odd.withColumn("item_id", F.lit(1)), items, **params)
        assert {tuple(r) for r in found.collect()} == expected, params
    assert search(none, items).count() == 0 and search(odd, items.limit(0)).count() == 0
    assert search(none, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_go_by_doc_id(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same words").alias("text")).repartition(7)
    docs = docs.unionAll(spark.range(50).select(F.lit(None).cast("bigint"), F.lit("other"))) 
    found = search(docs, spark.createDataFrame([("q", "same")], "item_id string, text string"))
    assert [tuple(r)[:3] for r in found.orderBy("rank").collect()] == [("q", k + 1, k) for k in range(10)]
