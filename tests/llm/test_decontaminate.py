import reference as plain
from reference import prose, same_rows

from stratum.llm import decontaminate as dec


def test_against_brute_force(spark, small):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    for r in dec.op5_decontaminate(spark, small).collect():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == plain.contamination(text[r.doc_id], items)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog, and then the quick brown fox jumps once more over it"),
    (2, "one"), (3, None), (4, ""), (None, "no one knows me"), (1, "a second row of item one"), (7, "a second row of item one"),
    (8, "Dé à ü 12 x"), (9, "the the the the the the the the the the the the the the the"),
]


def test_cases_and_blocks(spark):
    texts = [
        "so THE quick brown fox jumps over the lazy-dog and then the quick brown! fox jumps once", "One", "o ne", None, "", "x " * 300 + "one",
        "the " * 14, "a second row of item one a second row of item one", "nobody: No one knows me.", "dé À ü 12 x", "quick brown fox " * 10, prose(50, 4) + " the" * 13,
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1, "One")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = sorted((k, *plain.contamination(t, ITEMS)) for k, t in rows)
    for block_words in (400_000, 12):  # a block of all items, then several blocks
        got = dec.contamination_report(docs, bench, ["doc_id"], block_words=block_words).drop("items").collect()
        assert sorted(map(tuple, got)) == want


def test_odd_rows(spark, odd, odd_rows, none):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = dec.decontaminate(odd, bench)
    assert kept.columns == odd.columns
    same_rows(kept, [r for r in odd_rows if not plain.contamination(r[1], ITEMS)[4]])
    assert dec.decontaminate(none, bench).count() == 0
    same_rows(dec.decontaminate(odd, bench.limit(0)), odd_rows)


def test_blocks_take_one_pass_each(spark, monkeypatch):
    """The frequencies of a block read the texts, not the matches of earlier blocks."""
    docs = spark.createDataFrame([(k, f"w{k} w{k + 1} w{k + 2} w{k + 3}") for k in range(30)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, f"w{k} w{k + 1} w{k + 2}") for k in range(0, 30, 3)], "item_id bigint, text string")
    plans, count = [], dec.shingle_frequencies
    monkeypatch.setattr(dec, "shingle_frequencies", lambda d, i: (plans.append(d._jdf.queryExecution().toString()), count(d, i))[1])
    got = dec.contamination_report(docs, bench, ["doc_id"], block_words=8).select("doc_id", "n_hit").collect()
    assert len(plans) >= 3 and not any("MapInArrow" in p for p in plans)
    assert {r.doc_id: r.n_hit for r in got} == {k: 0 if k % 3 == 1 else 3 for k in range(30)} | {k: 0 for k in range(30) if k % 3 == 1} | {
        k: 3 for k in range(2, 27, 3)} | {29: 0}
