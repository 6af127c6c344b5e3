import random

import reference as plain
from pyspark.sql import functions as F
from reference import prose, same_rows

from stratum.llm import common, neardup


def brute(docs, size=2):
    return plain.near_duplicates(docs, size)


def test_documents(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = brute(docs)
    rows = neardup.op2_near_duplicates(spark, small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and len(rows) == len(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_a_family_without_a_common_hub(spark):
    """Copies whose similarity to each other lies on both sides of the threshold, chains, and exact copies."""
    rng = random.Random(7)
    docs, k = [], 0
    for family in range(3):
        base = prose(120, 100 + family).split()
        for _ in range(60):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randint(0, 9)):
                words[at] = f"w{rng.random()}"
            docs.append((k, " ".join(words)))
            k += 1
    chain = prose(100, 5).split()
    for _ in range(25):  # each like the one before, ends unlike
        chain = list(chain)
        for at in rng.sample(range(100), 5):
            chain[at] = f"c{rng.random()}"
        docs += [(k, " ".join(chain)), (k + 1, " ".join(chain))]
        k += 2
    want = brute(docs)
    found = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), size=2)
    assert {r.doc_id: r.component_id for r in found.collect()} == {d: c for d, (_, c) in want.items()}


def test_odd_rows(spark, odd, odd_rows, none):
    rows = neardup.near_duplicates(odd, size=2).collect()
    assert len(rows) == len(odd_rows)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id in (1, 2, 3, 4, 5, 6, 7, 8, 9)}
    assert {(d, c) for d, _, c in got} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 7), (8, 7), (9, 7)}
    assert {n for d, n, _ in got if d in (1, 2, 3)} == {0}
    kept = neardup.drop_near_duplicates(odd, size=2)
    assert kept.columns == odd.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "7", "None", "None", "10", "11", "13", "15"])  # 12 says what 11 says, 14 what 7 says
    same_rows(kept.where("doc_id = 5"), [r for r in odd_rows if r[0] == 5])
    assert neardup.near_duplicates(none).count() == 0 and neardup.drop_near_duplicates(none).count() == 0


def test_repeated_rows_leave_one(spark):
    text = prose(40, 8)
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (None, text, "b")], "doc_id bigint, text string, lang string")
    assert [r.doc_id for r in neardup.drop_near_duplicates(docs).collect()] == [1]
    only = docs.where("doc_id is null")
    assert neardup.drop_near_duplicates(only).count() == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2001 + k) for k in range(80)]
    head = {}

    def find(x):
        while head.setdefault(x, x) != x:
            x = head[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        head[b] = a
    got = common.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_values_shared_by_chance_make_no_candidates(spark, monkeypatch):
    """Unlike texts of few words: single signature values agree now and then, whole bands hardly."""
    rng, seen = random.Random(9), []
    docs = [(d, " ".join(f"w{rng.randrange(80)}" for _ in range(150))) for d in range(200)]
    docs.append((200, docs[0][1] + " more"))
    hubs = neardup.list_hubs
    monkeypatch.setattr(neardup, "list_hubs", lambda candidates: seen.append(candidates.count()) or hubs(candidates))
    found = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), size=2).collect()
    assert {r.doc_id: r.component_id for r in found} == {**{d: d for d in range(200)}, 200: 0}
    assert 2 <= seen[0] < 20


def test_exploded_lists_are_not_broadcast(spark):
    """Spark takes their rows for few, here and in tables of any size below its threshold."""
    texts = [" ".join([*prose(60, d // 4).split(), f"w{d}"]) for d in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("text_hash", F.xxhash64("text"))
    signed = neardup.sign_documents(docs, 5, 64, ["doc_id", "text_hash"])
    classes = common.spool(signed.select(F.col("doc_id").alias("id"), "n_shingles", "signature", "doc_id", "text_hash", F.lit(1).alias("rows")))
    shared = neardup.shared_postings(classes, 64)
    candidates = common.spool(shared.join(classes, "id"))
    assert candidates.count() == 40
    hubs = common.spool(neardup.list_hubs(candidates))
    blocks = common.spool(neardup.verify_blocks(candidates, hubs))
    member = common.spool(candidates.join(blocks.select("id", "n", "family"), "id").withColumn("component", F.col("id")))
    for made in (
        shared, neardup.star_pairs(candidates, hubs, 64, 34, 80), neardup.crossing_pairs(member, 64, 34, 80),
        neardup.block_pairs(blocks.withColumns({"component": F.col("id"), "largest": F.lit(0)}), "family", ["id"]),
    ):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_shingle_numbers():
    texts = ["a b c A b", "b c a b c", "a", "A b", "a b c d", "a b c"]
    for size in (1, 2, 3, 5):
        words = [t.lower().split() for t in texts]
        sets = [set(zip(*(w[k:] for k in range(size)))) or {tuple(w)} for w in words]
        numbers = [set(x.tolist()) for x in neardup.shingle_numbers(texts, size)]
        assert [len(x) for x in numbers] == [len(x) for x in sets]
        assert all(len(numbers[i] & numbers[j]) == len(sets[i] & sets[j]) for i in range(6) for j in range(6))


def test_agreeing_coordinates(spark):
    rng = random.Random(4)
    rows = [([rng.randrange(2) * 64 + rng.randrange(3) for _ in range(64)], [rng.randrange(2) * 64 + rng.randrange(3) for _ in range(64)]) for _ in range(50)]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>")
    got = df.select("a", "b", neardup.packed("a", 64).alias("x"), neardup.packed("b", 64).alias("y")).select("a", "b", neardup.agreeing("x", "y", 64).alias("n"))
    assert all(r.n == sum(x == y for x, y in zip(r.a, r.b)) for r in got.collect())
