import random
from collections import Counter, defaultdict

import reference as plain
from reference import same_rows

from stratum.llm import sharding


def check(rows, text_of, n):
    size, slots, where = Counter(), defaultdict(list), {}
    for r in rows:
        text = text_of(r)
        assert where.setdefault((text is None, text), r.shard) == r.shard
        size[r.shard] += len((text or "").encode()) + 1
        slots[r.shard].append(r.slot)
    assert len(rows) == n and all(sorted(v) == list(range(len(v))) for v in slots.values())
    return [size[k] for k in range(8)]


def test_balance_and_slots(spark, small):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = sharding.op1_shard_balance(spark, small).collect()
    sizes = check(rows, lambda r: text[r.doc_id], len(text))
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes)
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id].encode()) + 1, plain.crc(text[r.doc_id]), "bytes", None)


def test_known_differencing():
    assert Counter(map(len, ["x"] * 5))[1] == 5
    sizes = [8, 7, 6, 5, 4]
    part = sharding.differencing(sizes, 2)
    sums = sorted(sum(s for s, p in zip(sizes, part) if p == k) for k in (0, 1))
    assert sums == [14, 16]  # the textbook result of Karmarkar-Karp
    assert sharding.differencing([], 3) == [] and sharding.differencing([5, 5], 1) == [0, 0]


def test_levels_with_a_giant_group(spark):
    rng = random.Random(3)
    sizes = [rng.randint(50, 5000) for _ in range(6000)]
    sizes[17] = sum(sizes) // 10
    groups = spark.createDataFrame([(str(k).encode(), s) for k, s in enumerate(sizes)], "key binary, bytes bigint")
    placed = sharding.assign_groups(groups, 8, pieces=32, block_rows=256, top_rows=600).collect()
    sums = Counter()
    for r in placed:
        sums[r["shard"]] += sizes[int(bytes(r["key"]))]
    assert len(placed) == len(sizes) and max(sums.values()) - min(sums.values()) < 0.01 * sum(sizes)


def test_odd_rows(spark, odd, odd_rows, none):
    placed = sharding.shard_rows(odd)
    assert placed.columns == [c for c in odd.columns if c != "shard"] + ["shard", "slot"]
    check(placed.collect(), lambda r: r.text, len(odd_rows))
    same_rows(placed.drop("shard", "slot"), [(*r[:5], *r[6:]) for r in odd_rows], 14)
    assert sharding.shard_rows(none).count() == 0
