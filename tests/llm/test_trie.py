import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stratum.llm.trie import SpillingQueue, op12_prefix_trie, prefix_trie, running, time_forward

DDL = "conv_id bigint, turn bigint, role string, text string, depth int, n string"


def plain_trie(rows):
    """Nodes from (conv_id, turn, role, text) rows."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, x) for *_, r, _, x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - c % 100, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, path in full.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(below[x][1] for x in kids[node])
        below[node] = (sum(below[x][0] for x in kids[node]) or 1, saved)
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(full[c]) == len(node))
        out.append((
            min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(kids[node]), *below[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_small_tables(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op12_prefix_trie(spark, small)) == plain_trie(rows)


@pytest.mark.parametrize("parts,memory", [(1024, 100_000), (1, 2), (7, 3)])
def test_bushy_tries(spark, parts, memory):
    """Copies, long paths, few distinct turns, spilling queues, and crowns of all sizes."""
    rng = random.Random(parts)
    rows = []
    for c in [*range(0, 260), 1007, 2000, 2001]:
        for t in range(rng.choice([0, 1, 2, 3, 6, 9, 40])):
            rows.append((c, t, rng.choice(["user", "user", "assistant"]), "x" * rng.choice([0, 1, 1, 1, 5]), 1, "n"))
    rows += [(5, 300 + t, "user", f"long {t}", 1, "n") for t in range(700)]
    df = spark.createDataFrame(rows, DDL).repartition(5)
    assert found(prefix_trie(df, parts, memory)) == plain_trie([r[:4] for r in rows])


def test_odd_tables(spark):
    rows = [
        (None, 0, "user", "nobody's"), (100, None, None, None), (100, None, "user", "é🙂"), (100, 1, "user", "é🙂"), (100, 1, "user", "é🙂"),
        (101, 2, "", ""), (103, None, "user", "é🙂"), (104, -5, "a", "b" * 100_000), (104, 7, "a", None), (299, 1, "ab", "c"), (298, 1, "a", "bc"),
        (9_000_000_000, 1, "user", "x"), (9_000_000_001, 1, "user", "x"),
    ]
    df = spark.createDataFrame([(*r, 3, "k") for r in rows], DDL)
    assert found(prefix_trie(df)) == plain_trie(rows)
    assert prefix_trie(df.where("conv_id is null")).count() == 0 == prefix_trie(df.limit(0)).count()


def test_running_totals_over_partitions(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 7 < 5, 1).otherwise(F.col("id") % 5).alias("conv"), F.col("id").alias("at"))
    total = {"n": (F.count(F.lit(1)), F.sum, lambda a, b: a + b)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        out = running(rows, [F.col("at")], total).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by = defaultdict(list)
    for r in out:
        by[r.conv].append((r.at, r.n))
    assert len(out) == 4000
    for pairs in by.values():
        assert [n for _, n in sorted(pairs)] == list(range(1, len(pairs) + 1))


def test_queue_spills_in_order():
    rng = random.Random(1)
    queue, sent = SpillingQueue(5), defaultdict(lambda: [0, 0, 0])
    for _ in range(500):
        key = (-rng.randint(0, 3), rng.randint(-3, 3), rng.randint(-2**62, 2**62) % 3)
        value = (1, rng.randint(0, 9), rng.randint(0, 2**40))
        queue.push((*key, *value))
        sent[key] = [a + b for a, b in zip(sent[key], value)]
    assert queue.made > 10
    assert [list(queue.take(k)) for k in sorted(sent)] == [sent[k] for k in sorted(sent)]
    assert queue.take((9, 0, 0)) == (0, 0, 0)


def test_messages_from_elsewhere_count():
    rows = [(2, 5, 5, 4, 4, 10, True, 3, 7, 100), (2, 6, 6, 4, 4, 1, True, 0, 0, 0), (1, 4, 4, 0, 0, 2, False, 0, 0, 0)]
    assert list(time_forward(iter(rows), 2)) == [(2, 5, 5, 3, 7, 110), (2, 6, 6, 0, 1, 1), (1, 4, 4, 2, 8, 113)]
