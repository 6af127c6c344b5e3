"""The prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it.  Texts don't travel: a turn is its role, the MD5 of
its text and its length, and a prefix is the depth and two 64-bit lanes, in each the
exclusive-or of one hash a turn of (position, role, digest).

Positions and prefixes are running sums over a conversation.  They are taken by a
distributed scan: rows are range-partitioned by (conversation, turn), a window sums
within each partition, and what earlier partitions hold of the same conversation
is added; at most one conversation straddles each border, so these carries are at
most as many as partitions.  A conversation of any length is cut over many tasks.

Subtree totals flow from leaves to the root as messages in time: a node's message is
ready once those of its children are.  Nodes are handed out to shards by subtree: the
nodes with more than 1/``parts`` of all conversations form the crown, and the subtrees
that hang from it are dealt to tasks whole.  Each task externally sorts its nodes by
reverse level order and streams them; a node takes the messages addressed to it from a
priority queue, adds them up, and sends one to its parent.  The queue holds
``memory`` messages and spills sorted runs beyond.  What shard roots send is summed by
receiver, and a last pass of the same kind goes through the crown, which has at most
``parts`` nodes a level.

Defined results: null roles and texts are empty; turns are ordered by number, nulls
first, and those that repeat a number by role and text digest (repeated rows are turns
of their own); rows without a conv_id belong to no conversation and are left out; an
empty table gives no nodes, not even a root; other columns are not read.  The
digest of the conversations that end at a node is made by one task, as a stream of sorted ids.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import read_table, small_side, spool

RECORD = "<qqqqqq"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class SpillingQueue:
    """Messages (level, k1, k2, children, leaves, saved) in order.  At most ``memory``
    of them are held; more go, sorted, to a temporary file of the task's own, of
    which the next record is held."""

    def __init__(self, memory: int):
        self.memory = max(2, memory)
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # heap of (next record, number, its run)
        self.made = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.memory:
            run = tempfile.TemporaryFile()
            self.heap.sort()
            for m in self.heap:
                run.write(struct.pack(RECORD, *m))
            run.seek(0)
            self.heap = []
            self._advance(self.made, run)
            self.made += 1

    def _advance(self, number: int, run) -> None:
        data = run.read(struct.calcsize(RECORD))
        if data:
            heapq.heappush(self.runs, (struct.unpack(RECORD, data), number, run))
        else:
            run.close()

    def take(self, node: tuple) -> tuple[int, int, int]:
        """The sums of all messages to ``node`` = (level, k1, k2)."""
        children = leaves = saved = 0
        while True:
            if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
                message, number, run = self.runs[0]
                if message[:3] != node:
                    break
                heapq.heappop(self.runs)
                self._advance(number, run)
            elif self.heap and self.heap[0][:3] == node:
                message = heapq.heappop(self.heap)
            else:
                break
            children, leaves, saved = children + message[3], leaves + message[4], saved + message[5]
        return children, leaves, saved


def time_forward(rows: Iterator[tuple], memory: int) -> Iterator[tuple]:
    """Rows (depth, k1, k2, p1, p2, own, sends, children, leaves, saved) by falling depth,
    then k1 and k2; the last three are sums of messages from elsewhere, and a node that
    ``sends`` has its parent here.  Yields (depth, k1, k2, children, leaves, saved)."""
    queue = SpillingQueue(memory)
    for depth, k1, k2, p1, p2, own, sends, children, leaves, saved in rows:
        c, n, s = queue.take((-depth, k1, k2))
        children += c
        leaves = leaves + n if children else 1
        saved += s + own
        if sends:
            queue.push((1 - depth, p1, p2, 1, leaves, saved))
        yield depth, k1, k2, children, leaves, saved


def row_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def arrow_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


def running(rows: DataFrame, order: list[Column], total: dict[str, tuple]) -> DataFrame:
    """``rows`` with running totals over each ``conv`` in the given order, by a distributed
    scan.  ``total`` maps a new column to (aggregate of rows, aggregate of partial
    totals, sum of two totals of which zero is none)."""
    placed = spool(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()))
    here = Window.partitionBy("conv", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.select("*", *[agg.over(here).alias(name) for name, (agg, _, _) in total.items()])
    parts = placed.groupBy("conv", "part").agg(*[agg.alias(name) for name, (agg, _, _) in total.items()])
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(Window.partitionBy("conv").orderBy("part")).alias("place")
    carried = [combine(name).over(before).alias(f"carry_{name}") for name, (_, combine, _) in total.items()]
    carry = spool(parts.select("conv", "part", place, *carried).where("place > 1").drop("place"))  # at most one conversation a border
    joined = summed.join(small_side(carry), ["conv", "part"], "left")
    added = [plus(F.col(name), F.coalesce(f"carry_{name}", F.lit(0).cast("bigint"))).alias(name) for name, (_, _, plus) in total.items()]
    return joined.select(*[c for c in rows.columns], *added)




def rebuilt_turns(conversations: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): every conversation c as the first ``h`` turns of
    c - c % every and its own turns after its first h, h being the CRC-32 of its decimal
    form modulo ``heads``.  Turns have conv, at, role, digest and chars, conversations
    conv and their number of turns."""
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.md5(F.coalesce("text", F.lit(""))).alias("digest"), F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    ranked = spool(running(turns, order, {"nth": (F.count(F.lit(1)), F.sum, lambda a, b: a + b)}))
    convs = ranked.groupBy("conv").agg(F.max("nth").alias("own"))
    convs = convs.select("conv", "own", F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(heads)).alias("h"))
    convs = convs.withColumn("base", F.col("conv") - F.pmod("conv", F.lit(every)))
    first = convs.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    convs = spool(
        convs.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0).cast("bigint"))))
        .withColumn("turns", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    kept = ranked.join(convs.select("conv", "h", "taken"), "conv").where("nth > h")
    kept = kept.select("conv", (F.col("nth") - F.col("h") + F.col("taken")).alias("at"), "role", "digest", "chars")
    head = ranked.where((F.col("nth") < heads) & (F.pmod("conv", F.lit(every)) == 0))
    head = head.select(F.col("conv").alias("base"), "nth", "role", "digest", "chars")
    given = convs.where("taken > 0").select("conv", "base", "h").join(head, "base").where("nth <= h")
    given = given.select("conv", F.col("nth").alias("at"), "role", "digest", "chars")
    return kept.unionByName(given), convs.select("conv", "turns")


def lanes(at: str = "at") -> list[Column]:
    return [F.xxhash64(F.lit(k), at, "role", "digest").alias(f"x{k}") for k in (1, 2)]


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, chars): the node of each turn, and its parent."""
    hashed = turns.select("conv", "at", "chars", *lanes())
    both = {f"k{k}": (F.bit_xor(f"x{k}"), F.bit_xor, lambda a, b: a.bitwiseXOR(b)) for k in (1, 2)}
    found = running(hashed, [F.col("at")], both)
    parents = [F.col(f"k{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"p{k}") for k in (1, 2)]
    return found.select("conv", F.col("at").alias("depth"), "k1", "k2", *parents, "chars")


NODE = ["depth", "k1", "k2"]


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes at which conversations end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests():
            node, digest = None, None
            for *key, conv in row_stream(batches):
                if key == node:
                    digest.update(b",%d" % conv)
                    continue
                if node is not None:
                    yield *node, digest.hexdigest()
                node, digest = key, hashlib.sha256(b"%d" % conv)
            if node is not None:
                yield *node, digest.hexdigest()

        schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
        yield from arrow_batches(digests(), schema)

    ordered = ends.select(*NODE, "conv").repartition(*NODE).sortWithinPartitions(*NODE, "conv")
    return ordered.mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


FLOW = [*NODE, "p1", "p2", "own", "sends", "children", "leaves", "saved"]


def totals(nodes: DataFrame, memory: int) -> DataFrame:
    """Subtree totals of ``nodes`` (``FLOW`` columns), partition by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "n_children", "n_leaves", "saved_tokens"]
        yield from arrow_batches(time_forward(row_stream(batches), memory), pa.schema([(n, pa.int64()) for n in names]))

    ordered = nodes.sortWithinPartitions(F.col("depth").desc(), "k1", "k2")
    return ordered.select(*FLOW).mapInArrow(run, ", ".join(f"{n} bigint" for n in [*NODE, "n_children", "n_leaves", "saved_tokens"]))


def prefix_trie(conversations: DataFrame, parts: int = 1024, memory: int = 200_000) -> DataFrame:
    """The nodes of the trie, with the columns of the module's contract."""
    turns, convs = rebuilt_turns(conversations)
    rows = spool(prefixes(turns))
    n_convs = convs.count()
    zero = [F.lit(0).cast("bigint").alias(c) for c in (*NODE, "p1", "p2")]
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0")
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"),
    )
    nodes = spool(nodes.unionByName(root.select(*zero, "conv", "n", F.lit(0).cast("bigint").alias("chars"))))

    # the crown, and the subtrees that hang from it
    most = max(1, n_convs // parts)
    crown = (F.col("n") > most) | (F.col("depth") == 0)
    crowned = spool(nodes.where(crown))
    n_crowned = crowned.count()
    crown_keys = small_side(crowned.select(*NODE), n_crowned)
    hanging = rows.join(crown_keys, NODE, "left_anti").groupBy("conv").agg(F.min(F.struct(*NODE)).alias("top"))
    light = nodes.where(~crown).join(hanging, "conv").select("*", (F.col("depth") == F.col("top.depth")).alias("is_top"))
    light = spool(light)
    flow = light.select(
        "top", *NODE, "p1", "p2", ((F.col("n") - 1) * F.col("chars")).alias("own"), (~F.col("is_top")).alias("sends"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("children", "leaves", "saved")],
    )
    low = spool(totals(flow.repartition("top.k1", "top.k2"), memory))

    # across shard roots: what they send, summed by receiver, then the crown
    tops = light.where("is_top").select(*NODE, F.col("p1").alias("r1"), F.col("p2").alias("r2")).join(low, NODE)
    sent = tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("r1").alias("k1"), F.col("r2").alias("k2")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
    )
    none = F.lit(0).cast("bigint")
    high = crowned.join(sent, NODE, "left").select(
        *NODE, "p1", "p2", ((F.col("n") - 1) * F.col("chars")).alias("own"), (F.col("depth") > 0).alias("sends"),
        *[F.coalesce(c, none).alias(c) for c in ("children", "leaves", "saved")],
    )
    high = spool(totals(high.repartition(1), memory))

    # parents in the crown are few, others have few children
    crown_names = crowned.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    light_names = light.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    up = ["depth", "p1", "p2"]
    columns = [*NODE, "conv", "n", "parent"]
    named = [
        crowned.join(small_side(crown_names, n_crowned), up, "left").select(columns),
        light.where("is_top").join(small_side(crown_names, n_crowned), up).select(columns),
        light.where("not is_top").join(light_names, up).select(columns),
    ]
    every = named[0].unionByName(named[1]).unionByName(named[2])
    ended = rows.join(convs.where("turns > 0"), (rows["conv"] == convs["conv"]) & (rows["depth"] == convs["turns"])).select(*NODE, rows["conv"])
    ended = ended.unionByName(convs.where("turns = 0").select(*zero[:3], "conv"))
    return (
        every.join(low.unionByName(high), NODE).join(ends_digests(ended), NODE, "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
        )
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
