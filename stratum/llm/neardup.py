"""MinHash near-duplicates by an inverted join on bands of the signature.

Documents with equal shingle sets form a class; one member stands for it.  A
signature holds ``coordinates`` MinHash values.  Two sets with similarity ``percent``
agree in at least ``matches`` coordinates but for a chance of about 3e-7 at the
defaults and the very threshold (binomial tail), less above it.

Three coordinates make a band, ``coordinates / 2`` of them overlap, and a class is
posted under each band value that another class has too.  Two sets at the threshold
have no band in common with a chance of 3e-8 at the defaults, less above it.  Unlike
single values, three at once are seldom shared by chance, so lists grow with the
number of similar classes, not with the table.  Pairs of classes that agree in fewer
than ``matches`` coordinates are dropped; the others are verified on their full shingle sets.

Lists are not expanded into all pairs.  First every class of a list is compared
with one hub of it, the member whose values are the most frequent, and with one
other, chosen by hash; verified links are merged into components by distributed
union-find.  Classes with the same most central hub are a family.  Families and
lists whose members are all in one component are then done.  In an open family
signatures alone, one byte a coordinate, are compared in blocks of rows: members that
agree in ``matches`` coordinates with one of another component are joined into clusters,
and only the texts of a cluster meet, in blocks of bounded size that return spanning links.
Components are merged again, and pairs of classes of different families that share a list are
compared last.  Sets of too different sizes are never compared.  So no link between components is lost.

Defined results: null texts and texts without words have an empty set and are
linked with nothing; a text with fewer words than a shingle is one shingle;
repeated rows and rows with null doc_ids belong to their text's class, and a
component with null doc_ids only has a null component_id; an empty table gives an empty
result.  ``drop_near_duplicates`` keeps one row of each component, the one with the
smallest (doc_id, text hash), nulls last; of rows that repeat both, one stays.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import ASCII_LOWER, by_shuffle, connected_components, fresh_name, map_rows, read_table, small_side, spool

#: Multipliers are drawn from this seed; any other gives other signatures of equal quality.
SEED = 20_011
CHUNK = 4096
#: Coordinates in one number of a packed signature.
PACK = 7
#: Keys (two 64-bit numbers) are broadcast up to this count, about 10 MB; more are joined by a shuffle.
KEYS_LIMIT = 200_000
#: Shingles, and rows, whose texts meet in one verification group, from each of two blocks.
BLOCK_SHINGLES = 200_000
BLOCK_ROWS = 1_000
#: Rows whose signatures meet in one group, from each of two blocks.
SIGNATURE_ROWS = 4_096


def words_of(text: str | None) -> list[bytes]:
    """Runs of other than ASCII white space, A-Z lower-cased."""
    return text.encode().translate(ASCII_LOWER).split() if text else []


def shingle_numbers(texts: list[str], size: int) -> list[np.ndarray]:
    """The distinct shingles of each text, which has words, as sorted numbers; within
    a call they are equal just if the shingles are."""
    known: dict[bytes, int] = {}
    words = []
    for text in texts:
        numbers = [known.setdefault(w, len(known) + 1) for w in words_of(text)]
        words.append(np.array(numbers + [0] * (size - len(numbers)), np.int64))  # 0 is no word
    counts = [len(x) - size + 1 for x in words]
    code = np.concatenate([x[:n] for x, n in zip(words, counts)])
    for k in range(1, size):
        if k > 1:
            code = np.unique(code, return_inverse=True)[1]
        code = code * (len(known) + 1) + np.concatenate([x[k : k + n] for x, n in zip(words, counts)])
    return [np.unique(x) for x in np.split(code, np.cumsum(counts)[:-1])]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def make_signer(size: int, coordinates: int):
    """Text to (number of shingles, digest of the set, signature of 32-bit values)."""
    factors = np.random.default_rng(SEED).integers(1, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    known: dict[bytes, int] = {}

    def word_hash(word: bytes) -> int:
        h = known.get(word)
        if h is None:
            if len(known) >= 300_000:
                known.clear()
            h = known[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def sign(text: str | None) -> tuple[int, bytes | None, list[int] | None]:
        words = words_of(text)
        if not words:
            return 0, None, None
        h = np.fromiter(map(word_hash, words), np.uint64, len(words))
        k = min(size, len(words))
        shingles = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            shingles = mix(shingles + h[j : len(words) - k + 1 + j])
        shingles = np.unique(shingles)
        least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), CHUNK):
            product = shingles[at : at + CHUNK, None] * factors
            product ^= product >> np.uint64(32)
            product *= np.uint64(0xD6E8FEB86659FD93)
            np.minimum(least, product.min(0), out=least)
        return len(shingles), hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), (least >> np.uint64(33)).astype(np.int64).tolist()

    return sign


def sign_documents(docs: DataFrame, size: int, coordinates: int, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_shingles, digest (null for an empty set) and signature."""

    def make():
        sign = make_signer(size, coordinates)
        return lambda rows: [sign(x) for (x,) in rows]

    return map_rows(docs, make, ["text"], "n_shingles bigint, digest binary, signature array<int>", keep)


def band_keys(signature: str, coordinates: int) -> F.Column:
    """The values of the bands.  Two bands have one coordinate in common at most."""
    at = F.col(signature)
    return F.array(*[F.xxhash64(F.lit(k), at[k], at[k + 1], at[(k + 9) % coordinates]) for k in range(0, coordinates - 1, 2)])


def shared_postings(classes: DataFrame, coordinates: int) -> DataFrame:
    """(id, keys, weight): classes that share a band with another one, the keys of
    these bands, and the numbers of classes that have them, summed."""
    posted = classes.select("id", F.explode(band_keys("signature", coordinates)).alias("key"))
    often = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return posted.join(by_shuffle(often), "key").groupBy("id").agg(F.collect_list("key").alias("keys"), F.sum("n").alias("weight"))


def low_bytes(signature: str) -> F.Column:
    """Seven bits of each coordinate: agreement in them is necessary, and cheap to move."""
    return F.transform(signature, lambda x: x.bitwiseAND(127).cast("tinyint"))


def packed(signature: str, coordinates: int) -> F.Column:
    """The same seven bits, a byte each, seven bytes to a number."""
    bits = [F.col(signature)[k].bitwiseAND(127).cast("bigint") for k in range(coordinates)]
    groups = [bits[at : at + PACK] for at in range(0, coordinates, PACK)]
    return F.array(*[reduce(Column.bitwiseOR, [F.shiftleft(x, 8 * k) for k, x in enumerate(group)]) for group in groups])


def comparable(n: str, m: str, percent: int) -> F.Column:
    """Whether sets of these sizes can be similar enough (the length bound)."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def block_count(n: str) -> F.Column:
    """The number of verification blocks of a group with ``n`` shingles a row."""
    return F.greatest(F.ceil(F.sum(n) / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS)).cast("int")


def agreeing(a: str, b: str, coordinates: int) -> F.Column:
    """Number of equal coordinates of two packed signatures: adding 127 to a byte of
    seven bits sets its eighth just if it is not 0."""
    ones = sum(1 << 8 * k for k in range(PACK))
    unlike = [
        F.bit_count((F.col(a)[k].bitwiseXOR(F.col(b)[k]) + F.lit(127 * ones)).bitwiseAND(F.lit(128 * ones)))
        for k in range(-(-coordinates // PACK))
    ]
    return F.lit(coordinates) - reduce(Column.__add__, unlike)


def list_hubs(candidates: DataFrame) -> DataFrame:
    """(key, central, other) of the lists with several members: the member whose
    values are the most frequent, and one chosen by hash, with their set sizes ``n``."""
    lists = candidates.select("id", "weight", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    hubs = lists.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"),
        F.max(F.struct("weight", "id", "n")).alias("central"),
        F.max(F.struct(F.xxhash64("id", "key").alias("h"), "id", "n")).alias("other"),
    )
    return hubs.where("size > 1").select("key", "central", "other")


def verify_blocks(candidates: DataFrame, hubs: DataFrame) -> DataFrame:
    """(id, n, family, blocks, block): classes with the same most central hub are a
    family, and are verified together in blocks of about ``BLOCK_SHINGLES`` shingles, or
    ``BLOCK_ROWS`` rows."""
    posted = candidates.select("id", F.col("n_shingles").alias("n"), F.explode("keys").alias("key")).join(by_shuffle(hubs), "key")
    family = posted.groupBy("id", "n").agg(F.max("central")["id"].alias("family"))
    sizes = family.groupBy("family").agg(block_count("n").alias("blocks"))
    placed = family.join(sizes, "family")
    return placed.select("id", "n", "family", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))


def verify(pairs: DataFrame, blocks: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar enough.
    Pairs are grouped by their two blocks, and each text is sent to a group once."""
    where = F.xxhash64("family", "block")
    placed = (
        pairs.join(by_shuffle(blocks.select(F.col("id").alias("a"), F.col("n").alias("na"), where.alias("x"))), "a")
        .join(by_shuffle(blocks.select(F.col("id").alias("b"), F.col("n").alias("nb"), where.alias("y"))), "b")
        .where(comparable("na", "nb", percent))
        .select("a", "b", F.least("x", "y").alias("g1"), F.greatest("x", "y").alias("g2"))
    )
    placed = spool(placed)
    members = placed.select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), F.explode(F.array("a", "b")).alias("id")).distinct()
    sent = members.join(by_shuffle(texts.select("id", "text")), "id").select("h1", "h2", "id", "text")

    def confirm(pairs: pa.Table, sent: pa.Table) -> pa.Table:
        if not sent.num_rows:
            return pairs.select(["a", "b"]).slice(0, 0)
        sets = dict(zip(sent.column("id").to_pylist(), shingle_numbers(sent.column("text").to_pylist(), size)))
        linked = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            s, t = sets[a], sets[b]
            both = len(np.intersect1d(s, t, assume_unique=True))
            linked.append(100 * both >= percent * (len(s) + len(t) - both))
        return pairs.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return placed.groupBy("g1", "g2").cogroup(sent.groupBy("h1", "h2")).applyInArrow(confirm, "a bigint, b bigint")


def star_pairs(candidates: DataFrame, hubs: DataFrame, coordinates: int, matches: int, percent: int) -> DataFrame:
    """Each class with the hubs of its lists, where sizes and signatures agree."""
    lists = candidates.select("id", "n_shingles", F.explode("keys").alias("key"))
    each = F.array_distinct(F.array(*[F.struct(F.col(f"{c}.id").alias("id"), F.col(f"{c}.n").alias("n")) for c in ("central", "other")]))
    hubs = hubs.select("key", F.explode(each).alias("hub"))
    pairs = lists.join(by_shuffle(hubs), "key").where((F.col("id") != F.col("hub.id")) & comparable("n_shingles", "hub.n", percent))
    pairs = pairs.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b"))
    signed = by_shuffle(candidates.select("id", packed("signature", coordinates).alias("signature")))
    return (
        pairs.distinct()
        .join(signed.withColumnsRenamed({"id": "a", "signature": "sa"}), "a")
        .join(signed.withColumnsRenamed({"id": "b", "signature": "sb"}), "b")
        .where(agreeing("sa", "sb", coordinates) >= matches).select("a", "b")
    )


def open_groups(member: DataFrame, group: str) -> DataFrame:
    """(``group``, largest, m, n): the groups with several components, their largest
    component, and their numbers of rows and shingles."""
    sizes = member.groupBy(group, "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    groups = sizes.groupBy(group).agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("m", "component")).alias("most"), F.sum("m").alias("m"), F.sum("n").alias("n"))
    return groups.where("parts > 1").select(group, F.col("most.component").alias("largest"), "m", "n")


def block_pairs(here: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """The members outside a group's largest component (``left``), and all its members,
    for each pair (i, j) of blocks in which they meet."""
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = here.where("component <> largest").select(group, F.col("block").alias("i"), each.alias("j"), F.lit(True).alias("left"), *columns)
    right = here.select(group, each.alias("i"), F.col("block").alias("j"), F.lit(False).alias("left"), *columns)
    right = right.join(by_shuffle(left.select(group, "i", "j").distinct()), [group, "i", "j"], "left_semi")
    return left.union(right.select(left.columns))


def in_blocks(member: DataFrame, groups: DataFrame, group: str, blocks: F.Column) -> DataFrame:
    here = member.join(groups.select(group, "largest", blocks.cast("int").alias("blocks")), group)
    return here.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))


class Forest:
    """Union-find over any hashable nodes."""

    def __init__(self):
        self.head: dict = {}

    def find(self, x):
        while self.head.setdefault(x, x) != x:
            self.head[x] = self.head[self.head[x]]
            x = self.head[x]
        return x

    def join(self, x, y) -> bool:
        """Whether they were apart."""
        x, y = self.find(x), self.find(y)
        self.head[max(x, y)] = min(x, y)
        return x != y


def cluster_edges(member: DataFrame, percent: int, matches: int) -> DataFrame:
    """Edges (a, b) that join the members of a family which may be linked to one of another
    component: set sizes are comparable and signatures agree.  Texts are not read, and a
    group returns a star for each set of members that it joins."""
    groups = spool(open_groups(member, "family"))
    here = in_blocks(member, groups, "family", F.ceil(F.col("m") / SIGNATURE_ROWS))
    here = spool(here.select("family", "id", "component", "n", "largest", "blocks", "block", low_bytes("signature").alias("signature")))
    sent = block_pairs(here, "family", ["id", "component", "n", "signature"])

    def near(group: pa.Table) -> pa.Table:
        ids, component, n = (group.column(c).to_numpy() for c in ("id", "component", "n"))
        signature = group.column("signature").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        ours = group.column("left").to_numpy()
        theirs = np.flatnonzero(~ours)
        known, at = np.unique(ids, return_inverse=True)
        tree = np.arange(len(known))  # which members are joined so far
        for k in np.flatnonzero(ours):
            some = theirs[(component[theirs] != component[k]) & (100 * np.minimum(n[theirs], n[k]) >= percent * np.maximum(n[theirs], n[k]))]
            found = at[some[(signature[some] == signature[k]).sum(1) >= matches]]
            for other in np.unique(tree[found]).tolist():
                if other != tree[at[k]]:
                    tree[tree == other] = tree[at[k]]
        _, root, tree = np.unique(tree, return_index=True, return_inverse=True)
        root = known[root][tree]  # the smallest member: as a star, a tree needs no further rounds
        joined = root != known
        return pa.table({"a": pa.array(root[joined], pa.int64()), "b": pa.array(known[joined], pa.int64())})

    return sent.groupBy("family", "i", "j").applyInArrow(near, "a bigint, b bigint")


def family_links(member: DataFrame, texts: DataFrame, size: int, percent: int, matches: int) -> DataFrame:
    """Links between components of one family.  Within the clusters of ``cluster_edges``,
    the members outside the largest component are compared with all others, block by
    block: each group counts common shingles by an inverted index and returns no more
    links than it takes to join what is linked."""
    clusters = connected_components(spool(cluster_edges(member, percent, matches)))
    clustered = spool(member.join(clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "id")
                      .select("id", "component", "n", "cluster"))
    groups = spool(open_groups(clustered, "cluster"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_SHINGLES), F.ceil(F.col("m") / BLOCK_ROWS))
    here = spool(in_blocks(clustered, groups, "cluster", blocks))
    sent = block_pairs(here, "cluster", ["id", "component"]).join(by_shuffle(texts.select("id", "text")), "id")

    def link(group: pa.Table) -> pa.Table:
        ids, component, left = (group.column(c).to_numpy() for c in ("id", "component", "left"))
        sets = shingle_numbers(group.column("text").to_pylist(), size)
        ours, theirs = np.flatnonzero(left), np.flatnonzero(~left)
        if not len(ours) or not len(theirs):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        n_ours = np.array([len(sets[k]) for k in ours])
        shingles, owner = np.concatenate([sets[k] for k in ours]), np.repeat(np.arange(len(ours)), n_ours)
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        forest, links = Forest(), []
        for r in theirs.tolist():
            first, last = np.searchsorted(shingles, sets[r], "left"), np.searchsorted(shingles, sets[r], "right")
            lists = [owner[x:y] for x, y in zip(first.tolist(), last.tolist()) if x < y]
            if not lists:
                continue
            both = np.bincount(np.concatenate(lists), minlength=len(ours))
            for k in ours[100 * both >= percent * (n_ours + len(sets[r]) - both)].tolist():
                if forest.join(int(component[k]), int(component[r])):
                    links.append((int(ids[k]), int(ids[r])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return sent.select("cluster", "i", "j", "id", "component", "left", "text").groupBy("cluster", "i", "j").applyInArrow(link, "a bigint, b bigint")


def crossing_pairs(member: DataFrame, coordinates: int, matches: int, percent: int) -> DataFrame:
    """The pairs of classes of different families and components that have a posting
    in common and whose sizes and signatures agree."""
    posted = member.select("id", "component", "family", F.explode("keys").alias("key"))
    lists = posted.groupBy("key").agg(
        F.min("family").alias("f1"), F.max("family").alias("f2"), F.min("component").alias("c1"), F.max("component").alias("c2"),
    ).where("f1 <> f2 and c1 <> c2").select("key")
    b = member.select("id", "component", "family", "n", packed("signature", coordinates).alias("signature"), F.explode("keys").alias("key"))
    b = spool(b.join(by_shuffle(lists), "key"))
    a = b.select(*[F.col(c).alias(f"a_{c}") for c in ("key", "id", "signature", "component", "family", "n")])
    found = a.join(
        by_shuffle(b), (F.col("a_key") == F.col("key")) & (F.col("a_id") < F.col("id")) & (F.col("a_family") != F.col("family"))
        & (F.col("a_component") != F.col("component")) & comparable("a_n", "n", percent) & (agreeing("a_signature", "signature", coordinates) >= matches),
    )
    return found.select(F.col("a_id").alias("a"), F.col("id").alias("b")).distinct()


def similar_classes(classes: DataFrame, texts: DataFrame, size: int, percent: int, coordinates: int, matches: int) -> DataFrame | None:
    """(node, component) for the classes that are linked to another one, or None.
    ``classes`` has id, n_shingles, signature and the doc_id and text hash of a
    member, by which ``texts`` has its text, and the number of rows with these."""
    candidates = spool(shared_postings(classes, coordinates).join(by_shuffle(classes), "id"))
    n = candidates.count()
    if not n:
        return None
    wanted = candidates.select("id", F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "rows")
    repeated = not wanted.where("rows > 1").isEmpty()
    texts = texts.join(small_side(wanted, n, KEYS_LIMIT), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    texts = texts.select("id", "text")
    texts = spool(texts.dropDuplicates(["id"]) if repeated else texts)
    hubs = spool(list_hubs(candidates))
    blocks = spool(verify_blocks(candidates, hubs))
    links = spool(verify(star_pairs(candidates, hubs, coordinates, matches, percent), blocks, texts, size, percent))
    placed = spool(candidates.select("id", "signature", "keys").join(blocks.select("id", "n", "family"), "id"))

    def members(parts: DataFrame) -> DataFrame:
        return spool(placed.join(parts, F.col("id") == F.col("node"), "left").select(*placed.columns, F.coalesce("component", "id").alias("component")))

    def merged(parts: DataFrame, more: DataFrame) -> DataFrame:
        if more.isEmpty():
            return parts
        return spool(connected_components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)))

    parts = spool(connected_components(links))
    parts = merged(parts, spool(family_links(members(parts), texts, size, percent, matches)))
    across = verify(crossing_pairs(members(parts), coordinates, matches, percent), blocks, texts, size, percent)
    return merged(parts, spool(across))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, coordinates: int = 64, matches: int = 34) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (a number; null for an empty set)
    and component_id, one row a document."""
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    signed = spool(sign_documents(named, size, coordinates, ["doc_id", "text_hash"]))
    member = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "rows")
    classes = spool(
        signed.where("digest is not null").groupBy("digest", "doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature"))
        .groupBy("digest").agg(F.min(member).alias("m"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature"))
        .select(F.monotonically_increasing_id().alias("id"), "digest", "n_shingles", "signature", "m.doc_id", "m.text_hash", "m.rows")
    )
    found = similar_classes(classes.drop("digest"), named, size, percent, coordinates, matches)
    parts = classes.select("id", "digest", "doc_id")
    if found is None:
        parts = parts.select("digest", F.col("id").alias("component"), F.col("doc_id").alias("component_id"))
    else:
        parts = parts.join(found, F.col("id") == F.col("node"), "left").select("digest", "doc_id", F.coalesce("component", "id").alias("component"))
        smallest = parts.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        parts = parts.join(smallest, "component").select("digest", "component", "component_id")
    rows = signed.select("doc_id", "text_hash", "n_shingles", "digest").join(parts, "digest", "left")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "text_hash", "n_shingles", "component", own.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """One row of each component and all rows without words, with the input's
    columns.  Only the keys of dropped rows are joined with the texts."""
    groups = spool(
        near_duplicates(docs, **params).where("component is not null")
        .groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    keepers = groups.groupBy("component").agg(first.alias("m"))
    judged = groups.join(keepers, "component").select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "n",
        (F.col("doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("text_hash") == F.col("m.text_hash"))).alias("kept"),
    )
    judged = spool(judged.where("not kept or n > 1"))
    hashed, d, h = (fresh_name(x, docs.columns) for x in ("hash", "kept_id", "kept_hash"))
    docs_hashed = docs.withColumn(hashed, F.xxhash64("text"))

    def among(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        keys = small_side(keys.select(F.col("d").alias(d), F.col("h").alias(h)), keys.count(), KEYS_LIMIT)
        return rows.join(keys, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(hashed) == F.col(h)), how)

    left = among(judged.where("not kept"), "left_anti", docs_hashed)
    repeated = judged.where("kept")
    if not repeated.isEmpty():
        once = among(repeated, "left_semi", left).dropDuplicates(["doc_id", "text"])
        left = among(repeated, "left_anti", left).union(once)
    return left.drop(hashed)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
