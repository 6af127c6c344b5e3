"""Helpers shared by the operators: reading tables, shared-folder tables that cut
lineage, joins with a checked broadcast, and distributed connected components."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import scratch_table as spool

#: A table is broadcast only if it was counted and holds at most this many rows.
BROADCAST_ROWS = 20_000

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_side(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within ``limit``;
    beyond it, plain (a shuffle join whose skewed partitions AQE splits).
    ``df`` must be cheap to count: a spooled table."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= limit else df


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` with a hint that joins it by a sorted shuffle.  Spark takes the rows of an
    exploded list for one row, and a list for one element, so it may choose to broadcast
    such a table however large it is; a broadcast once planned is not taken back when the
    sizes are known.  For tables made by an explode, or that hold lists."""
    return df.hint("merge")


def fresh_name(base: str, taken: list[str]) -> str:
    """A column name that no input column has (names compare without case)."""
    lower = {c.lower() for c in taken}
    name = f"__{base}"
    while name.lower() in lower:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without input columns that clash with result columns."""
    drop = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[list], list[tuple]]],
    inputs: list[str],
    schema: str,
    keep: list[str] | None = None,
    chunk_bytes: int = 8 << 20,
) -> DataFrame:
    """One output row per input row, computed from the ``inputs`` columns in
    Arrow batches.  ``make()`` runs once per task and returns a function that
    takes a list of input tuples and returns a list of output tuples;
    it sees at most about ``chunk_bytes`` of text at once.  ``keep`` columns
    are passed through untouched, before the new ones."""
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = keep or []
    new: StructType = _parse_datatype_string(schema)
    out = StructType([df.schema[c] for c in keep] + list(new.fields))
    names, new_names = list(inputs), [f.name for f in new.fields]
    cols = list(dict.fromkeys([*keep, *inputs]))
    position = {c: i for i, c in enumerate(cols)}
    arrow_new = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            step = max(1, batch.num_rows * chunk_bytes // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows = list(zip(*[part.column(position[c]).to_pylist() for c in names]))
                done = work(rows)
                columns = list(zip(*done)) if done else [[] for _ in new_names]
                arrays = [part.column(position[c]) for c in keep]
                arrays += [pa.array(v, type=f.type) for v, f in zip(columns, arrow_new)]
                yield pa.RecordBatch.from_arrays(arrays, names=keep + new_names)

    return df.select(*[F.col(f"`{c}`") for c in cols]).mapInArrow(run, out)


def share(spark: SparkSession, value) -> Callable:
    """Broadcast an object of bounded size; the returned function gives it back in
    a task.  Its classes travel with it, as this package's functions do."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b, any orderable
    type): the component is its smallest node.  Alternates large-star and
    small-star (Kiveris et al., 2014) until the edge set is a set of stars; each
    round is two shuffles over at most the given number of edges, and its result
    is written to the shared folder."""
    e = spool(
        edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .where("u is not null and v is not null and u < v").distinct()
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())

    before = mark(e)
    while before[0]:
        both = e.select("v", "u").union(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("m", "v").alias("m"))
        large = (
            both.where("u > v").join(least, "v")
            .select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v").distinct()
        )
        large = spool(large)
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        e = spool(
            joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .union(least.select("v", F.col("m").alias("u"))).distinct()
        )
        after = mark(e)
        if after == before:
            break
        before = after
    stars = e.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
