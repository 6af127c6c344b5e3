"""Scan of JSON arrays by many tasks, however large a file is and without line breaks.

A plain ``multiLine`` scan gives a whole file to one task.  Here a file is read as text
whose lines end in ``}``, which Spark splits into byte ranges like any other text; only where a
record begins depends on what stands before the range.  That is found as a prefix sum:

1. Each range is scanned once for both possible beginnings, outside and inside a string.
   The result is a transition function: for each beginning, whether the range ends
   inside a string, and by how much the depth changes.  (A backslash cannot be pending at the
   beginning: the character before a range is a ``}``.)
2. Transition functions compose.  Those of a file, one small row a range, are
   composed in order and give the state in which each range really begins.
3. With it each range is cut where the depth returns to that of the array.  Whole
   records are parsed where they are; what a range holds of a record that reaches over its ends is
   a fragment, at most two a range, and fragments of a record are put together by one aggregate.

Texts are not shuffled, apart from fragments.  The states are broadcast after they were
counted; where they are too many, texts are joined with them by a sorted shuffle.

Defined results: for arrays of objects the rows are those of the ``multiLine`` scan.
Files that are something else (an object, a truncated or unbalanced array, no JSON) are read by
that scan.  A record broken inside, with its brackets balanced, is one row of NULLs and
leaves the others alone (the ``multiLine`` scan gives one such row for the whole file); so is
an element that is no object, together with the object after it.  Empty files and empty arrays
have no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.errors import ReadError
from stratum.session import scratch_table
from stratum.sources.inventory import only_files

#: States of ranges are broadcast up to this count (a path and three numbers each).
RANGES_LIMIT = 200_000
BLANK = " \t\r\n"
#: A string, to its end or to the end of the text.
STRING = re.compile(r'"(?:[^"\\]++|\\.)*+("|\\?\Z)', re.DOTALL)
REST_OF_STRING = re.compile(r'(?:[^"\\]++|\\.)*+"', re.DOTALL)

RANGE_DDL = "file string, start bigint, first string, in0 boolean, by0 bigint, in1 boolean, by1 bigint"
STATE_DDL = "file string, start bigint, inside boolean, depth bigint, good boolean"


def step(piece: str, inside: bool) -> tuple[bool, int]:
    """Whether ``piece + "}"`` ends inside a string, and its change of depth."""
    if inside:
        rest = REST_OF_STRING.match(piece)
        if rest is None:
            return True, 0
        piece = piece[rest.end():]
    bare = STRING.sub(r'"\1', piece)  # two quotes for a whole string, one for an open one
    by = bare.count("{") + bare.count("[") - bare.count("]")
    inside = bare.count('"') % 2 == 1
    return inside, by if inside else by - 1


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: its transition function, and how it begins."""
    key, row = None, None

    def out() -> pa.RecordBatch:
        names = ["file", "start", "first", "in0", "by0", "in1", "by1"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([*key, *row], kinds)], names=names)

    for batch in batches:
        for file, start, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, start) != key:
                if key is not None:
                    yield out()
                begin = "".join(piece.lstrip("﻿" + BLANK).split()[:2])[:2] if start == 0 else None
                key, row = (file, start), [begin, False, 0, True, 0]
            for k in (1, 3):
                row[k], by = step(piece, row[k])
                row[k + 1] += by
    if key is not None:
        yield out()


def _compose(ranges):
    """The state at the beginning of each range of one file."""
    import pandas as pd

    inside, depth, found = False, 0, []
    ranges = ranges.sort_values("start")
    for r in ranges.itertuples():
        found.append((r.file, r.start, inside, depth))
        inside, by = (r.in1, r.by1) if inside else (r.in0, r.by0)
        depth += by
    # the last piece of an array is its closing bracket, to which step() adds a brace
    good = ranges["first"].iloc[0] in ("[{", "[]") and not inside and depth == -1
    return pd.DataFrame([(*f, good) for f in found], columns=["file", "start", "inside", "depth", "good"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, kind, text): whole records (kind 0), the end of a record that began in an
    earlier range (1), a range inside a record (2), the beginning of a record (3)."""
    key, state, held, whole = None, None, [], True

    def trimmed(text: str, depth: int) -> str:
        text = text.lstrip(BLANK + "," + "﻿")
        return text[1:].lstrip(BLANK) if depth == 0 else text

    def table(rows: list) -> pa.RecordBatch:
        kinds = {"file": pa.string(), "start": pa.int64(), "kind": pa.int32(), "text": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))

    def left_over() -> list:
        text = "".join(held)
        if whole:
            text = trimmed(text, begun)
            return [] if text.strip(BLANK + "]}") == "" else [(*key, 3, text)]
        return [(*key, 2, text)] if text else []

    begun = 0  # the depth where the held text begins
    for batch in batches:
        rows = []
        for file, start, piece, inside, depth in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, start) != key:
                if key is not None:
                    rows += left_over()
                if depth is None:
                    raise ReadError(f"No state of the range of {file} that begins at {start}: the split size was changed after the scan was made")
                key, state, held, whole, begun = (file, start), (inside, depth), [], depth <= 1 and not inside, depth
            held.append(piece + "}")
            inside, by = step(piece, state[0])
            state = inside, state[1] + by
            if not inside and state[1] == 1:
                text = "".join(held)
                rows.append((*key, 0, trimmed(text, begun)) if whole else (*key, 1, text))
                held, whole, begun = [], True, 1
        if rows:
            yield table(rows)
    if key is not None and (rows := left_over()):
        yield table(rows)


def read_json_arrays(spark: SparkSession, source_path: str, schema: StructType | str,
                     files_to_include: Iterable[str] | DataFrame | None = None, options: dict | None = None,
                     source_file_column: str | None = None) -> DataFrame:
    """The records of the JSON arrays under ``source_path``, each file read by many tasks.

    ``options`` go to the file source (``recursiveFileLookup``, ``pathGlobFilter``) and to the
    parser (``timestampFormat`` and so on).  ``source_file_column`` adds each row's file.
    The first pass over the texts is made at once, the other two when the rows are asked for.
    """
    options = dict(options or {})
    try:
        text = spark.read.options(**options).option("lineSep", "}").text(source_path)
    except Exception as exc:  # noqa: BLE001 - missing path, unreadable folder, ...
        raise ReadError(f"Failed to read source '{source_path}': {exc}") from exc
    pieces = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    if files_to_include is not None:
        pieces = only_files(pieces, files_to_include, "file")
    ranges = pieces.mapInArrow(_ranges, RANGE_DDL)
    states = scratch_table(ranges.groupBy("file").applyInPandas(_compose, STATE_DDL))
    others = [r[0] for r in states.where("not good").select("file").distinct().toLocalIterator()]

    known = states.select(F.col("file").alias("of"), F.col("start").alias("at"), "inside", "depth", "good")
    here = (F.col("file") == F.col("of")) & (F.col("start") == F.col("at"))
    if states.limit(RANGES_LIMIT + 1).count() <= RANGES_LIMIT:
        joined = pieces.join(F.broadcast(known), here, "left")
    else:
        numbered = pieces.withColumn("n", F.monotonically_increasing_id())
        joined = numbered.join(known, here, "left").repartition("file", "start").sortWithinPartitions("file", "start", "n")
    joined = joined.where(F.coalesce("good", F.lit(True))).select("file", "start", "value", "inside", "depth")
    cut = joined.mapInArrow(_cut, "file string, start bigint, kind int, text string")

    order = Window.partitionBy("file").orderBy("start", "kind")
    fragments = cut.where("kind > 0").withColumn("record", F.count_if(F.col("kind") == 3).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))  # one record
    joined_up = fragments.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    records = cut.where("kind = 0").select("file", "text").unionAll(joined_up.select("file", "text"))
    parsed = records.select("file", F.from_json("text", schema, {k: str(v) for k, v in options.items()}).alias("r"))
    tag = [F.col("file").alias(source_file_column)] if source_file_column else []
    found = parsed.select("r.*", *tag)
    if not others:
        return found
    plain = spark.read.schema(schema).options(**options).option("multiLine", True).json(source_path)
    plain = only_files(plain.select("*", F.col("_metadata.file_path").alias("__file")), others, "__file")
    plain = plain.withColumnRenamed("__file", source_file_column) if source_file_column else plain.drop("__file")
    return found.unionAll(plain)
