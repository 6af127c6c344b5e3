"""History of changes (slowly changing rows, type 2) with late and partial changes.

A history holds every change of a key: when it took effect, which columns it set, and
the values that hold from then on.  Changes may come late and in any order: applying
batches one after the other, in whatever order, gives the same history as applying
all changes at once.  Only keys that occur in a batch are rewritten.

* A change sets the columns named in its ``set`` array (all, if there is none), also to
  NULL; the others keep the value of the change before it.  A late change therefore shows
  through later ones up to the next that sets the same column.
* A deletion ends the interval; a change after it starts from NULLs.
* Changes of one key with the same time are ordered by ``seq``.  The same (key, time, seq)
  again is a redelivery and replaces what it repeats; two different ones in one batch
  are ambiguous and fail, as in a merge.

The changes of one key are a sorted stream in one task, which spills; keys are spread
by hash over a number of tasks that grows with the counted rows, and all steps of a key
are done where it lies.  Unaffected keys pass through by an anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARKS = ["valid_from", "seq", "valid_to", "deleted", "set", "change"]
#: Rows that one task sorts, about.
TASK_ROWS = 100_000


def _spread(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` by keys in as many tasks as ``rows`` need (no fewer than the session's shuffle partitions)."""
    if rows <= TASK_ROWS:
        return df
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)), *keys)


def _events(changes: DataFrame, keys: Sequence[str], values: Sequence[str], at: str, seq: str,
            set_column: str | None, delete_flag: str | None) -> DataFrame:
    every = F.array(*[F.lit(v) for v in values])
    chosen = every if set_column is None else F.coalesce(F.col(set_column), every)
    deleted = F.lit(False) if delete_flag is None else F.coalesce(F.col(delete_flag), F.lit(False))
    found = changes.select(
        *keys, F.col(at).alias("valid_from"), F.col(seq).cast("bigint").alias("seq"), deleted.alias("deleted"),
        F.when(deleted, F.array().cast("array<string>")).otherwise(F.array_sort(F.array_intersect(chosen, every))).alias("set"),
        F.struct(*values).alias("change"),
    ).distinct()
    place = [*keys, "valid_from", "seq"]
    row = F.struct("deleted", "set", "change")
    single = found.groupBy(*place).agg(F.any_value(row).alias("row"), F.count(F.lit(1)).alias("n"))
    message = F.concat(F.lit("several changes for "), F.to_json(F.struct(*place)))
    single = single.withColumn("row", F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(message)))
    return single.select(*place, "row.deleted", "row.set", "row.change")


def _resolve(events: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The values that hold after each event, and where its interval ends."""
    ordered = Window.partitionBy(*keys).orderBy("valid_from", "seq")
    upto = ordered.rowsBetween(Window.unboundedPreceding, -1)
    lives = events.withColumn("__life", F.coalesce(F.sum(F.col("deleted").cast("int")).over(upto), F.lit(0)))
    here = Window.partitionBy(*keys, "__life").orderBy("valid_from", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def held(v: str) -> Column:
        given = F.when(F.array_contains("set", v), F.struct(F.col(f"change.{v}").alias("v")))
        return F.when(~F.col("deleted"), F.last(given, ignorenulls=True).over(here)["v"]).alias(v)

    return lives.select(
        *keys, *[held(v) for v in values], "valid_from", "seq", F.lead("valid_from").over(ordered).alias("valid_to"),
        "deleted", "set", "change")


def apply_changes(history: DataFrame | None, changes: DataFrame, keys: Sequence[str], values: Sequence[str],
                  at: str, seq: str, set_column: str | None = None, delete_flag: str | None = None) -> DataFrame:
    """The history with a batch of changes spliced in (see the module docstring).

    ``history`` is an earlier result, or None for a new one; both tables are counted here.  Rows with a NULL key or a NULL
    time are no changes and are left out."""
    complete = F.col(at).isNotNull()
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    changes = changes.filter(complete)
    rows = changes.count() + (0 if history is None else history.count())
    incoming = _events(_spread(changes, keys, rows), keys, values, at, seq, set_column, delete_flag)
    if history is None:
        return _resolve(incoming, keys, values)
    touched = incoming.select(*keys).distinct()
    history = _spread(history, keys, rows)
    old = history.select(*keys, "valid_from", "seq", "deleted", "set", "change").join(touched, list(keys), "left_semi")
    both = incoming.withColumn("__new", F.lit(True)).unionByName(old.withColumn("__new", F.lit(False)))
    # by keys again: a union does not keep where its sides lie
    both = _spread(both, keys, rows).groupBy(*keys, "valid_from", "seq").agg(
        F.max_by(F.struct("deleted", "set", "change"), "__new").alias("row"))
    spliced = _resolve(both.select(*keys, "valid_from", "seq", "row.deleted", "row.set", "row.change"), keys, values)
    return history.join(touched, list(keys), "left_anti").select(*spliced.columns).unionByName(spliced)


def intervals(history: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The rows that held for some time: ``keys``, ``values``, valid_from, valid_to (NULL: until
    now).  Neighbours with equal values are one; there are none where a key was deleted."""
    history = _spread(history, keys, history.count())
    shown = history.filter(~F.col("deleted") & (F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))))
    ordered = Window.partitionBy(*keys).orderBy("valid_from")
    before = F.lag(F.struct("valid_to", *values)).over(ordered)
    same = before.isNotNull() & before["valid_to"].eqNullSafe(F.col("valid_from"))
    for v in values:
        same = same & before[v].eqNullSafe(F.col(v))
    marked = shown.withColumn("__new", (~same).cast("int"))
    grouped = marked.withColumn("__part", F.sum("__new").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.max(F.struct("valid_from", "valid_to"))["valid_to"].alias("valid_to")
    return grouped.groupBy(*keys, "__part").agg(
        *[F.any_value(v).alias(v) for v in values], F.min("valid_from").alias("valid_from"), last).drop("__part")


def as_of(history: DataFrame, when: Column) -> DataFrame:
    """The rows of a history (or of its intervals) that hold at a time."""
    live = ~F.col("deleted") if "deleted" in history.columns else F.lit(True)
    return history.filter(live & (F.col("valid_from") <= when) & (F.col("valid_to").isNull() | (when < F.col("valid_to"))))
