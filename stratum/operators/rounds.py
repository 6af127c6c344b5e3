"""Standings after every round of a season, with countback.

After each round all members seen so far are ranked by their points up to then;
equal points are told apart by the number of first places, then of second ones,
and so on (countback).  Members equal in all of that share a position.

1. Results become one row per (season, round, member): points, and a histogram of the
   positions reached, in one hash aggregate (map-side partial).
2. Running sums over a member's rounds give its state (points, histogram).  A state
   holds from its round until the member's next one, so it is kept as an interval; the
   window is partitioned by (season, member) and holds at most a row a round.
3. Intervals meet the season's rounds they cover in one equi-join on the season.  The
   rounds are a small table (seasons x rounds), broadcast after they were counted.  The result has a
   row per member and round, as its meaning demands; nothing larger is made.
4. Ranks come from :func:`stratum.operators.ranking.rank_desc` over the pair (points,
   histogram), whose order is the countback.

The result carries the state of every member, so it can be carried on:
:func:`update_round_standings` takes the changed rounds and computes anew, for
each season, from the first of them.  Earlier rounds are kept as they are, and their
results are not read.

Defined results: null points count as 0; positions that are null, below 1 or above
``places`` score points only; rows without season, round or member are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.ranking import rank_desc

#: A table of rounds up to this size is broadcast (two numbers a row).
ROUNDS_LIMIT = 500_000
COLUMNS = ("season", "round", "member", "points", "places", "position")


def _small(rows: DataFrame) -> DataFrame:
    """``rows`` marked for broadcast if there are few of them."""
    few = rows.limit(ROUNDS_LIMIT + 1).count() <= ROUNDS_LIMIT
    return F.broadcast(rows) if few else rows


def round_results(results: DataFrame, season: Column, round: Column, member: Column, points: Column,
                  position: Column, places: int) -> DataFrame:
    """``season, round, member, points, places``: what each member won in each round;
    ``places[k]`` is how often it came in at position k + 1."""
    named = results.select(season.alias("season"), round.alias("round"), member.alias("member"),
                           points.alias("points"), position.alias("position"))
    named = named.where("season is not null and round is not null and member is not null")
    counts = [F.count_if(F.col("position") == k + 1) for k in range(places)]
    return named.groupBy("season", "round", "member").agg(
        F.coalesce(F.sum("points"), F.lit(0).cast(named.schema["points"].dataType)).alias("points"),
        F.array(*counts).alias("places"))


def _intervals(won: DataFrame, places: int) -> DataFrame:
    """Each member's state (points, places) and the rounds ``[from, until)`` it holds."""
    rounds = Window.partitionBy("season", "member").orderBy("round")
    upto = rounds.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(F.col("places")[k]).over(upto) for k in range(places)]
    return won.select(
        "season", "member", F.col("round").alias("from"), F.lead("round").over(rounds).alias("until"),
        F.sum("points").over(upto).alias("points"), F.array(*sums).alias("places"))


def _ranked(states: DataFrame, rounds: DataFrame, method: str) -> DataFrame:
    calendar = _small(rounds).withColumnRenamed("season", "of")
    covered = (F.col("round") >= F.col("from")) & (F.col("until").isNull() | (F.col("round") < F.col("until")))
    rows = states.join(calendar, (F.col("season") == F.col("of")) & covered).select(
        "season", "round", "member", F.struct("points", "places").alias("__state"))
    ranked = rank_desc(rows, ["season", "round"], "__state", rank_col="position", method=method)
    return ranked.select("season", "round", "member", "__state.points", "__state.places", "position")


def round_standings(won: DataFrame, places: int, method: str = "auto") -> DataFrame:
    """``season, round, member, points, places, position`` for every round of a season and
    every member seen until then.  ``won`` is made by :func:`round_results`."""
    return _ranked(_intervals(won, places), won.select("season", "round").distinct(), method)


def first_changes(changed: DataFrame) -> DataFrame:
    """``season, first``: the first round of each season with a changed result."""
    return changed.where("season is not null and round is not null").groupBy("season").agg(F.min("round").alias("first"))


def update_round_standings(before: DataFrame, won: DataFrame, first: DataFrame, places: int,
                           method: str = "auto") -> DataFrame:
    """The standings ``before`` brought up to date after results of some rounds changed.

    ``first`` (season, first) is the earliest changed round of each season (see
    :func:`first_changes`); other seasons stay.  ``won`` has all results as
    they are now; of these only rounds from ``first`` on are used.  The state of the last round
    before it stands for all earlier results.  ``before`` is read twice, so it should be
    a table.
    """
    start = _small(first).withColumnsRenamed({"season": "of", "first": "start"})
    since = F.col("season") == F.col("of")
    kept = before.join(start, since, "left").where("start is null or round < start").select(*COLUMNS)
    later = won.join(start, since).where("round >= start").select("season", "round", "member", "points", "places")
    earlier = before.join(start, since).where("round < start")
    last = _small(earlier.groupBy("season").agg(F.max("round").alias("until")).select(
        F.col("season").alias("of_last"), F.col("until").alias("last")))
    carried = earlier.join(last, (F.col("season") == F.col("of_last")) & (F.col("round") == F.col("last")))
    carried = carried.select("season", "round", "member", "points", "places")
    new = _ranked(_intervals(carried.unionByName(later), places), later.select("season", "round").distinct(), method)
    return kept.unionByName(new)
