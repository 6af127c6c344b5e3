"""Season standings: per (season, member) points and wins, ranked by points.

Aggregation is a hash aggregate (map-side partial); the ranking is
:func:`stratum.operators.ranking.rank_desc`, distributed across tasks where
a season holds millions of members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.ranking import rank_desc


def standings(df: DataFrame, season: Column | str, member: Column | str, points: Column,
              win: Column, method: str = "auto") -> DataFrame:
    """``season, member, points, wins, position`` (position = rank by points)."""
    season_c = F.col(season) if isinstance(season, str) else season
    member_c = F.col(member) if isinstance(member, str) else member
    table = (df.groupBy(season_c.alias("season"), member_c.alias("member"))
             .agg(points.alias("points"), F.count_if(win).alias("wins")))
    return rank_desc(table, "season", "points", rank_col="position", method=method)


def driver_standings(results: DataFrame, method: str = "auto") -> DataFrame:
    """Per season and driver of refined results: points, wins (position 1),
    championship position.  Columns: season, driver_id, points, wins, position."""
    s = standings(results, "season", "driver_id", F.sum("points"), F.col("position") == 1, method)
    return s.select("season", F.col("member").alias("driver_id"), "points", "wins", "position")


def constructor_standings(results: DataFrame, method: str = "auto") -> DataFrame:
    """Per season and constructor of refined results (all their drivers'
    points).  Columns: season, constructor_id, points, wins, position."""
    s = standings(results, "season", "constructor_id", F.sum("points"), F.col("position") == 1,
                  method)
    return s.select("season", F.col("member").alias("constructor_id"), "points", "wins", "position")
