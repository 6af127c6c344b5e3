"""Standings after every round against a model that counts row by row."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import ranking
from stratum.operators.rounds import first_changes, round_results, round_standings, update_round_standings

PLACES = 3


def model(rows):
    """{(season, round, member): (points, places, position)}"""
    rows = [r for r in rows if None not in r[:3]]
    found = {}
    for season, at in {r[:2] for r in rows}:
        states = {}
        for s, r, m, points, position in rows:
            if s == season and r <= at:
                total, places = states.setdefault(m, [0, [0] * PLACES])
                states[m][0] = total + (points or 0)
                if position is not None and 1 <= position <= PLACES:
                    places[position - 1] += 1
        for m, state in states.items():
            better = sum(other > state for other in states.values())
            found[season, at, m] = (state[0], state[1], better + 1)
    return found


def some_rows(rnd, n):
    def one():
        hot = rnd.random() < 0.4
        return (1 if hot else rnd.choice([1, 2, 3]), rnd.randint(1, 6), "m0" if hot else f"m{rnd.randint(0, 12)}",
                rnd.choice([0, 0, 1, 2, None]), rnd.choice([1, 2, 3, 4, 0, None]))

    return [one() for _ in range(n)] + [(None, 1, "m1", 5, 1), (1, None, "m1", 5, 1), (1, 1, None, 5, 1)]


def won(spark, rows):
    df = spark.createDataFrame(rows, "season int, round int, member string, points bigint, position int")
    return round_results(df, *[F.col(c) for c in df.columns], PLACES)


def as_model(df):
    rows = df.collect()
    found = {(r.season, r.round, r.member): (r.points, list(r.places), r.position) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("method", ["window", "range", "auto"])
def test_rounds_with_countback(spark, method):
    rows = some_rows(random.Random(3), 150)
    assert as_model(round_standings(won(spark, rows), PLACES, method)) == model(rows)


def test_large_groups_are_ranked_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 5)
    rows = some_rows(random.Random(4), 150)
    assert as_model(round_standings(won(spark, rows), PLACES)) == model(rows)


def test_countback_decides_ties(spark):
    rows = [(1, 1, "a", 10, 2), (1, 1, "b", 10, 1), (1, 2, "a", 10, 1), (1, 2, "b", 10, 3), (1, 3, "c", 20, 9), (1, 3, "d", 20, None)]
    got = as_model(round_standings(won(spark, rows), PLACES))
    assert {k[1:]: v[2] for k, v in got.items()} == {
        (1, "a"): 2, (1, "b"): 1, (2, "a"): 1, (2, "b"): 2, (3, "a"): 1, (3, "b"): 2, (3, "c"): 3, (3, "d"): 3}


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_late_results_touch_later_rounds_only(spark, seed):
    rnd = random.Random(seed)
    rows = some_rows(rnd, 120)
    late = [(1, 4, "m0", 2, 1), (1, 6, "new", 1, 1), (2, rnd.randint(1, 6), "m3", 1, 2), (9, 2, "m1", 1, 1)]
    before = round_standings(won(spark, rows), PLACES).cache()
    first = first_changes(spark.createDataFrame(late, "season int, round int, member string, points bigint, position int"))
    starts = {r.season: r.first for r in first.collect()}
    assert starts[1] == 4 and 3 not in starts
    # results of earlier rounds and of other seasons are taken away: they are not needed
    current = [r for r in rows + late if None not in r[:3] and r[0] in starts and r[1] >= starts[r[0]]]
    got = as_model(update_round_standings(before, won(spark, current), first, PLACES))
    assert got == model(rows + late)


def test_no_rows(spark):
    empty = won(spark, some_rows(random.Random(8), 0))
    assert round_standings(empty, PLACES).count() == 0
    before = round_standings(won(spark, [(1, 1, "a", 1, 1)]), PLACES).cache()
    first = first_changes(spark.createDataFrame([], "season int, round int"))
    assert as_model(update_round_standings(before, empty, first, PLACES)) == {(1, 1, "a"): (1, [1, 0, 0], 1)}
