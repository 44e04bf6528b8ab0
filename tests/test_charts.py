"""Chart data on hand-made leagues with known answers."""

import datetime as dt

from touchline import plans
from touchline.scope import Scope

from tests import league as L
from tests.league import S1, S2, SCOPE, rows


def test_calendar_years_not_seasons(spark):
    day = dt.datetime
    played = [
        ("2011/2012", 1, 2, 3, 1, 1, day(2012, 1, 1)),  # first moment of the first year
        (S1, 2, 1, 2, 2, 1, day(2013, 12, 31, 23, 59)),  # last minute of the last year
        (S1, 1, 3, 4, 0, 1, day(2014, 1, 1)),
        ("2011/2012", 1, 3, 5, 0, 1, day(2011, 12, 31, 23, 59)),
        (S1, 1, 3, 6, 0, 9, day(2012, 6, 1)),
        (S1, 3, 1, 0, 1, 1, day(2013, 3, 1)),
    ]
    matches, teams = L.matches(spark, played), L.teams(spark, (1,), (2,), (3,))
    goals = plans.yearly_goals(matches, teams, 1, 2012, 2013)
    assert rows(goals) == [
        (2012, 1, "T1", 3, 1), (2012, 2, "T2", 1, 3), (2013, 1, "T1", 3, 2), (2013, 2, "T2", 2, 2), (2013, 3, "T3", 0, 1),
    ]
    assert rows(plans.teams_in_all_years(matches, 1, 2012, 2013)) == [(1,), (2,)]
    steady = plans.yearly_goals(matches, teams, 1, 2012, 2013, in_all_years=True)
    assert {r[1] for r in rows(steady)} == {1, 2}


def test_averages_keep_equal_scores(spark):
    # a plain union of the two roles would merge the equal rows
    matches = L.matches(spark, [(S1, 1, 2, 1, 1), (S1, 1, 2, 1, 1), (S1, 1, 2, 4, 1), (S2, 1, 2, 0, 3)])
    assert rows(plans.season_goal_averages(matches, SCOPE)) == [(S1, 1.5), (S2, 1.5)]
    teams = L.teams(spark, (1, "O'One"), (2, "Two"))
    assert rows(plans.team_goal_averages(matches, teams, SCOPE))[0] == (1, "O'One", S1, 2.0)
    assert rows(plans.team_goal_averages(matches, teams, SCOPE, "O'One")) == [(1, "O'One", S1, 2.0), (1, "O'One", S2, 0.0)]


def strength_league(spark):
    """T1 has different squads in two seasons; T2 one squad; T9, of another league, plays T1 once."""
    matches = L.matches(spark, [(S1, 1, 2, 3, 1), (S2, 2, 1, 0, 2), (S1, 1, 9, 5, 4)])
    teams = L.teams(spark, (1,), (2,), (9, "T9", 7))
    squads = L.squads(spark, (S1, 1), (S2, 1), (S2, 2), (S1, 9))
    rosters = L.rosters(spark, {0: [10], 1: [10, 11], 2: [12], 3: [12]})
    ratings = L.ratings(
        spark,
        [
            (10, S1, 2.0), (10, S1, 4.0), (10, S2, 7.0), (11, S2, 12.0), (12, S2, 22.0),
            (12, S2, None), (12, S2, 5.0, None),  # rows that are not complete
        ],
    )
    return matches, teams, squads, rosters, ratings


def test_strength_by_season(spark):
    matches, teams, squads, rosters, ratings = strength_league(spark)
    strength = plans.squad_strength(ratings, rosters, squads, teams, SCOPE)
    assert rows(strength) == [(0, 1, S1, 42.0), (1, 1, S2, 55.0), (2, 2, S2, 40.0)]
    sides = plans.league_sides(matches, teams, SCOPE)
    # T2 has no squad in S1 and T9 none in the league
    assert rows(plans.squad_match_goals(sides, strength)) == [
        (0, 1, 3, 42.0), (0, 3, 5, 42.0), (1, 2, 2, 55.0), (2, 2, 0, 40.0),
    ]
    assert rows(plans.attributes_vs_goals(sides, strength, teams)) == [("T1", 10 / 3, 139 / 3), ("T2", 0.0, 40.0)]
    assert rows(plans.goal_histogram(sides, strength)) == [(0, 1), (2, 1), (3, 1), (5, 1)]
    assert rows(plans.goal_histogram(sides, strength, teams=teams)) == [
        ("T1", 2, 1), ("T1", 3, 1), ("T1", 5, 1), ("T2", 0, 1),
    ]


def test_strength_free_of_season(spark):
    matches, teams, squads, rosters, ratings = strength_league(spark)
    strength = plans.squad_strength(ratings, rosters, squads, teams, SCOPE, season_free=True)
    # player 10: rows of 20, 22 and 25, twice in the scope's squads; 11 and 12: once
    ten, eleven, twelve = 2 * 67.0, 30.0, 40.0
    assert rows(strength) == [(0, 1, S1, ten), (1, 1, S2, ten + eleven), (2, 2, S2, twelve), (3, 9, S1, twelve)]
    sides = plans.league_sides(matches, teams, SCOPE, away_uses_home_goals=True)
    pairs = plans.squad_match_goals(sides, strength, season_free=True)
    assert rows(pairs) == sorted(
        [(q, m, g, s) for m, g in ((1, 3), (2, 0), (3, 5)) for q, s in ((0, ten), (1, ten + eleven))]
        + [(2, 1, 3, twelve), (2, 2, 0, twelve), (3, 3, 5, twelve)],
        key=repr,
    )
    found = {r[0]: r[1:] for r in rows(plans.attributes_vs_goals(sides, strength, teams, season_free=True))}
    assert found == {"T1": (8 / 3, ten + eleven / 2), "T2": (1.5, twelve), "T9": (5.0, twelve)}
    assert rows(plans.goal_histogram(sides, strength, season_free=True)) == [(0, 3), (3, 3), (5, 3)]


def test_away_side_takes_away_goals(spark):
    matches, teams = L.matches(spark, [(S1, 1, 2, 3, 1)]), L.teams(spark, (1,), (2,))
    assert rows(plans.league_sides(matches, teams, SCOPE)) == [(1, S1, 1, 3), (1, S1, 2, 1)]
    assert rows(plans.league_sides(matches, teams, SCOPE, True)) == [(1, S1, 1, 3), (1, S1, 2, 3)]


def test_matches_need_one_side_in_the_league(spark):
    matches = L.matches(spark, [(S1, 1, 9, 3, 1, 5), (S1, 9, 1, 0, 0, 5), (S1, 8, 9, 2, 2), ("2011/2012", 1, 2, 7, 7)])
    # a team listed twice must not double a match
    teams = L.teams(spark, (1, "A"), (1, "B"), (2,), (8, "T8", 7), (9, "T9", 7))
    assert rows(plans.league_sides(matches, teams, Scope(1, (S1,)))) == [
        (1, S1, 1, 3), (1, S1, 9, 1), (2, S1, 1, 0), (2, S1, 9, 0),
    ]
