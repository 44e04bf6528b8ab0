"""Questions about players on hand-made leagues with known answers."""

from touchline import plans
from touchline.schemas import OPEN_PLAY, OWN_GOAL, PENALTY_IN_PLAY, SHOOT_OUT

from tests import league as L
from tests.league import S1, S2, S3, S4, SCOPE, rows


def test_goals_without_player_do_not_win(spark):
    matches = L.matches(spark, [(S1, 1, 2, 0, 0), (S1, 1, 2, 0, 0, 9)])
    goals = L.goals(
        spark,
        [(1, None, OPEN_PLAY)] * 3 + [(1, 10, OPEN_PLAY), (1, 10, OWN_GOAL), (1, 11, OPEN_PLAY)] + [(2, 11, OPEN_PLAY)] * 5,
    )
    people = L.players(spark, 10, 11)
    assert rows(plans.top_scorers(goals, matches, people, SCOPE)) == [("P10", 2)]
    assert rows(plans.top_scorers(goals, matches, people, SCOPE, null_player_counts=True)) == []


def test_wins_of_a_players_teams(spark):
    # T1 wins twice in S1, T2 twice in S2; player 10 was in both squads, 11 and 12 in one each
    played = [(S1, 1, 2, 1, 0), (S1, 2, 1, 0, 1), (S2, 2, 1, 1, 0), (S2, 1, 2, 0, 1)]
    squads = L.squads(spark, (S1, 1), (S1, 2), (S2, 1), (S2, 2))
    rosters = L.rosters(spark, {0: [10, 11], 1: [12], 2: [11], 3: [10, 12]})
    best = plans.player_team_wins(L.matches(spark, played), squads, rosters, L.players(spark, 10, 11, 12), SCOPE)
    assert rows(best) == [(10, "P10", 4)]


def test_teams_are_counted_once_unless_squads_are_asked_for(spark):
    played = [(s, t, 9, 0, 0) for s in (S1, S2, S3, S4) for t in (1, 2, 3)]
    squads = L.squads(spark, (S1, 1), (S2, 1), (S3, 1), (S4, 1), (S1, 2), (S2, 3))
    # player 10 stays four seasons in one team, 11 is in three teams
    rosters = L.rosters(spark, {0: [10, 11], 1: [10], 2: [10], 3: [10], 4: [11], 5: [11]})
    args = L.matches(spark, played), squads, rosters, L.players(spark, 10, 11), SCOPE
    assert rows(plans.teams_per_player(*args)) == [(11, "P11", 3)]
    assert rows(plans.teams_per_player(*args, count_squads=True)) == [(10, "P10", 4)]


def test_single_rating_is_no_variation(spark):
    teams, squads = L.teams(spark, (1,)), L.squads(spark, (S1, 1), (S2, 1))
    rosters = L.rosters(spark, {0: [10, 11, 12], 1: [12]})
    # 10 varies by 2; 11 and 12 have a single row, 12 in two squads; 13 is in no squad; the null row does not count
    ratings = L.ratings(
        spark, [(10, S1, 60.0), (10, S2, 62.0), (11, S1, 50.0), (11, S1, None), (12, S1, 70.0), (13, S1, 1.0), (13, S1, 1.0)]
    )
    args = ratings, rosters, squads, teams, SCOPE
    assert rows(plans.least_variation(*args)) == [(10, 2.0)]
    assert rows(plans.least_variation(*args, global_guard=True)) == [(11, 0.0), (12, 0.0)]


def test_global_guard_counts_a_row_once_per_squad(spark):
    teams, squads = L.teams(spark, (1,)), L.squads(spark, (S1, 1), (S2, 1))
    ratings = L.ratings(spark, [(12, S1, 70.0)])
    once, twice = L.rosters(spark, {0: [12]}), L.rosters(spark, {0: [12], 1: [12]})
    assert rows(plans.least_variation(ratings, once, squads, teams, SCOPE, global_guard=True)) == []
    assert rows(plans.least_variation(ratings, twice, squads, teams, SCOPE, global_guard=True)) == [(12, 0.0)]


def test_least_variation_of_overall_rating(spark):
    teams, squads, rosters = L.teams(spark, (1,)), L.squads(spark, (S1, 1)), L.rosters(spark, {0: [10, 11]})
    ratings = L.ratings(
        spark,
        [(10, S1, 60.0, 1.0, 50.0), (10, S2, 60.0, 1.0, 59.0), (11, S1, 60.0, 1.0, 50.0), (11, S2, 70.0, 1.0, 51.4)],
    )
    found = plans.least_variation(ratings, rosters, squads, teams, SCOPE, "Puntos_Generales")
    assert rows(found) == [(11, 1.0)]


def test_penalties_count_for_the_squad_of_their_season(spark):
    # player 10 moves from T1 to T2; T9 of another league shares the player in S4
    matches = L.matches(spark, [(S1, 1, 2, 0, 0), (S4, 1, 2, 0, 0)])
    goals = L.goals(
        spark,
        [(1, 10, PENALTY_IN_PLAY)] * 3 + [(1, 10, OPEN_PLAY)] * 4 + [(1, None, SHOOT_OUT), (1, 10, SHOOT_OUT), (2, 10, SHOOT_OUT)],
    )
    teams = L.teams(spark, (1,), (2,), (9, "T9", 7))
    squads = L.squads(spark, (S1, 1), (S4, 2), (S4, 9))
    rosters = L.rosters(spark, {0: [10], 1: [10], 2: [10]})
    args = goals, matches, squads, rosters, teams, SCOPE
    assert rows(plans.penalty_leaders(*args)) == [("T1", 4)]
    assert rows(plans.penalty_leaders(*args, types=(SHOOT_OUT,))) == [("T1", 1), ("T2", 1)]
    # one season's squads, any league, take the goals of all seasons
    assert rows(plans.penalty_leaders(*args, (SHOOT_OUT,), S4)) == [("T2", 2), ("T9", 2)]
