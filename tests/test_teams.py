"""Questions about teams on hand-made leagues with known answers."""

from touchline import plans
from touchline.scope import Scope

from tests import league as L
from tests.league import S1, S2, S3, S4, SCOPE, rows


def test_team_without_away_wins_needs_either_role(spark):
    # T1 wins five times, always at home; T2 twice at home and twice away
    played = [(S1, 1, 3, 1, 0)] * 5 + [(S1, 2, 3, 2, 0)] * 2 + [(S2, 3, 2, 0, 1)] * 2
    matches, teams = L.matches(spark, played), L.teams(spark, (1,), (2,), (3,))
    assert rows(plans.most_wins(matches, teams, SCOPE)) == [("T2",)]
    assert rows(plans.most_wins(matches, teams, SCOPE, require_both_roles=False)) == [("T1",)]


def test_ties_are_all_returned(spark):
    # T1 and T2 beat T3 once in each role; in S1 T3 loses most, in S2 T1 and T2 do
    played = [
        (S1, 1, 3, 1, 0), (S1, 3, 1, 0, 1), (S1, 2, 3, 1, 0), (S1, 3, 2, 0, 1),
        (S2, 1, 4, 0, 1), (S2, 4, 1, 1, 0), (S2, 2, 4, 0, 1), (S2, 4, 2, 1, 0),
    ]
    matches, teams = L.matches(spark, played), L.teams(spark, (1,), (2,), (3,), (4,))
    scope = Scope(1, (S1,))
    assert rows(plans.most_wins(matches, teams, scope)) == [("T1",), ("T2",)]
    worst = plans.most_losses_per_season(matches, teams, SCOPE)
    assert rows(worst) == [("T1", S2, 2), ("T2", S2, 2), ("T3", S1, 4)]


def test_draws_count_the_last_season_only(spark):
    played = [(S1, 1, 2, 0, 0)] * 3 + [(S1, 2, 1, 0, 0)] * 3
    played += [(S4, 3, 4, 1, 1), (S4, 4, 3, 1, 1), (S4, 3, 1, 2, 2)]
    matches, teams = L.matches(spark, played), L.teams(spark, (1,), (2,), (3,), (4,))
    # T1 drew in S4 too, but only away
    assert rows(plans.most_draws_last_season(matches, teams, SCOPE)) == [("T3",)]


def test_largest_difference_is_not_the_top_scorer(spark):
    # T1 scores most; T3 loses by far, and its negative balance has the largest absolute value
    played = [(S1, 1, 2, 6, 5), (S1, 2, 3, 1, 0), (S1, 4, 3, 4, 0), (S1, 3, 4, 0, 5)]
    matches, teams = L.matches(spark, played), L.teams(spark, (1,), (2,), (3,), (4,))
    assert rows(plans.most_goals_for(matches, teams, SCOPE)) == [(4, "T4", 9)]
    every = plans.goal_difference(matches, teams, SCOPE)
    assert [tuple(r) for r in every.collect()][0] == (3, "T3", 10)
    assert rows(every) == [(1, "T1", 1), (2, "T2", 0), (3, "T3", 10), (4, "T4", 9)]
    assert rows(plans.goal_difference(matches, teams, SCOPE, only_top_scorers=True)) == [(4, "T4", 9)]


def test_team_in_two_leagues_comes_out_twice(spark):
    matches = L.matches(spark, [(S1, 1, 2, 3, 0), (S1, 2, 1, 0, 1)])
    teams = L.teams(spark, (1, "One", 1), (1, "One", 2), (2, "Two", 1))
    assert rows(plans.most_wins(matches, teams, SCOPE)) == [("One",), ("One",)]
    assert rows(plans.team_goal_averages(matches, teams, SCOPE)) == [(1, "One", S1, 2.0), (2, "Two", S1, 0.0)]


def test_other_leagues_and_seasons_are_out_of_scope(spark):
    played = [(S1, 1, 2, 1, 0, 9), (S1, 2, 1, 0, 1, 9), ("2011/2012", 1, 2, 1, 0), ("2011/2012", 2, 1, 0, 1)]
    matches, teams = L.matches(spark, played), L.teams(spark, (1,), (2,))
    assert rows(plans.most_wins(matches, teams, SCOPE)) == []
    assert rows(plans.season_churn(matches, teams, SCOPE)) == []


def test_squad_sizes_by_squad(spark):
    teams = L.teams(spark, (1,), (2, "T2", 7))
    squads = L.squads(spark, (S1, 1), (S2, 1), (S1, 2), ("2011/2012", 1))
    rosters = L.rosters(spark, {0: [10, 11, 12], 1: [10], 2: [10, 11], 3: [10]})
    sizes = plans.squad_sizes(rosters, squads, teams, SCOPE)
    assert [tuple(r) for r in sizes.collect()] == [(1, "T1", 1, 1), (1, "T1", 0, 3)]


def test_churn_over_neighbouring_seasons(spark):
    # T3: in S1, out in S2, back in S3; T4: in the last season only, always away
    played = [(S1, 1, 2, 0, 0), (S1, 3, 1, 0, 0), (S2, 1, 2, 0, 0), (S3, 1, 3, 0, 0), (S4, 1, 4, 0, 0)]
    matches, teams = L.matches(spark, played), L.teams(spark, (1,), (2,), (3,), (4,))
    assert rows(plans.season_churn(matches, teams, SCOPE)) == [
        (2, "T2", S2, "Descendio"),
        (3, "T3", S1, "Descendio"),
        (3, "T3", S3, "Ascendio"),
        (3, "T3", S3, "Descendio"),
        (4, "T4", S4, "Ascendio"),
    ]
    assert rows(plans.absent_next_season(matches, SCOPE)) == [(2, S2), (3, S1), (3, S3)]
    # neighbours are those of the list, not of the calendar
    assert rows(plans.absent_next_season(matches, Scope(1, (S1, S3)))) == [(2, S1)]


def test_churn_of_a_single_season_is_empty(spark):
    matches, teams = L.matches(spark, [(S1, 1, 2, 0, 0)]), L.teams(spark, (1,), (2,))
    assert rows(plans.season_churn(matches, teams, Scope(1, (S1,)))) == []


def test_null_team_hides_nobody(spark):
    # a plain NOT IN over a null team would return nothing
    played = [(S1, 1, 2, 0, 0), (S2, 1, None, 0, 0), (S2, None, 1, 0, 0)]
    matches, teams = L.matches(spark, played), L.teams(spark, (1,), (2,))
    assert rows(plans.season_churn(matches, teams, Scope(1, (S1, S2)))) == [(2, "T2", S1, "Descendio")]
    assert rows(plans.absent_next_season(matches, Scope(1, (S1, S2)))) == [(2, S1)]


def test_role_totals_and_home_list(spark):
    matches = L.matches(spark, [(S1, 1, 2, 3, 1), (S1, 1, 3, 2, 2), (S2, 2, 1, 0, 4), (S2, 2, 1, 5, 5, 9)])
    assert [tuple(r) for r in plans.season_role_totals(matches, SCOPE).collect()] == [(S1, 5, 3), (S2, 0, 4)]
    assert rows(plans.home_team_list(matches, SCOPE)) == [(1,), (1,), (2,)]


def test_league_lookup(spark):
    leagues = L.table(spark, "tabla_liga", [("A", "Here", 5), ("B", "There", 6)])
    assert rows(plans.league_id_of(leagues, "There")) == [(6,)]


def test_scope_needs_a_season():
    try:
        Scope(1, ())
    except ValueError:
        return
    raise AssertionError("an empty scope was accepted")
