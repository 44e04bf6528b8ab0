"""Rosters are made of no more squads than a question can ask for."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from touchline import plans
from touchline.plans.staging import stage_rosters
from touchline.scope import Scope

from tests import league as L
from tests.league import S1, S2, rows

SF_DIR = "/root/testdata/sf0.001"


def test_near_squads_are_listed_or_played(spark):
    """T1 is listed, T2 hosts, T3 visits; T4 only plays in another league, T5 not at all in the seasons."""
    matches = L.matches(spark, [(S1, 2, 3, 1, 0), (S1, 4, 5, 1, 0, 2), (S2, 5, 2, 1, 0), (None, None, 4, 0, 0)])
    squads = L.squads(spark, *((s, t) for s in (S1, S2, None) for t in (1, 2, 3, 4, 5, None)))
    near = Scope(1, (S1,)).near_squads(squads, L.teams(spark, (1,), (1,), (4, "T4", 2)), matches)
    assert rows(near.select("Temporada", "ID_equipo")) == [(S1, 1), (S1, 2), (S1, 3)]


def made(df):
    """Rows that the distinct line-ups bring out, wherever they are in the executed plan."""
    found = []

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        if kind == "HashAggregateExec" and "keys=[ID_plantel#" in node.simpleString(1000) and "ID_jugador#" in node.simpleString(1000):
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    visit(plan)
    return found


@pytest.mark.parametrize("name", ["teams_per_player", "least_variation_overall", "player_team_wins", "squad_strength"])
def test_rosters_of_other_squads_are_not_made(spark, name):
    tables = driver.DriverTables(spark, SF_DIR)
    whole = stage_rosters(tables.raw_matches, tables.squads).count()
    found = made(driver.QUERIES[name](tables))
    assert found and max(found) < whole / 4


def test_scope_rosters_are_the_whole_ones_of_near_squads(spark):
    tables = driver.DriverTables(spark, SF_DIR)
    near = driver.SCOPE.near_squads(tables.squads, tables.teams, tables.matches)
    last = tables.squads.filter(F.col("Temporada") == driver.SCOPE.last_season)
    for some, squads in ((tables.scope_rosters, near), (tables.last_rosters, last)):
        assert rows(some) == rows(tables.rosters.join(squads, "ID_plantel", "left_semi").select(*some.columns))


def test_without_a_season_all_rosters_are_made_once(spark, conf):
    """The scope's members come of rosters of its own squads."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    tables = driver.DriverTables(spark, SF_DIR)
    whole = tables.rosters.count()
    # a distinct has a partial and a final aggregate
    assert sum(n >= whole for n in made(driver.QUERIES["goal_histogram_season_free_by_team"](tables))) <= 2


@pytest.mark.parametrize("ask", [plans.squad_strength, plans.rated_squads])
@pytest.mark.parametrize("season_free", [True, False])
def test_near_rosters_change_no_result(spark, ask, season_free):
    """Player 10 is rated and of squad 0 (in scope) and 2 (not), 11 of 1 and 3."""
    squads = L.squads(spark, (S1, 1), (S1, 2), (S2, 1), (S2, 3))
    members = {0: [10], 1: [11], 2: [10, 11], 3: [11]}
    ratings = L.ratings(spark, [(10, S1, 5.0), (10, S2, 7.0), (11, S1, 3.0)])
    teams, scope = L.teams(spark, (1,), (2, "T2", 2)), Scope(1, (S1,))
    whole, near = L.rosters(spark, members), L.rosters(spark, {0: [10]})
    found = rows(ask(ratings, whole, squads, teams, scope, season_free, near=near))
    assert found == rows(ask(ratings, whole, squads, teams, scope, season_free))
    assert [r[0] for r in found] == ([0, 2] if season_free else [0])
