"""Raw tables to staged tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline import plans
from touchline.functions import season_of
from touchline.schemas import AWAY_SLOTS, HOME_SLOTS, RAW, SKILLS

from tests.plans import executed
from tests.league import S1, S2, rows


def raw_matches(spark, found):
    """Rows of dicts; what is not given is null."""
    names = [part.split()[0] for part in RAW["enunciado_partidos"].split(", ")]
    full = [tuple(row.get(n) for n in names) for row in found]
    return spark.createDataFrame(full, RAW["enunciado_partidos"])


def match(number, season, home, away, **more):
    return {
        "match_api_id": number, "season": season, "home_team_api_id": home, "away_team_api_id": away,
        "league_id": 1, "country_id": 5, "home_team_goal": 0, "away_team_goal": 0, **more,
    }


def test_dimensions(spark):
    countries = spark.createDataFrame([(5, "Here"), (6, "There")], RAW["enunciado_paises"])
    leagues = spark.createDataFrame([("First", 5), ("Other", 6)], RAW["enunciado_liga"])
    teams = spark.createDataFrame([(1, "One"), (1, "One"), (2, "Two"), (3, "Three")], RAW["enunciado_equipos"])
    people = spark.createDataFrame([(10, "Ann")], RAW["enunciado_jugadores"])
    matches = raw_matches(
        spark, [match(1, S1, 1, 2), match(2, S1, 1, 3), match(3, S2, 1, 2, league_id=4), match(4, None, 2, 1)]
    )
    assert rows(plans.stage_countries(countries)) == [("Here",), ("There",)]
    assert rows(plans.stage_players(people)) == [(10, "Ann")]
    assert rows(plans.stage_seasons(matches)) == [(S1,), (S2,), (None,)]
    # a country without matches has no league id, and its leagues share the ids found in its matches
    assert rows(plans.stage_leagues(leagues, countries, matches)) == [("First", "Here", 1), ("First", "Here", 4)]
    # T1 hosted in two leagues; T3 never hosted
    assert rows(plans.stage_teams(teams, matches)) == [(1, "One", 1), (1, "One", 4), (2, "Two", 1)]


def test_matches_and_outcomes(spark):
    found = [
        match(1, S1, 1, 2, home_team_goal=2), match(1, S1, 1, 2, home_team_goal=2), match(2, S1, 2, 1, home_team_goal=2),
        match(3, S1, 2, 1, away_team_goal=1), match(4, S1, 2, 1), match(5, S1, 2, 1, away_team_goal=None),
    ]
    staged = plans.stage_matches(raw_matches(spark, found))
    assert staged.count() == 5
    assert rows(plans.stage_outcomes(staged)) == [
        (0, 0, "Empatado"), (0, 1, "Perdido"), (0, None, "Empatado"), (2, 0, "Ganado"),
    ]
    assert rows(plans.stage_outcomes(staged, per_match=True))[:2] == [(1, 2, 0, "Ganado"), (2, 2, 0, "Ganado")]


def test_squads_and_rosters(spark):
    found = [
        match(1, S2, 1, 2, home_player_1=10.0, home_player_11=11.0, away_player_1=20.0),
        match(2, S1, 1, 2, home_player_1=10.0, away_player_3=20.0),
        match(3, S2, 1, 2, home_player_4=10.0, away_player_11=21.0),
        match(4, S2, 2, 1, home_player_1=20.0, away_player_2=12.0),
    ]
    matches = raw_matches(spark, found)
    squads = plans.stage_squads(plans.stage_matches(matches))
    # numbered by season and team; T2 has no squad in S1, where it only played away
    assert rows(squads) == [(S1, 1, 0), (S2, 1, 1), (S2, 2, 2)]
    assert rows(plans.stage_rosters(matches, squads)) == [(0, 10), (1, 10), (1, 11), (1, 12), (2, 20), (2, 21)]


def test_rosters_use_every_slot(spark):
    slots = {c: float(i) for i, c in enumerate(HOME_SLOTS + AWAY_SLOTS)}
    matches = raw_matches(spark, [match(1, S1, 1, 2, **slots), match(2, S1, 2, 1)])
    squads = plans.stage_squads(plans.stage_matches(matches))
    found = rows(plans.stage_rosters(matches, squads))
    assert found == sorted([(0, i) for i in range(11)] + [(1, i) for i in range(11, 22)], key=repr)
    some = squads.filter("ID_equipo = 2")
    assert rows(plans.stage_rosters(matches, some)) == [(1, i) for i in range(11, 22)]


def test_rosters_shuffle_two_numbers(spark, conf):
    """Sides meet the squads while they are two rows a match; no text goes with the players."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    matches = raw_matches(spark, [match(1, S1, 1, 2, home_player_1=10.0)])
    plan = executed(plans.stage_rosters(matches, plans.stage_squads(plans.stage_matches(matches))))
    assert "hashpartitioning(ID_plantel" in plan and "ID_jugador" in plan
    last = next(line for line in plan.splitlines() if "hashpartitioning(ID_plantel" in line)
    assert "Temporada" not in last


def test_attributes(spark):
    values = [float(i) for i in range(len(SKILLS))]
    rating = spark.createDataFrame(
        [(10, dt.datetime(2012, 7, 31), 70.0, None, "left", *values)], RAW["enunciado_jugadores_atributos"]
    )
    staged = plans.stage_attributes(rating)
    assert staged.columns[5:-1] == list(SKILLS.values())
    assert rows(staged) == [(10, dt.datetime(2012, 7, 31), 70.0, None, "left", *values, "2011/2012")]


DATES = {
    dt.datetime(2006, 12, 1): ("2006/2007", None),
    dt.datetime(2007, 3, 1): ("2006/2007", "2007/2008"),
    dt.datetime(2007, 9, 1): ("2007/2008", "2007/2008"),
    dt.datetime(2012, 7, 31, 23, 59): ("2011/2012", "2011/2012"),
    dt.datetime(2012, 8, 1): ("2012/2013", "2012/2013"),
    dt.datetime(2016, 9, 1): ("2016/2017", "2015/2016"),
    dt.datetime(2017, 1, 1): ("2016/2017", None),
    None: (None, None),
}


def test_season_of_a_date(spark):
    dates = spark.createDataFrame([(d,) for d in DATES], "d TIMESTAMP_NTZ")
    held = season_of(F.col("d"), first_year=2007, last_year=2016)
    found = dates.select("d", season_of(F.col("d")).alias("a"), held.alias("b")).collect()
    assert {r.d: (r.a, r.b) for r in found} == DATES


def test_held_seasons_equal_the_calendar(spark):
    """Every day of eleven years against the rule written out in Python."""

    def label(day):
        start = day.year if day.month > 7 else day.year - 1
        start = min(max(start, 2007), 2015)
        return f"{start}/{start + 1}" if 2007 <= day.year <= 2016 else None

    days = spark.sql("SELECT explode(sequence(DATE'2006-06-01', DATE'2017-06-01')) AS d")
    found = days.select("d", season_of(F.col("d"), first_year=2007, last_year=2016).alias("s")).collect()
    assert all(r.s == label(r.d) for r in found) and len(found) == 4019


@pytest.mark.parametrize("landed", [False, True])
def test_stage_all(spark, landed):
    xml = "<goal><value><id>1</id><player1>10</player1></value></goal>"
    raw = {
        "enunciado_paises": spark.createDataFrame([(5, "Here")], RAW["enunciado_paises"]),
        "enunciado_jugadores": spark.createDataFrame([(10, "Ann")], RAW["enunciado_jugadores"]),
        "enunciado_liga": spark.createDataFrame([("First", 5)], RAW["enunciado_liga"]),
        "enunciado_equipos": spark.createDataFrame([(1, "One")], RAW["enunciado_equipos"]),
        "enunciado_partidos": raw_matches(spark, [match(1, S1, 1, 2, goal=xml, home_player_1=10.0)]),
        "enunciado_jugadores_atributos": spark.createDataFrame([], RAW["enunciado_jugadores_atributos"]),
    }
    staged = plans.stage_all(raw, landed=landed, first_year=2007, last_year=2016)
    counts = {name: df.count() for name, df in staged.items()}
    assert counts.pop("tabla_atributos_jugador") == 0
    assert set(counts.values()) == {1} and len(counts) == 10


def test_rosters_of_more_matches_take_more_tasks(spark, monkeypatch):
    """Players are shuffled before any are combined, and a task's share does not grow with the matches."""
    found = [match(i, S1, 1 + i % 3, 4, home_player_1=float(i % 7), away_player_2=float(i % 5)) for i in range(60)]
    matches = raw_matches(spark, found)
    squads = plans.stage_squads(plans.stage_matches(matches))
    monkeypatch.setattr("touchline.plans.staging.ROSTER_PLACES", 44)
    for count in (60, 120):
        some = plans.stage_rosters(matches, squads, count)
        assert rows(some) == rows(plans.stage_rosters(matches, squads))
        plan = executed(some)
        tasks = 1 + count * 22 // 44
        assert f", {tasks}), REPARTITION_BY_NUM" in plan
        assert "Aggregate" not in plan[plan.index("REPARTITION_BY_NUM") : plan.index("SortMergeJoin" if "SortMergeJoin" in plan else "HashJoin")]
