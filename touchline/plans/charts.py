"""Data sets behind the season charts."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators import histogram, present_in_all, rows_with, two_sided
from touchline.plans.players import members, scoped_rosters
from touchline.plans.teams import named
from touchline.schemas import STRENGTH_COLUMNS
from touchline.scope import Scope


def _goals_by_year(matches: DataFrame, league_id: int, first_year: int, last_year: int) -> DataFrame:
    """Goals per team and calendar year. The years are a half-open range on the stored date, which the
    file scan can use; a predicate on the extracted year could not be pushed down."""
    within = (F.col("Fecha") >= F.lit(f"{first_year:04d}-01-01")) & (F.col("Fecha") < F.lit(f"{last_year + 1:04d}-01-01"))
    return (
        two_sided(matches.filter((F.col("ID_liga") == league_id) & within))
        .filter(F.col("team").isNotNull())
        .groupBy(F.year("date").alias("anio"), F.col("team").alias("ID_equipo"))
        .agg(
            F.sum("goals_for").alias("total_goles_a_favor"),
            F.sum("goals_against").alias("total_goles_en_contra"),
        )
    )


def yearly_goals(
    matches: DataFrame, teams: DataFrame, league_id: int, first_year: int, last_year: int, in_all_years: bool = False
) -> DataFrame:
    """Goals for and against per team and calendar year; with ``in_all_years`` only of the teams that
    played in every one of them."""
    goals = _goals_by_year(matches, league_id, first_year, last_year)
    if in_all_years:
        # one row per team and year: a team's list is never longer than the years asked for
        row = F.struct(*(c for c in goals.columns if c != "ID_equipo"))
        years = goals.groupBy("ID_equipo").agg(F.collect_list(row).alias("years"))
        goals = years.filter(F.size("years") == last_year - first_year + 1).select("ID_equipo", F.inline("years"))
    return (
        named(goals, teams)
        .select("anio", "ID_equipo", "Nombre", "total_goles_a_favor", "total_goles_en_contra")
        .orderBy("ID_equipo", "anio")
    )


def teams_in_all_years(matches: DataFrame, league_id: int, first_year: int, last_year: int) -> DataFrame:
    goals = _goals_by_year(matches, league_id, first_year, last_year)
    return present_in_all(goals, "ID_equipo", "anio", range(first_year, last_year + 1))


def goal_averages(matches: DataFrame, scope: Scope, keys: list[str]) -> DataFrame:
    """Average goals per match and side for the ``keys`` of the two-sided form."""
    sides = two_sided(scope.matches(matches))
    return sides.groupBy(*keys).agg(F.avg("goals_for").alias("Promedio_gol"))


def season_goal_averages(matches: DataFrame, scope: Scope) -> DataFrame:
    averages = goal_averages(matches, scope, ["season"])
    return averages.withColumnRenamed("season", "Temporada").orderBy(F.asc_nulls_last("Temporada"))


def team_goal_averages(
    matches: DataFrame, teams: DataFrame, scope: Scope, team_name: str | None = None
) -> DataFrame:
    """Average goals per team and season, for all teams or the one called ``team_name``."""
    averages = goal_averages(matches, scope, ["team", "season"]).withColumnsRenamed(
        {"team": "ID_equipo", "season": "Temporada"}
    )
    names = teams.select("ID_equipo", "Nombre").distinct()
    if team_name is not None:
        names = names.filter(F.col("Nombre") == team_name)
    return (
        averages.join(names, "ID_equipo")
        .select("ID_equipo", "Nombre", "Temporada", "Promedio_gol")
        .orderBy(F.asc_nulls_last("Nombre"), F.asc_nulls_last("Temporada"))
    )


def _strength_sums(attributes: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the complete rating rows per ``keys``. A row with a missing value has a null sum, which the
    aggregate passes over; a key with nothing else drops out afterwards. One predicate over all nineteen
    columns would say the same, but makes the optimizer rewrite it for every combination of aliases."""
    row_sum = reduce(add, (F.col(c) for c in STRENGTH_COLUMNS))
    return attributes.groupBy(*keys).agg(F.sum(row_sum).alias("sum")).filter(F.col("sum").isNotNull())


def _first(near: DataFrame | None, rosters: DataFrame) -> DataFrame:
    return rosters if near is None else near


def squad_strength(
    attributes: DataFrame,
    rosters: DataFrame,
    squads: DataFrame,
    teams: DataFrame,
    scope: Scope,
    season_free: bool = False,
    near: DataFrame | None = None,
) -> DataFrame:
    """Sum of all skills of a squad's players: ``ID_plantel, ID_equipo, Temporada, Suma_Atributos_Plantel``.

    Only rating rows with all nineteen values count. Each counts once for the squads the player belonged
    to in the season of its date, for the squads of the scope. With ``season_free`` a row counts for all
    squads of the player, of any season and league, as often as the player has squads in the scope. Who has rosters of
    fewer squads, the scope's among them, gives them as ``near``, so that the others are gone through once.

    Rating rows shrink to one sum per player (and season) before they are joined, so their number
    multiplies nothing.
    """
    total = F.sum("strength").alias("Suma_Atributos_Plantel")
    if not season_free:
        keys = ["ID_jugador", "Temporada"]
        sums = _strength_sums(attributes, keys).withColumnRenamed("sum", "strength")
        belonging = members(scope.near_rosters(_first(near, rosters), squads, teams)).join(scope.squads(squads, teams), "ID_plantel")
        return belonging.join(sums, keys).groupBy("ID_plantel", "ID_equipo", "Temporada").agg(total)
    sums = _strength_sums(attributes, ["ID_jugador"])
    memberships = (
        scoped_rosters(_first(near, rosters), squads, teams, scope).groupBy("ID_jugador").agg(F.count(F.lit(1)).alias("squads"))
    )
    repeated = sums.join(memberships, "ID_jugador").select(
        "ID_jugador", (F.col("sum") * F.col("squads")).alias("strength")
    )
    per_squad = members(rosters).join(repeated, "ID_jugador").groupBy("ID_plantel").agg(total)
    return squads.join(per_squad, "ID_plantel").select("ID_plantel", "ID_equipo", "Temporada", "Suma_Atributos_Plantel")


def rated_squads(
    attributes: DataFrame,
    rosters: DataFrame,
    squads: DataFrame,
    teams: DataFrame,
    scope: Scope,
    season_free: bool = False,
    near: DataFrame | None = None,
) -> DataFrame:
    """The squads that ``squad_strength`` has a sum for, without it: ``ID_plantel, ID_equipo, Temporada``. One member
    with one complete rating row is enough, so that nothing is added up and both sides of the question are
    semi-joins. ``near`` is as for ``squad_strength``."""
    keys = ["ID_jugador"] if season_free else ["ID_jugador", "Temporada"]
    row_sum = reduce(add, (F.col(c) for c in STRENGTH_COLUMNS))
    rated = attributes.filter(row_sum.isNotNull()).select(*keys).distinct()
    if season_free:
        rated = rows_with(rated, scoped_rosters(_first(near, rosters), squads, teams, scope), keys)
        found = rows_with(members(rosters), rated, keys)
        return rows_with(squads, found, ["ID_plantel"]).select("ID_plantel", "ID_equipo", "Temporada")
    belonging = members(scope.near_rosters(_first(near, rosters), squads, teams)).join(scope.squads(squads, teams), "ID_plantel")
    return rows_with(belonging, rated, keys).select("ID_plantel", "ID_equipo", "Temporada").distinct()


def league_sides(
    matches: DataFrame, teams: DataFrame, scope: Scope, away_uses_home_goals: bool = False
) -> DataFrame:
    """Both sides of the season's matches in which at least one side is a team of the league:
    ``ID_partido, Temporada, ID_equipo, Goles``.

    "Home or away team in the league" as one join condition would compare every match with every team.
    Two marks from equi-joins on distinct teams say the same.
    """
    league = scope.teams(teams)
    marked = (
        matches.filter(scope.season())
        .join(league.select(F.col("ID_equipo").alias("ID_local"), F.lit(True).alias("home_in")), "ID_local", "left")
        .join(
            league.select(F.col("ID_equipo").alias("ID_visitante"), F.lit(True).alias("away_in")),
            "ID_visitante",
            "left",
        )
        .filter(F.col("home_in").isNotNull() | F.col("away_in").isNotNull())
    )
    sides = two_sided(marked)
    goals = F.col("goals_for")
    if away_uses_home_goals:
        goals = F.when(F.col("role") == "home", F.col("goals_for")).otherwise(F.col("goals_against"))
    return sides.select(
        F.col("match").alias("ID_partido"),
        F.col("season").alias("Temporada"),
        F.col("team").alias("ID_equipo"),
        goals.alias("Goles"),
    )


def _squad_keys(season_free: bool) -> list[str]:
    return ["ID_equipo"] if season_free else ["ID_equipo", "Temporada"]


def squad_match_goals(sides: DataFrame, strength: DataFrame, season_free: bool = False) -> DataFrame:
    """Goals and squad strength per squad and match: ``ID_plantel, ID_partido, Goles,
    Suma_Atributos_Plantel``. With ``season_free`` every squad of the team meets the match."""
    keys = _squad_keys(season_free)
    squads = strength.select("ID_plantel", *keys, "Suma_Atributos_Plantel")
    return sides.join(squads, keys).select("ID_plantel", "ID_partido", "Goles", "Suma_Atributos_Plantel")


def attributes_vs_goals(
    sides: DataFrame, strength: DataFrame, teams: DataFrame, season_free: bool = False
) -> DataFrame:
    """Goals per match and average squad strength by team name.

    The matches of a team are counted and summed first, then weigh its squads: the pairs of match and
    squad are never built.
    """
    keys = _squad_keys(season_free)
    played = sides.groupBy(*keys).agg(
        F.sum("Goles").alias("goals"), F.count("ID_partido").alias("matches"), F.count(F.lit(1)).alias("rows")
    )
    pairs = played.join(strength.select(*keys, "Suma_Atributos_Plantel"), keys)
    return (
        named(pairs, teams)
        .groupBy("Nombre")
        .agg(
            F.try_divide(F.sum("goals"), F.sum("matches")).alias("Ratio_Goles"),
            (F.sum(F.col("Suma_Atributos_Plantel") * F.col("rows")) / F.sum("rows")).alias("Suma_Atributos"),
        )
    )


def goal_histogram(
    sides: DataFrame,
    squads: DataFrame,
    season_free: bool = False,
    teams: DataFrame | None = None,
    team_name: str | None = None,
) -> DataFrame:
    """How many (squad, match) pairs brought how many goals. ``squads`` are the rated ones, with or without their
    strength; with ``season_free`` each meets all matches of its team. ``teams`` gives a histogram for each team name,
    and ``team_name`` only that of the teams called so, which are looked up before anything is counted.

    Match sides are counted by team and goals first; a team's squads then multiply the counts.
    """
    keys = _squad_keys(season_free)
    by = []
    if team_name is not None:
        if teams is None:
            raise ValueError("a name needs the teams")
        called = teams.filter(F.col("Nombre") == team_name)
        sides = rows_with(sides, called, ["ID_equipo"])
    counted = histogram(sides, "Goles", keys, name="sides")
    each = squads.groupBy(*keys).agg(F.count(F.lit(1)).alias("squads"))
    pairs = counted.join(each, keys).withColumn("pairs", F.col("sides") * F.col("squads"))
    if teams is not None:
        pairs, by = named(pairs, teams if team_name is None else called), ["Nombre"]
    return histogram(pairs, "Goles", by, weight="pairs", name="Partidos").orderBy(*by, F.desc("Partidos"), "Goles")
