"""Questions about players. Staged tables in, answers out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators import extreme_rows, rows_with
from touchline.plans.teams import named, team_wins
from touchline.schemas import PENALTY_TYPES
from touchline.scope import Scope


def named_players(df: DataFrame, players: DataFrame) -> DataFrame:
    return df.join(players.select(F.col("ID").alias("ID_jugador"), "Nombre"), "ID_jugador")


def members(rosters: DataFrame) -> DataFrame:
    """Roster rows with both ids, said before any join: plans that share rosters then share their shuffles."""
    return rosters.filter(F.col("ID_plantel").isNotNull() & F.col("ID_jugador").isNotNull())


def scoped_rosters(rosters: DataFrame, squads: DataFrame, teams: DataFrame, scope: Scope) -> DataFrame:
    """Members of the scope's squads: ``ID_plantel, ID_jugador``."""
    near = scope.near_rosters(rosters, squads, teams)
    return rows_with(members(near), scope.squads(squads, teams), ["ID_plantel"])


def player_goals(
    goals: DataFrame, matches: DataFrame, scope: Scope, null_player_counts: bool = False
) -> DataFrame:
    """Goals of any type per player. Goals without a player are left out; with ``null_player_counts``
    they make up one nameless player."""
    near = scope.near_goals(goals, matches)
    scored = near.select(F.col("ID_Partido").alias("ID_partido"), F.col("ID_Jugador").alias("ID_jugador"))
    if not null_player_counts:
        scored = scored.filter(F.col("ID_jugador").isNotNull())
    return (
        rows_with(scored, scope.matches(matches), ["ID_partido"])
        .groupBy("ID_jugador")
        .agg(F.count(F.lit(1)).alias("Goles"))
    )


def top_scorers(
    goals: DataFrame, matches: DataFrame, players: DataFrame, scope: Scope, null_player_counts: bool = False
) -> DataFrame:
    """Names and goals of the players with the most goals; a nameless one can win, but has no name to show."""
    best = extreme_rows(player_goals(goals, matches, scope, null_player_counts), "Goles")
    return named_players(best, players).select("Nombre", "Goles")


def player_wins(
    matches: DataFrame, squads: DataFrame, rosters: DataFrame, scope: Scope, require_both_roles: bool = True
) -> DataFrame:
    """Wins of a player's teams: a season's wins count for every member of the squad."""
    wins = team_wins(matches, scope, by_season=True, require_both_roles=require_both_roles)
    squad_wins = wins.join(squads, ["Temporada", "ID_equipo"]).select("ID_plantel", "Ganados")
    return (
        members(rosters)
        .join(squad_wins, "ID_plantel")
        .groupBy("ID_jugador")
        .agg(F.sum("Ganados").alias("Total_Ganados"))
    )


def player_team_wins(
    matches: DataFrame,
    squads: DataFrame,
    rosters: DataFrame,
    players: DataFrame,
    scope: Scope,
    require_both_roles: bool = True,
) -> DataFrame:
    """Players whose teams won most."""
    best = extreme_rows(player_wins(matches, squads, rosters, scope, require_both_roles), "Total_Ganados")
    return named_players(best, players).select("ID_jugador", "Nombre", "Total_Ganados")


def player_team_counts(
    matches: DataFrame, squads: DataFrame, rosters: DataFrame, scope: Scope, count_squads: bool = False
) -> DataFrame:
    """Teams a player belonged to, or squads with ``count_squads``, among those that hosted in the scope."""
    hosts = scope.matches(matches).select("Temporada", F.col("ID_local").alias("ID_equipo")).distinct()
    hosting = rows_with(squads, hosts, ["Temporada", "ID_equipo"]).select("ID_plantel", "ID_equipo")
    counted = F.count("ID_equipo") if count_squads else F.count_distinct("ID_equipo")
    belonging = members(rosters).join(hosting, "ID_plantel")
    return belonging.groupBy("ID_jugador").agg(counted.alias("Cantidad_equipos"))


def teams_per_player(
    matches: DataFrame,
    squads: DataFrame,
    rosters: DataFrame,
    players: DataFrame,
    scope: Scope,
    count_squads: bool = False,
) -> DataFrame:
    """Players who were in the most teams, or in the most squads with ``count_squads``."""
    best = extreme_rows(player_team_counts(matches, squads, rosters, scope, count_squads), "Cantidad_equipos")
    return named_players(best, players).select("ID_jugador", "Nombre", "Cantidad_equipos")


def rating_spans(
    attributes: DataFrame,
    rosters: DataFrame,
    squads: DataFrame,
    teams: DataFrame,
    scope: Scope,
    rating: str = "Potencial",
    global_guard: bool = False,
) -> DataFrame:
    """Largest minus smallest ``rating``, over all dates, of the players of the scope's squads.

    Players with a single rating row have no variation and are left out. With ``global_guard`` they vary
    by 0, and ``pairs`` says how many (squad member, rating row) pairs a player makes up.

    Ratings shrink to one row per player before they meet the squads.
    """
    spans = (
        attributes.filter(F.col(rating).isNotNull() & F.col("ID_jugador").isNotNull())
        .groupBy("ID_jugador")
        .agg(
            F.round(F.max(rating) - F.min(rating)).alias("Deltamaxmin"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    belonging = scoped_rosters(rosters, squads, teams, scope)
    if not global_guard:
        return rows_with(spans.filter(F.col("rows") > 1), belonging, ["ID_jugador"]).drop("rows")
    memberships = belonging.groupBy("ID_jugador").agg(F.count(F.lit(1)).alias("squads"))
    return spans.join(memberships, "ID_jugador").select(
        "ID_jugador", "Deltamaxmin", (F.col("rows") * F.col("squads")).alias("pairs")
    )


def least_variation(
    attributes: DataFrame,
    rosters: DataFrame,
    squads: DataFrame,
    teams: DataFrame,
    scope: Scope,
    rating: str = "Potencial",
    global_guard: bool = False,
) -> DataFrame:
    """Players whose ``rating`` varied least. With ``global_guard`` there are none unless the whole set of
    (squad member, rating row) pairs holds more than one."""
    spans = rating_spans(attributes, rosters, squads, teams, scope, rating, global_guard)
    if not global_guard:
        return extreme_rows(spans, "Deltamaxmin", "min")
    # The one row of least and total takes whole rows, and the answer asks for the pairs every player has:
    # so both need the same counts, and read the same shuffles.
    least = spans.agg(F.min(F.struct("Deltamaxmin", "ID_jugador", "pairs")).alias("least"), F.sum("pairs").alias("total"))
    allowed = least.filter(F.col("total") > 1).select("least.Deltamaxmin")
    counted = spans.filter(F.col("pairs") > 0)
    return counted.join(F.broadcast(allowed), "Deltamaxmin", "left_semi").select("ID_jugador", "Deltamaxmin")


def penalty_goals(
    goals: DataFrame, matches: DataFrame, scope: Scope, types: Sequence[str] = PENALTY_TYPES
) -> DataFrame:
    """Goals of the penalty ``types`` with the season they fell in: ``ID_partido, ID_jugador, Temporada``."""
    played = scope.matches(matches).select("ID_partido", "Temporada")
    kicks = goals.filter(F.col("Tipo").isin(*types)).select(
        F.col("ID_Partido").alias("ID_partido"), F.col("ID_Jugador").alias("ID_jugador")
    )
    return kicks.join(played, "ID_partido")


def team_penalties(
    goals: DataFrame,
    matches: DataFrame,
    squads: DataFrame,
    rosters: DataFrame,
    teams: DataFrame,
    scope: Scope,
    types: Sequence[str] = PENALTY_TYPES,
    fixed_squad_season: str | None = None,
) -> DataFrame:
    """Penalty goals per team.

    A goal counts for the league's squads the player belonged to in the goal's season. With
    ``fixed_squad_season`` it counts for the player's squads of that one season, in any league.
    Goals shrink to a count per player (and season) before they meet the rosters.
    """
    if fixed_squad_season is None:
        keys = ["ID_jugador", "Temporada"]
        chosen = scope.squads(squads, teams)
    else:
        keys = ["ID_jugador"]
        chosen = squads.filter((F.col("Temporada") == fixed_squad_season) & F.col("ID_equipo").isNotNull())
    kicks = penalty_goals(goals.filter(F.col("ID_Jugador").isNotNull()), matches, scope, types)
    counts = kicks.groupBy(*keys).agg(F.count(F.lit(1)).alias("goals"))
    belonging = members(rosters).join(chosen, "ID_plantel")
    return belonging.join(counts, keys).groupBy("ID_equipo").agg(F.sum("goals").alias("penales_a_favor"))


def penalty_leaders(
    goals: DataFrame,
    matches: DataFrame,
    squads: DataFrame,
    rosters: DataFrame,
    teams: DataFrame,
    scope: Scope,
    types: Sequence[str] = PENALTY_TYPES,
    fixed_squad_season: str | None = None,
) -> DataFrame:
    """Names of the teams whose players scored the most goals of the penalty ``types``."""
    counts = team_penalties(goals, matches, squads, rosters, teams, scope, types, fixed_squad_season)
    return named(extreme_rows(counts, "penales_a_favor"), teams).select("Nombre", "penales_a_favor")
