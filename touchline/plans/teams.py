"""Questions about teams. Staged tables in, answers out; nothing runs before the caller's action.

Answers that are sorted by a value many rows share are sorted by an id or a name after it: a sort spreads
rows over its tasks by the sorted columns, and rows alike in all of them meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators import extreme_rows, extreme_rows_by, outcome_counts, rows_without, two_sided
from touchline.schemas import DRAWN, LOST, PROMOTED, RELEGATED, WON
from touchline.scope import Scope


def named(df: DataFrame, teams: DataFrame, key: str = "ID_equipo") -> DataFrame:
    """Add ``Nombre``. A team listed in two leagues comes out twice, as in any join with the team table."""
    return df.join(teams.select(F.col("ID_equipo").alias(key), "Nombre"), key)


def league_id_of(leagues: DataFrame, country: str) -> DataFrame:
    return leagues.filter(F.col("Nombre_pais") == country).select(F.col("ID").alias("ID_liga"))


def outcome_totals(
    matches: DataFrame, scope: Scope, wanted: str, by_season: bool, names: tuple[str, str, str], both: bool = True
) -> DataFrame:
    """Matches with one outcome per team (and season): home, away and together, under the given names."""
    keys = ["team", "season"] if by_season else ["team"]
    counts = outcome_counts(two_sided(scope.matches(matches)), wanted, keys, both)
    renamed = {"team": "ID_equipo", "season": "Temporada", **dict(zip(("home", "away", "total"), names))}
    return counts.withColumnsRenamed(renamed)


def team_wins(
    matches: DataFrame, scope: Scope, by_season: bool = False, require_both_roles: bool = True
) -> DataFrame:
    """Wins per team (and season). Teams without a win in one of the roles do not count unless
    ``require_both_roles`` is off."""
    names = "Ganados_local", "Ganados_visitante", "Ganados"
    return outcome_totals(matches, scope, WON, by_season, names, require_both_roles)


def team_losses(matches: DataFrame, scope: Scope, require_both_roles: bool = True) -> DataFrame:
    """Losses per team and season."""
    names = "Perdidos_local", "Perdidos_visitante", "Perdidos_totales"
    return outcome_totals(matches, scope, LOST, True, names, require_both_roles)


def team_draws(matches: DataFrame, scope: Scope, require_both_roles: bool = True) -> DataFrame:
    """Draws per team in the last season."""
    names = "Empatados_local", "Empatados_visitante", "Empatados"
    return outcome_totals(matches, scope.only_last(), DRAWN, False, names, require_both_roles)


def most_wins(matches: DataFrame, teams: DataFrame, scope: Scope, require_both_roles: bool = True) -> DataFrame:
    """Names of the teams with the most wins."""
    wins = team_wins(matches, scope, require_both_roles=require_both_roles).select("ID_equipo", "Ganados")
    return named(extreme_rows(wins, "Ganados"), teams).select("Nombre")


def most_losses_per_season(
    matches: DataFrame, teams: DataFrame, scope: Scope, require_both_roles: bool = True
) -> DataFrame:
    """Names of the teams with the most losses of each season."""
    losses = team_losses(matches, scope, require_both_roles).select("ID_equipo", "Temporada", "Perdidos_totales")
    worst = extreme_rows_by(losses, "Perdidos_totales", ["Temporada"])
    return named(worst, teams).select("Nombre", "Temporada", "Perdidos_totales").orderBy("Temporada", "Nombre")


def most_draws_last_season(
    matches: DataFrame, teams: DataFrame, scope: Scope, require_both_roles: bool = True
) -> DataFrame:
    """Names of the teams with the most draws of the last season."""
    draws = team_draws(matches, scope, require_both_roles).select("ID_equipo", "Empatados")
    return named(extreme_rows(draws, "Empatados"), teams).select("Nombre")


def team_goals(matches: DataFrame, scope: Scope) -> DataFrame:
    """Goals for and against per team, in one aggregate."""
    return (
        two_sided(scope.matches(matches))
        .filter(F.col("team").isNotNull())
        .groupBy(F.col("team").alias("ID_equipo"))
        .agg(
            F.sum("goals_for").alias("Goles_totales"),
            F.sum("goals_against").alias("Goles_en_contra_totales"),
        )
    )


def most_goals_for(matches: DataFrame, teams: DataFrame, scope: Scope) -> DataFrame:
    best = extreme_rows(team_goals(matches, scope).select("ID_equipo", "Goles_totales"), "Goles_totales")
    return named(best, teams).select("ID_equipo", "Nombre", "Goles_totales")


def goal_difference(
    matches: DataFrame, teams: DataFrame, scope: Scope, only_top_scorers: bool = False
) -> DataFrame:
    """Absolute goal difference of every team, or only of the teams with the most goals."""
    goals = team_goals(matches, scope)
    if only_top_scorers:
        goals = extreme_rows(goals, "Goles_totales")
    difference = F.abs(F.col("Goles_totales") - F.col("Goles_en_contra_totales"))
    return (
        named(goals, teams)
        .select("ID_equipo", "Nombre", difference.alias("Diferencia_goles"))
        .orderBy(F.desc_nulls_last("Diferencia_goles"), "ID_equipo")
    )


def squad_sizes(rosters: DataFrame, squads: DataFrame, teams: DataFrame, scope: Scope) -> DataFrame:
    """Players per squad of the league's teams. Rosters are counted first: what is joined is one row
    per squad, however large a squad is."""
    sizes = scope.near_rosters(rosters, squads, teams).groupBy("ID_plantel").agg(F.count("ID_jugador").alias("Cantidad_Jugadores"))
    counted = sizes.join(scope.squads(squads, teams), "ID_plantel")
    return (
        named(counted, teams)
        .select("ID_equipo", "Nombre", "ID_plantel", "Cantidad_Jugadores")
        .orderBy("Cantidad_Jugadores", "ID_plantel")
    )


def teams_by_season(matches: DataFrame, scope: Scope) -> DataFrame:
    """Distinct (team, season) over both roles."""
    sides = two_sided(scope.matches(matches))
    return sides.select("team", "season").filter(F.col("team").isNotNull() & F.col("season").isNotNull()).distinct()


def absent_next_season(matches: DataFrame, scope: Scope) -> DataFrame:
    """Teams of a season that are not there in the next one of the list; the last has none to compare."""
    played = teams_by_season(matches, scope)
    following = F.lit(None).cast("string")
    for before, after in zip(scope.seasons, scope.seasons[1:]):
        following = F.when(F.col("season") == before, after).otherwise(following)
    leaving = played.withColumn("next", following)
    gone = rows_without(leaving, played.select("team", F.col("season").alias("next")), ["team", "next"])
    return gone.select(F.col("team").alias("ID_equipo"), F.col("season").alias("Temporada"))


def season_churn(matches: DataFrame, teams: DataFrame, scope: Scope) -> DataFrame:
    """Relegations, labelled with the season a team was last there, and promotions, labelled with the
    season it is there again, for every two neighbours in the list of seasons.

    One aggregate marks the seasons each team played; the changes are read off these marks, so neither
    a shuffle per pair of seasons nor a join is needed.
    """
    present = [F.bool_or(F.col("season") == s).alias(f"in_{i}") for i, s in enumerate(scope.seasons)]
    marks = two_sided(scope.matches(matches)).filter(F.col("team").isNotNull()).groupBy("team").agg(*present)
    changes = []
    for i, (before, after) in enumerate(zip(scope.seasons, scope.seasons[1:])):
        was, now = F.col(f"in_{i}"), F.col(f"in_{i + 1}")
        changes.append(_change(was & ~now, before, RELEGATED))
        changes.append(_change(now & ~was, after, PROMOTED))
    if not changes:
        changes = [_change(F.lit(False), scope.last_season, RELEGATED)]
    churn = (
        marks.select(F.col("team").alias("ID_equipo"), F.explode(F.array(*changes)).alias("change"))
        .filter(F.col("change.happened"))
        .select("ID_equipo", "change.Temporada", "change.Estado")
    )
    return named(churn, teams).select("ID_equipo", "Nombre", "Temporada", "Estado").orderBy("Temporada", "ID_equipo")


def _change(happened, season: str, state: str):
    return F.struct(
        happened.alias("happened"), F.lit(season).alias("Temporada"), F.lit(state).alias("Estado")
    )


def season_role_totals(matches: DataFrame, scope: Scope) -> DataFrame:
    """Home and away goals per season."""
    return (
        scope.matches(matches)
        .groupBy("Temporada")
        .agg(F.sum("Goles_local").alias("Goles_local"), F.sum("Goles_visitante").alias("Goles_visitante"))
        .orderBy(F.asc_nulls_last("Temporada"))
    )


def home_team_list(matches: DataFrame, scope: Scope) -> DataFrame:
    """The home team of every match, repeated as often as it hosts."""
    return scope.matches(matches).select("ID_local")
