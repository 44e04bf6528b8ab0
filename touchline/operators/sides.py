"""Matches seen from both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.outcome import outcome

HOME, AWAY = "home", "away"


def two_sided(matches: DataFrame) -> DataFrame:
    """One row per match and team: ``match, league, season, date, team, opponent, role, goals_for,
    goals_against, outcome``.

    Only the role is exploded and the other columns are chosen by it afterwards, so that a column no
    later step asks for is not read from the files. One scan, no shuffle. ``ID_partido`` is the key of
    ``matches``, hence (match, team) rows are unique.
    """
    at_home = F.col("role") == HOME

    def by_role(home: str, away: str) -> Column:
        return F.when(at_home, F.col(home)).otherwise(F.col(away))

    goals_for = by_role("Goles_local", "Goles_visitante")
    goals_against = by_role("Goles_visitante", "Goles_local")
    return matches.withColumn("role", F.explode(F.array(F.lit(HOME), F.lit(AWAY)))).select(
        F.col("ID_partido").alias("match"),
        F.col("ID_liga").alias("league"),
        F.col("Temporada").alias("season"),
        F.col("Fecha").alias("date"),
        by_role("ID_local", "ID_visitante").alias("team"),
        by_role("ID_visitante", "ID_local").alias("opponent"),
        "role",
        goals_for.alias("goals_for"),
        goals_against.alias("goals_against"),
        outcome(goals_for, goals_against).alias("outcome"),
    )


def outcome_counts(
    sides: DataFrame, wanted: str, keys: list[str], require_both_roles: bool = True
) -> DataFrame:
    """Matches with the ``wanted`` outcome per key: ``keys, home, away, total``.

    A single aggregate with one conditional count per role; the map side combines, so a team with a
    large part of all matches sends one row per task. With ``require_both_roles`` a key needs the
    outcome at least once at home and once away.
    """
    for key in keys:
        sides = sides.filter(F.col(key).isNotNull())
    counted = (
        sides.filter(F.col("outcome") == wanted)
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("role") == HOME).alias("home"),
            F.count_if(F.col("role") == AWAY).alias("away"),
        )
    )
    if require_both_roles:
        counted = counted.filter((F.col("home") > 0) & (F.col("away") > 0))
    return counted.withColumn("total", F.col("home") + F.col("away"))
