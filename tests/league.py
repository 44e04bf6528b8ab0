"""Small staged tables written by hand."""

from __future__ import annotations

import datetime as dt

from touchline.schemas import SKILLS, STAGED
from touchline.scope import Scope

S1, S2, S3, S4 = "2012/2013", "2013/2014", "2014/2015", "2015/2016"
SCOPE = Scope(1, (S1, S2, S3, S4))


def table(spark, name, rows):
    return spark.createDataFrame(rows, STAGED[name])


def matches(spark, rows):
    """Rows of (season, home, away, home goals, away goals[, league[, date]])."""
    full = []
    for number, (season, home, away, scored, conceded, *rest) in enumerate(rows, start=1):
        league = rest[0] if rest else 1
        date = rest[1] if len(rest) > 1 else dt.datetime(int(season[:4]) if season else 2000, 9, 1)
        full.append((number, league, season, date, home, away, scored, conceded))
    return table(spark, "tabla_partidos", full)


def teams(spark, *rows):
    """Rows of (team[, name[, league]])."""
    full = []
    for team, *rest in rows:
        full.append((team, rest[0] if rest else f"T{team}", rest[1] if len(rest) > 1 else 1))
    return table(spark, "tabla_equipos", full)


def players(spark, *ids):
    return table(spark, "tabla_jugador", [(i, f"P{i}") for i in ids])


def squads(spark, *rows):
    """Rows of (season, team); ids are given in this order."""
    return table(spark, "tabla_plantel", [(season, team, i) for i, (season, team) in enumerate(rows)])


def rosters(spark, members):
    """Squad id -> players."""
    return table(spark, "tabla_conformacion_plantel", [(s, p) for s, ps in members.items() for p in ps])


def goals(spark, rows):
    """Rows of (match, player, type)."""
    return table(spark, "tabla_goles", [(i, m, p, kind, "-") for i, (m, p, kind) in enumerate(rows, start=1)])


def ratings(spark, rows):
    """Rows of (player, season, potential[, value of every skill[, overall]])."""
    full = []
    for player, season, potential, *rest in rows:
        skill = rest[0] if rest else 1.0
        overall = rest[1] if len(rest) > 1 else potential
        full.append((player, dt.datetime(2013, 1, 1), overall, potential, "left", *[skill] * len(SKILLS), season))
    return table(spark, "tabla_atributos_jugador", full)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
