"""DuckDB SQL that answers the driver's queries independently of the Spark plans.

The statements keep to the plain reading of each question: one relation per role, set operators, ``NOT
IN``, ``>= ALL`` and scalar subqueries, where the Spark plans use merged aggregates.
"""

from __future__ import annotations

from touchline.schemas import SKILLS

SEASONS = ("1996/1997", "1997/1998", "1998/1999", "1999/2000")
LAST = SEASONS[-1]
TEAM = "Customer#000000007"
LEAGUE = 2
IN_SEASONS = "(" + ", ".join(f"'{s}'" for s in SEASONS) + ")"
SKILL_COLUMNS = list(SKILLS.values())


def _season(date: str) -> str:
    start = f"(year({date}) - CASE WHEN month({date}) <= 7 THEN 1 ELSE 0 END)"
    return f"CAST({start} AS VARCHAR) || '/' || CAST({start} + 1 AS VARCHAR)"


def _slot(team: str, number: int, gap: int) -> str:
    player = f"({team} * 11 + {number * number} + ID_partido % 3) % (SELECT count(*) FROM part)"
    return f"CASE WHEN (ID_partido + {gap}) % 17 <> 0 THEN {player} END"


def _skill(k: int) -> str:
    value = f"CAST((CAST(floor(l_quantity) AS BIGINT) + {k} * l_linenumber) % 100 AS DOUBLE)"
    return f"CASE WHEN l_linenumber <> 5 THEN {value} END" if k == 5 else value


_SKILLS = ",\n    ".join(f"{_skill(k)} AS {c}" for k, c in enumerate(SKILL_COLUMNS, start=1))
_HOME = ", ".join(_slot("ID_local", i, i) for i in range(1, 12))
_AWAY = ", ".join(_slot("ID_visitante", i, i + 11) for i in range(1, 12))

# relations every statement may use
MODEL = f"""
matches AS (
  SELECT o_orderkey AS ID_partido, o_custkey % 5 AS ID_liga, {_season("o_orderdate")} AS Temporada,
    o_orderdate AS Fecha, o_custkey AS ID_local,
    (o_custkey + 5 * (1 + o_orderkey % 29)) % (SELECT count(*) FROM customer) AS ID_visitante,
    CAST(CAST(floor(o_totalprice) AS BIGINT) % 5 AS INTEGER) AS Goles_local,
    CAST(CAST(floor(o_totalprice / 7) AS BIGINT) % 4 AS INTEGER) AS Goles_visitante
  FROM orders),
scoped AS (SELECT * FROM matches WHERE ID_liga = {LEAGUE} AND Temporada IN {IN_SEASONS}),
teams AS (SELECT c_custkey AS ID_equipo, c_name AS Nombre, c_custkey % 5 AS ID_liga FROM customer),
league_teams AS (SELECT ID_equipo FROM teams WHERE ID_liga = {LEAGUE}),
players AS (SELECT p_partkey AS ID, p_name AS Nombre FROM part),
goals AS (
  SELECT l_orderkey * 10 + l_linenumber AS ID_Gol, l_orderkey AS ID_Partido,
    CASE WHEN l_linenumber <> 7 THEN l_partkey END AS ID_Jugador,
    CASE l_returnflag || l_linestatus WHEN 'NO' THEN 'normal' WHEN 'NF' THEN 'penal en juego'
      WHEN 'RO' THEN 'penal por desempate' WHEN 'RF' THEN 'contragol' WHEN 'AO' THEN 'unknown'
      WHEN 'AF' THEN '-' END AS Tipo,
    CASE WHEN l_linenumber % 2 = 0 THEN 'header' ELSE '-' END AS Subtipo
  FROM lineitem),
attributes AS (
  SELECT l_partkey AS ID_jugador, l_shipdate AS Fecha,
    CASE WHEN l_linenumber <> 7 THEN floor(l_quantity) END AS Puntos_Generales,
    CASE WHEN l_linenumber <> 6 THEN CAST(60 + l_linenumber AS DOUBLE) END AS Potencial,
    CASE WHEN l_linenumber % 2 = 0 THEN 'left' ELSE 'right' END AS Pie_Preferido,
    {_SKILLS},
    {_season("l_shipdate")} AS Temporada
  FROM lineitem),
squads AS (
  SELECT Temporada, ID_equipo, row_number() OVER (ORDER BY Temporada, ID_equipo) - 1 AS ID_plantel
  FROM (SELECT Temporada, ID_local AS ID_equipo FROM matches GROUP BY ALL)),
rosters AS (
  SELECT s.ID_plantel, fielded.ID_jugador
  FROM (
    SELECT Temporada, ID_local AS ID_equipo, unnest([{_HOME}]) AS ID_jugador FROM matches
    UNION
    SELECT Temporada, ID_visitante, unnest([{_AWAY}]) FROM matches) AS fielded
  JOIN squads AS s USING (Temporada, ID_equipo)
  WHERE fielded.ID_jugador IS NOT NULL),
scoped_squads AS (
  SELECT * FROM squads WHERE Temporada IN {IN_SEASONS} AND ID_equipo IN (SELECT ID_equipo FROM league_teams)),
scoped_rosters AS (SELECT r.* FROM rosters AS r JOIN scoped_squads USING (ID_plantel))"""


def _ask(select: str, **relations: str) -> str:
    own = "".join(f",\n{name} AS ({body.strip()})" for name, body in relations.items())
    return f"WITH {MODEL.strip()}{own}\n{select.strip()}"


def _both_roles(home_condition: str, away_condition: str, source: str = "scoped") -> dict[str, str]:
    """Counts per team and season for each role, and their sum where both roles have one."""
    return {
        "at_home": f"SELECT ID_local AS team, Temporada, count(*) AS n FROM {source} WHERE {home_condition} GROUP BY 1, 2",
        "away": f"SELECT ID_visitante AS team, Temporada, count(*) AS n FROM {source} WHERE {away_condition} GROUP BY 1, 2",
        "by_season": "SELECT h.team, h.Temporada, h.n AS h, a.n AS a, h.n + a.n AS n FROM at_home AS h, away AS a "
        "WHERE h.team = a.team AND h.Temporada = a.Temporada",
        "overall": "SELECT h.team, h.n AS h, a.n AS a, h.n + a.n AS n FROM (SELECT team, CAST(sum(n) AS BIGINT) AS n FROM at_home GROUP BY 1) AS h "
        "JOIN (SELECT team, CAST(sum(n) AS BIGINT) AS n FROM away GROUP BY 1) AS a ON h.team = a.team",
    }


_HOME_WINS, _AWAY_WINS = "Goles_local > Goles_visitante", "Goles_visitante > Goles_local"
_WINS = _both_roles(_HOME_WINS, _AWAY_WINS)
_LOSSES = _both_roles(_AWAY_WINS, _HOME_WINS)
_DRAWS = _both_roles("Goles_local = Goles_visitante", "Goles_local = Goles_visitante", "last_season")

_TEAM_GOALS = {
    "scored": "SELECT ID_partido, ID_local AS team, Goles_local AS g FROM scoped "
    "UNION SELECT ID_partido, ID_visitante, Goles_visitante FROM scoped",
    "conceded": "SELECT ID_partido, ID_local AS team, Goles_visitante AS g FROM scoped "
    "UNION SELECT ID_partido, ID_visitante, Goles_local FROM scoped",
    "total_for": "SELECT team, CAST(sum(g) AS BIGINT) AS n FROM scored GROUP BY team",
    "total_against": "SELECT team, CAST(sum(g) AS BIGINT) AS n FROM conceded GROUP BY team",
}

_SCORERS = {
    "tally": "SELECT ID_Jugador, count(*) AS Goles FROM goals "
    "WHERE ID_Partido IN (SELECT ID_partido FROM scoped) GROUP BY ID_Jugador"
}


def _span(column: str, single: bool) -> str:
    guard = "" if single else "HAVING count(*) > 1"
    return (
        f"SELECT ID_jugador, round(max({column}) - min({column})) AS Deltamaxmin FROM attributes "
        f"WHERE {column} IS NOT NULL AND ID_jugador IN (SELECT ID_jugador FROM scoped_rosters) GROUP BY 1 {guard}"
    )


_LEAST = "SELECT * FROM span WHERE Deltamaxmin = (SELECT min(Deltamaxmin) FROM span)"


def _teams_of(season: str) -> str:
    return f"(SELECT ID_local AS t FROM scoped WHERE Temporada = '{season}' UNION SELECT ID_visitante FROM scoped WHERE Temporada = '{season}')"


def _missing(present: str, absent: str, label: str, state: str) -> str:
    return f"SELECT t, '{label}' AS season, '{state}' AS state FROM {_teams_of(present)} WHERE t NOT IN {_teams_of(absent)}"


_PAIRS = list(zip(SEASONS, SEASONS[1:]))
_GONE = " UNION ".join(_missing(s, n, s, "Descendio") for s, n in _PAIRS)
_CHURN = _GONE + " UNION " + " UNION ".join(_missing(n, s, n, "Ascendio") for s, n in _PAIRS)


def _penalties(types: str, squads: str, on: str) -> dict[str, str]:
    return {
        "kicks": f"SELECT g.ID_Jugador, m.Temporada FROM goals AS g JOIN scoped AS m ON m.ID_partido = g.ID_Partido WHERE g.Tipo IN ({types})",
        "per_team": f"SELECT s.ID_equipo, count(*) AS n FROM kicks AS k JOIN rosters AS r ON r.ID_jugador = k.ID_Jugador "
        f"JOIN {squads} AS s ON s.ID_plantel = r.ID_plantel WHERE {on} GROUP BY 1",
    }


_BOTH_PENALTIES = _penalties("'penal en juego', 'penal por desempate'", "scoped_squads", "s.Temporada = k.Temporada")
_PLAYER_WINS = {
    **_WINS,
    "won": "SELECT r.ID_jugador, CAST(sum(w.n) AS BIGINT) AS n FROM by_season AS w "
    "JOIN squads AS s ON s.ID_equipo = w.team AND s.Temporada = w.Temporada JOIN rosters AS r USING (ID_plantel) GROUP BY 1",
}


def _belonged(what: str) -> dict[str, str]:
    return {
        "hosts": "SELECT DISTINCT ID_local AS ID_equipo, Temporada FROM scoped",
        "belonged": f"SELECT r.ID_jugador, count({what} s.ID_equipo) AS n FROM hosts AS h "
        "JOIN squads AS s ON s.ID_equipo = h.ID_equipo AND s.Temporada = h.Temporada JOIN rosters AS r USING (ID_plantel) GROUP BY 1",
    }


_PENALTY_ANSWER = """
SELECT Nombre, n AS penales_a_favor FROM per_team JOIN teams USING (ID_equipo)
WHERE n = (SELECT max(n) FROM per_team)"""

_YEAR_SIDES = {
    "dated": f"SELECT *, CAST(year(Fecha) AS INTEGER) AS anio FROM matches WHERE ID_liga = {LEAGUE} AND year(Fecha) IN (1996, 1997, 1998, 1999, 2000)",
    "gf": "SELECT ID_partido, anio, ID_local AS t, Goles_local AS g FROM dated UNION SELECT ID_partido, anio, ID_visitante, Goles_visitante FROM dated",
    "ga": "SELECT ID_partido, anio, ID_local AS t, Goles_visitante AS g FROM dated UNION SELECT ID_partido, anio, ID_visitante, Goles_local FROM dated",
    "yearly": "SELECT gf.anio, gf.t AS ID_equipo, CAST(sum(gf.g) AS BIGINT) AS total_goles_a_favor, "
    "CAST(sum(ga.g) AS BIGINT) AS total_goles_en_contra FROM gf JOIN ga ON gf.ID_partido = ga.ID_partido AND gf.t = ga.t GROUP BY 1, 2",
    "steady": "SELECT ID_equipo FROM yearly GROUP BY 1 HAVING count(DISTINCT anio) = 5",
}
_YEARLY = "SELECT anio, ID_equipo, Nombre, total_goles_a_favor, total_goles_en_contra FROM yearly JOIN teams USING (ID_equipo)"

_GOALS_PER_SIDE = {
    "sides": "SELECT ID_local AS ID_equipo, Temporada, Goles_local AS g FROM scoped "
    "UNION ALL SELECT ID_visitante, Temporada, Goles_visitante FROM scoped"
}

_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ["Potencial", *SKILL_COLUMNS])
_STRENGTH = " + ".join(["Potencial", *SKILL_COLUMNS])
_QUALIFIED = {
    "rated": f"SELECT ID_jugador, Temporada, {_STRENGTH} AS strength FROM attributes WHERE {_COMPLETE}",
    "played": f"SELECT DISTINCT m.* FROM matches AS m, league_teams AS l "
    f"WHERE (m.ID_local = l.ID_equipo OR m.ID_visitante = l.ID_equipo) AND m.Temporada IN {IN_SEASONS}",
}
_BY_SEASON = {
    **_QUALIFIED,
    "squad_strength": "SELECT s.ID_plantel, s.ID_equipo, s.Temporada, sum(a.strength) AS total FROM scoped_squads AS s "
    "JOIN rosters AS r ON r.ID_plantel = s.ID_plantel JOIN rated AS a ON a.ID_jugador = r.ID_jugador AND a.Temporada = s.Temporada GROUP BY 1, 2, 3",
    "pairs": "SELECT q.ID_plantel, q.ID_equipo, p.ID_partido, p.Goles_local AS Goles, q.total FROM played AS p "
    "JOIN squad_strength AS q ON q.ID_equipo = p.ID_local AND q.Temporada = p.Temporada "
    "UNION SELECT q.ID_plantel, q.ID_equipo, p.ID_partido, p.Goles_visitante, q.total FROM played AS p "
    "JOIN squad_strength AS q ON q.ID_equipo = p.ID_visitante AND q.Temporada = p.Temporada",
}
_SEASON_FREE = {
    **_QUALIFIED,
    "repeated": "SELECT a.ID_jugador, a.strength FROM rated AS a JOIN scoped_rosters AS r ON r.ID_jugador = a.ID_jugador",
    "per_player": "SELECT ID_jugador, sum(strength) AS strength FROM repeated GROUP BY 1",
    "squad_strength": "SELECT s.ID_plantel, s.ID_equipo, sum(a.strength) AS total FROM squads AS s "
    "JOIN rosters AS r ON r.ID_plantel = s.ID_plantel JOIN per_player AS a ON a.ID_jugador = r.ID_jugador GROUP BY 1, 2",
    "pairs": "SELECT q.ID_plantel, q.ID_equipo, p.ID_partido, p.Goles_local AS Goles, q.total FROM played AS p "
    "JOIN squad_strength AS q ON q.ID_equipo = p.ID_local "
    "UNION SELECT q.ID_plantel, q.ID_equipo, p.ID_partido, p.Goles_local, q.total FROM played AS p "
    "JOIN squad_strength AS q ON q.ID_equipo = p.ID_visitante",
}
_RATIO = """
SELECT t.Nombre, CAST(sum(p.Goles) AS DOUBLE) / count(p.ID_partido) AS Ratio_Goles, avg(p.total) AS Suma_Atributos
FROM pairs AS p JOIN teams AS t USING (ID_equipo) GROUP BY t.Nombre"""

_ATTRIBUTE_COLUMNS = "ID_jugador, Fecha, Puntos_Generales, Potencial, Pie_Preferido, " + ", ".join(SKILL_COLUMNS)

ORACLES: dict[str, str] = {
    "league_lookup": "SELECT CAST(r_regionkey AS BIGINT) AS ID_liga FROM region WHERE r_name = 'ASIA'",
    "team_wins": _ask(
        "SELECT team AS ID_equipo, h AS Ganados_local, a AS Ganados_visitante, n AS Ganados FROM overall", **_WINS
    ),
    "team_wins_by_season": _ask(
        "SELECT team AS ID_equipo, Temporada, h AS Ganados_local, a AS Ganados_visitante, n AS Ganados FROM by_season",
        **_WINS,
    ),
    "team_losses_by_season": _ask(
        "SELECT team AS ID_equipo, Temporada, h AS Perdidos_local, a AS Perdidos_visitante, n AS Perdidos_totales FROM by_season",
        **_LOSSES,
    ),
    "team_losses_either_role": _ask(
        """SELECT team AS ID_equipo, Temporada, count(*) FILTER (at_home) AS Perdidos_local,
        count(*) FILTER (NOT at_home) AS Perdidos_visitante, count(*) AS Perdidos_totales FROM lost GROUP BY 1, 2""",
        lost=f"SELECT ID_local AS team, Temporada, true AS at_home FROM scoped WHERE {_AWAY_WINS} "
        f"UNION ALL SELECT ID_visitante, Temporada, false FROM scoped WHERE {_HOME_WINS}",
    ),
    "team_draws_either_role": _ask(
        """SELECT team AS ID_equipo, count(*) FILTER (at_home) AS Empatados_local,
        count(*) FILTER (NOT at_home) AS Empatados_visitante, count(*) AS Empatados FROM drawn GROUP BY 1""",
        level=f"SELECT * FROM scoped WHERE Temporada = '{LAST}' AND Goles_local = Goles_visitante",
        drawn="SELECT ID_local AS team, true AS at_home FROM level UNION ALL SELECT ID_visitante, false FROM level",
    ),
    "team_draws_last_season": _ask(
        "SELECT team AS ID_equipo, h AS Empatados_local, a AS Empatados_visitante, n AS Empatados FROM overall",
        last_season=f"SELECT * FROM scoped WHERE Temporada = '{LAST}'",
        **_DRAWS,
    ),
    "team_goals": _ask(
        """SELECT team AS ID_equipo, f.n AS Goles_totales, a.n AS Goles_en_contra_totales
        FROM total_for AS f JOIN total_against AS a USING (team)""",
        **_TEAM_GOALS,
    ),
    "teams_by_season": _ask(
        "SELECT ID_local AS team, Temporada AS season FROM scoped UNION SELECT ID_visitante, Temporada FROM scoped"
    ),
    "most_wins": _ask(
        "SELECT Nombre FROM overall JOIN teams ON team = ID_equipo WHERE n = (SELECT max(n) FROM overall)", **_WINS
    ),
    "most_wins_either_role": _ask(
        "SELECT Nombre FROM wins JOIN teams ON team = ID_equipo WHERE n >= ALL (SELECT n FROM wins)",
        wins=f"SELECT team, count(*) AS n FROM (SELECT ID_local AS team FROM scoped WHERE {_HOME_WINS} "
        f"UNION ALL SELECT ID_visitante FROM scoped WHERE {_AWAY_WINS}) GROUP BY 1",
    ),
    "most_losses_per_season": _ask(
        """SELECT Nombre, x.Temporada, x.n AS Perdidos_totales FROM by_season AS x JOIN teams ON x.team = ID_equipo
        WHERE x.n >= ALL (SELECT y.n FROM by_season AS y WHERE y.Temporada = x.Temporada)""",
        **_LOSSES,
    ),
    "most_draws_last_season": _ask(
        "SELECT Nombre FROM overall JOIN teams ON team = ID_equipo WHERE n = (SELECT max(n) FROM overall)",
        last_season=f"SELECT * FROM scoped WHERE Temporada = '{LAST}'",
        **_DRAWS,
    ),
    "most_goals_for": _ask(
        """SELECT ID_equipo, Nombre, n AS Goles_totales FROM total_for JOIN teams ON team = ID_equipo
        WHERE n = (SELECT max(n) FROM total_for)""",
        **_TEAM_GOALS,
    ),
    "goal_difference": _ask(
        """SELECT ID_equipo, Nombre, abs(f.n - a.n) AS Diferencia_goles
        FROM total_for AS f JOIN total_against AS a USING (team) JOIN teams ON team = ID_equipo""",
        **_TEAM_GOALS,
    ),
    "goal_difference_top_only": _ask(
        """SELECT ID_equipo, Nombre, abs(f.n - a.n) AS Diferencia_goles
        FROM total_for AS f JOIN total_against AS a USING (team) JOIN teams ON team = ID_equipo
        WHERE f.n = (SELECT max(n) FROM total_for)""",
        **_TEAM_GOALS,
    ),
    "squad_sizes": _ask(
        """SELECT s.ID_equipo, t.Nombre, s.ID_plantel, count(r.ID_jugador) AS Cantidad_Jugadores
        FROM scoped_rosters AS r JOIN squads AS s USING (ID_plantel) JOIN teams AS t ON t.ID_equipo = s.ID_equipo
        GROUP BY 1, 2, 3"""
    ),
    "season_churn": _ask(
        """SELECT e.ID_equipo, e.Nombre, season AS Temporada, state AS Estado
        FROM churn JOIN teams AS e ON e.ID_equipo = churn.t""",
        churn=_CHURN,
    ),
    "absent_next_season": _ask("SELECT t AS ID_equipo, season AS Temporada FROM gone", gone=_GONE),
    "season_role_totals": _ask(
        """SELECT Temporada, CAST(sum(Goles_local) AS BIGINT) AS Goles_local,
        CAST(sum(Goles_visitante) AS BIGINT) AS Goles_visitante FROM scoped GROUP BY 1"""
    ),
    "home_team_list": _ask("SELECT ID_local FROM scoped"),
    "scoped_rosters": _ask("SELECT * FROM scoped_rosters"),
    "player_goals": _ask("SELECT ID_Jugador AS ID_jugador, Goles FROM tally", **_SCORERS),
    "player_goals_named": _ask("SELECT ID_Jugador AS ID_jugador, Goles FROM tally WHERE ID_Jugador IS NOT NULL", **_SCORERS),
    "player_wins": _ask("SELECT ID_jugador, n AS Total_Ganados FROM won", **_PLAYER_WINS),
    "player_team_counts": _ask("SELECT ID_jugador, n AS Cantidad_equipos FROM belonged", **_belonged("DISTINCT")),
    "rating_spans": _ask("SELECT * FROM span", span=_span("Potencial", single=False)),
    "penalty_goals": _ask(
        """SELECT m.ID_partido, g.ID_Jugador AS ID_jugador, m.Temporada FROM goals AS g, scoped AS m
        WHERE m.ID_partido = g.ID_Partido AND (g.Tipo = 'penal en juego' OR g.Tipo = 'penal por desempate')"""
    ),
    "team_penalties": _ask("SELECT ID_equipo, n AS penales_a_favor FROM per_team", **_BOTH_PENALTIES),
    "top_scorer": _ask(
        """SELECT Nombre, Goles FROM tally JOIN players ON ID = ID_Jugador
        WHERE Goles = (SELECT max(Goles) FROM tally WHERE ID_Jugador IS NOT NULL)""",
        **_SCORERS,
    ),
    "top_scorer_nameless_competes": _ask(
        "SELECT Nombre, Goles FROM tally JOIN players ON ID = ID_Jugador WHERE Goles = (SELECT max(Goles) FROM tally)",
        **_SCORERS,
    ),
    "player_team_wins": _ask(
        """SELECT ID_jugador, Nombre, n AS Total_Ganados FROM won JOIN players ON ID = ID_jugador
        WHERE n = (SELECT max(n) FROM won)""",
        **_PLAYER_WINS,
    ),
    **{
        name: _ask(
            """SELECT ID_jugador, Nombre, n AS Cantidad_equipos FROM belonged JOIN players ON ID = ID_jugador
            WHERE n = (SELECT max(n) FROM belonged)""",
            **_belonged(what),
        )
        for name, what in (("teams_per_player", "DISTINCT"), ("squads_per_player", ""))
    },
    "least_variation_potential": _ask(_LEAST, span=_span("Potencial", single=False)),
    "least_variation_overall": _ask(_LEAST, span=_span("Puntos_Generales", single=False)),
    "least_variation_global_guard": _ask(
        _LEAST,
        raw="SELECT r.ID_jugador, a.Potencial FROM attributes AS a JOIN scoped_rosters AS r ON r.ID_jugador = a.ID_jugador WHERE a.Potencial IS NOT NULL",
        span="SELECT ID_jugador, round(max(Potencial) - min(Potencial)) AS Deltamaxmin FROM raw WHERE 1 < (SELECT count(*) FROM raw) GROUP BY 1",
    ),
    "least_variation_overall_global_guard": _ask(
        _LEAST,
        raw="SELECT r.ID_jugador, a.Puntos_Generales FROM attributes AS a JOIN scoped_rosters AS r ON r.ID_jugador = a.ID_jugador WHERE a.Puntos_Generales IS NOT NULL",
        span="SELECT ID_jugador, round(max(Puntos_Generales) - min(Puntos_Generales)) AS Deltamaxmin FROM raw WHERE 1 < (SELECT count(*) FROM raw) GROUP BY 1",
    ),
    "penalty_leaders_shoot_out": _ask(
        _PENALTY_ANSWER, **_penalties("'penal por desempate'", "scoped_squads", "s.Temporada = k.Temporada")
    ),
    "penalty_leaders": _ask(
        _PENALTY_ANSWER,
        **_BOTH_PENALTIES,
    ),
    "penalty_leaders_fixed_season": _ask(
        _PENALTY_ANSWER, **_penalties("'penal por desempate'", "squads", f"s.Temporada = '{LAST}'")
    ),
    "yearly_goals": _ask(_YEARLY, **_YEAR_SIDES),
    "yearly_goals_steady_teams": _ask(_YEARLY + " WHERE ID_equipo IN (SELECT ID_equipo FROM steady)", **_YEAR_SIDES),
    "teams_in_all_years": _ask("SELECT ID_equipo FROM steady", **_YEAR_SIDES),
    "avg_goals_season": _ask("SELECT Temporada, avg(g) AS Promedio_gol FROM sides GROUP BY 1", **_GOALS_PER_SIDE),
    "avg_goals_team_season": _ask(
        """SELECT ID_equipo, Nombre, Temporada, avg(g) AS Promedio_gol FROM sides JOIN teams USING (ID_equipo)
        GROUP BY 1, 2, 3""",
        **_GOALS_PER_SIDE,
    ),
    "avg_goals_one_team": _ask(
        f"""SELECT ID_equipo, Nombre, Temporada, avg(g) AS Promedio_gol FROM sides JOIN teams USING (ID_equipo)
        WHERE Nombre = '{TEAM}' GROUP BY 1, 2, 3""",
        **_GOALS_PER_SIDE,
    ),
    "squad_strength": _ask(
        "SELECT ID_plantel, ID_equipo, Temporada, total AS Suma_Atributos_Plantel FROM squad_strength", **_BY_SEASON
    ),
    "squad_strength_season_free": _ask(
        """SELECT ID_plantel, s.ID_equipo, s.Temporada, total AS Suma_Atributos_Plantel
        FROM squad_strength JOIN squads AS s USING (ID_plantel)""",
        **_SEASON_FREE,
    ),
    "league_sides": _ask(
        """SELECT ID_partido, Temporada, ID_local AS ID_equipo, Goles_local AS Goles FROM played
        UNION ALL SELECT ID_partido, Temporada, ID_visitante, Goles_visitante FROM played""",
        **_QUALIFIED,
    ),
    "squad_match_goals": _ask(
        "SELECT ID_plantel, ID_partido, Goles, total AS Suma_Atributos_Plantel FROM pairs", **_BY_SEASON
    ),
    "attributes_vs_goals": _ask(_RATIO, **_BY_SEASON),
    "attributes_vs_goals_season_free": _ask(_RATIO, **_SEASON_FREE),
    "goal_histogram": _ask("SELECT Goles, count(*) AS Partidos FROM pairs GROUP BY 1", **_BY_SEASON),
    "goal_histogram_by_team": _ask(
        "SELECT Nombre, Goles, count(*) AS Partidos FROM pairs JOIN teams USING (ID_equipo) GROUP BY 1, 2", **_BY_SEASON
    ),
    "goal_histogram_one_team": _ask(
        f"SELECT Nombre, Goles, count(*) AS Partidos FROM pairs JOIN teams USING (ID_equipo) WHERE Nombre = '{TEAM}' GROUP BY 1, 2",
        **_BY_SEASON,
    ),
    "goal_histogram_season_free_by_team": _ask(
        "SELECT Nombre, Goles, count(*) AS Partidos FROM pairs JOIN teams USING (ID_equipo) GROUP BY 1, 2", **_SEASON_FREE
    ),
    "goal_histogram_season_free": _ask("SELECT Goles, count(*) AS Partidos FROM pairs GROUP BY 1", **_SEASON_FREE),
    "stage_country": "SELECT r_name AS Nombre FROM region",
    "stage_player": "SELECT p_partkey AS ID, p_name AS Nombre FROM part",
    "stage_season": _ask("SELECT DISTINCT Temporada FROM matches"),
    "stage_league": _ask(
        """SELECT DISTINCT r.r_name || ' League' AS Nombre_liga, r.r_name AS Nombre_pais, m.ID_liga AS ID
        FROM region AS r JOIN matches AS m ON m.ID_liga = r.r_regionkey"""
    ),
    "stage_team": _ask(
        """SELECT DISTINCT t.ID_equipo, t.Nombre, m.ID_liga FROM teams AS t JOIN matches AS m ON m.ID_local = t.ID_equipo"""
    ),
    "stage_matches": _ask("SELECT DISTINCT * FROM matches"),
    "stage_outcomes": _ask(
        """SELECT DISTINCT Goles_local, Goles_visitante, CASE sign(Goles_local - Goles_visitante)
        WHEN 1 THEN 'Ganado' WHEN -1 THEN 'Perdido' ELSE 'Empatado' END AS Resultado FROM matches"""
    ),
    "stage_outcomes_per_match": _ask(
        """SELECT ID_partido, Goles_local, Goles_visitante, CASE sign(Goles_local - Goles_visitante)
        WHEN 1 THEN 'Ganado' WHEN -1 THEN 'Perdido' ELSE 'Empatado' END AS Resultado FROM matches"""
    ),
    "stage_squads": _ask("SELECT * FROM squads"),
    "stage_rosters": _ask("SELECT * FROM rosters"),
    "stage_goals_xml": _ask(
        """SELECT * FROM documents UNION ALL
        SELECT -ID_Gol, ID_Partido, NULL, 'contragol', NULL FROM documents WHERE ID_Gol % 3 = 0""",
        documents="SELECT DISTINCT * FROM goals",
    ),
    "stage_attributes": _ask("SELECT * FROM attributes"),
    "stage_attributes_held_seasons": _ask(
        f"""SELECT {_ATTRIBUTE_COLUMNS}, CASE WHEN year(Fecha) < 1996 OR year(Fecha) > 2000 THEN NULL
        WHEN Temporada = '1995/1996' THEN '1996/1997' WHEN Temporada = '2000/2001' THEN '1999/2000'
        ELSE Temporada END AS Temporada FROM attributes"""
    ),
}
