"""Schemas of the raw and the staged tables.

Fixed values: file names, column names and labels below belong to the data
format. They are what files written or read elsewhere carry, so they are kept
letter by letter; everything computed in between uses English names.
"""

from __future__ import annotations

SLOTS = range(1, 12)
HOME_SLOTS = [f"home_player_{i}" for i in SLOTS]
AWAY_SLOTS = [f"away_player_{i}" for i in SLOTS]

# raw skill column -> staged skill column
SKILLS = {
    "crossing": "Cruce",
    "finishing": "Finalizacion",
    "dribbling": "Dribbling",
    "free_kick_accuracy": "Precision_Patada_libre",
    "ball_control": "Control_Pelota",
    "acceleration": "Aceleracion",
    "sprint_speed": "Velocidad_Corriendo",
    "agility": "Agilidad",
    "reactions": "Reacciones",
    "balance": "Balance",
    "shot_power": "Poder_de_Tiro",
    "jumping": "Salto",
    "strength": "Fuerza",
    "aggression": "Agresion",
    "interceptions": "Intercepciones",
    "vision": "Vision",
    "penalties": "Penales",
    "marking": "Marcar",
}

# The nineteen columns whose sum is the strength of one rating row.
STRENGTH_COLUMNS = ["Potencial", *SKILLS.values()]

RAW = {
    "enunciado_paises": "id BIGINT, name STRING",
    "enunciado_jugadores": "player_api_id BIGINT, player_name STRING",
    "enunciado_liga": "name STRING, country_id BIGINT",
    "enunciado_equipos": "team_api_id BIGINT, team_long_name STRING",
    "enunciado_partidos": (
        "match_api_id BIGINT, league_id BIGINT, country_id BIGINT, season STRING, date TIMESTAMP_NTZ, "
        "home_team_api_id BIGINT, away_team_api_id BIGINT, home_team_goal INT, away_team_goal INT, "
        "goal STRING, " + ", ".join(f"{c} DOUBLE" for c in HOME_SLOTS + AWAY_SLOTS)
    ),
    "enunciado_jugadores_atributos": (
        "player_api_id BIGINT, date TIMESTAMP_NTZ, overall_rating DOUBLE, potential DOUBLE, preferred_foot STRING, "
        + ", ".join(f"{c} DOUBLE" for c in SKILLS)
    ),
}

STAGED = {
    "tabla_pais": "Nombre STRING",
    "tabla_jugador": "ID BIGINT, Nombre STRING",
    "tabla_temporada": "Temporada STRING",
    "tabla_liga": "Nombre_liga STRING, Nombre_pais STRING, ID BIGINT",
    "tabla_equipos": "ID_equipo BIGINT, Nombre STRING, ID_liga BIGINT",
    "tabla_goles": "ID_Gol BIGINT, ID_Partido BIGINT, ID_Jugador BIGINT, Tipo STRING, Subtipo STRING",
    "tabla_partidos": (
        "ID_partido BIGINT, ID_liga BIGINT, Temporada STRING, Fecha TIMESTAMP_NTZ, ID_local BIGINT, "
        "ID_visitante BIGINT, Goles_local INT, Goles_visitante INT"
    ),
    "tabla_resultado": "Goles_local INT, Goles_visitante INT, Resultado STRING",
    "tabla_plantel": "Temporada STRING, ID_equipo BIGINT, ID_plantel BIGINT",
    "tabla_conformacion_plantel": "ID_plantel BIGINT, ID_jugador BIGINT",
    "tabla_atributos_jugador": (
        "ID_jugador BIGINT, Fecha TIMESTAMP_NTZ, Puntos_Generales DOUBLE, Potencial DOUBLE, Pie_Preferido STRING, "
        + ", ".join(f"{c} DOUBLE" for c in SKILLS.values())
        + ", Temporada STRING"
    ),
}

# Labels stored in the tables.
WON, LOST, DRAWN = "Ganado", "Perdido", "Empatado"
RELEGATED, PROMOTED = "Descendio", "Ascendio"
OPEN_PLAY, PENALTY_IN_PLAY, SHOOT_OUT = "normal", "penal en juego", "penal por desempate"
OWN_GOAL, UNKNOWN_TYPE, ABSENT = "contragol", "unknown", "-"
PENALTY_TYPES = (PENALTY_IN_PLAY, SHOOT_OUT)
