"""Raw tables to staged tables; one Spark job per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import goal_subtype, goal_type, goals_of, is_malformed, outcome, parse_document, season_of
from touchline.operators import dense_index
from touchline.schemas import AWAY_SLOTS, HOME_SLOTS, SKILLS
from touchline.session import written


def stage_countries(countries: DataFrame) -> DataFrame:
    return countries.select(F.col("name").alias("Nombre"))


def stage_players(players: DataFrame) -> DataFrame:
    return players.select(F.col("player_api_id").alias("ID"), F.col("player_name").alias("Nombre"))


def stage_seasons(matches: DataFrame) -> DataFrame:
    return matches.select(F.col("season").alias("Temporada")).distinct()


def stage_leagues(leagues: DataFrame, countries: DataFrame, matches: DataFrame) -> DataFrame:
    """League and country names with the league id found in the country's matches.

    Matches shrink to their distinct (country, league) pairs before any join.
    """
    pairs = matches.select("country_id", F.col("league_id").alias("ID")).distinct()
    return (
        leagues.select(F.col("name").alias("Nombre_liga"), "country_id")
        .join(countries.select(F.col("id").alias("country_id"), F.col("name").alias("Nombre_pais")), "country_id")
        .join(pairs, "country_id")
        .select("Nombre_liga", "Nombre_pais", "ID")
        .distinct()
    )


def stage_teams(teams: DataFrame, matches: DataFrame) -> DataFrame:
    """Teams with each league they played at home in. Both inputs are made distinct first, so the join
    brings out every (team, name, league) once."""
    names = teams.select(F.col("team_api_id").alias("ID_equipo"), F.col("team_long_name").alias("Nombre")).distinct()
    hosts = matches.select(
        F.col("home_team_api_id").alias("ID_equipo"), F.col("league_id").alias("ID_liga")
    ).distinct()
    return names.join(hosts, "ID_equipo").select("ID_equipo", "Nombre", "ID_liga")


def stage_matches(matches: DataFrame) -> DataFrame:
    return matches.select(
        F.col("match_api_id").alias("ID_partido"),
        F.col("league_id").alias("ID_liga"),
        F.col("season").alias("Temporada"),
        F.col("date").alias("Fecha"),
        F.col("home_team_api_id").alias("ID_local"),
        F.col("away_team_api_id").alias("ID_visitante"),
        F.col("home_team_goal").alias("Goles_local"),
        F.col("away_team_goal").alias("Goles_visitante"),
    ).distinct()


def stage_outcomes(staged_matches: DataFrame, per_match: bool = False) -> DataFrame:
    """Outcome for the home side by score, or by match and score with ``per_match``."""
    score = ["ID_partido"] if per_match else []
    return staged_matches.select(
        *score,
        "Goles_local",
        "Goles_visitante",
        outcome(F.col("Goles_local"), F.col("Goles_visitante")).alias("Resultado"),
    ).distinct()


def stage_squads(staged_matches: DataFrame) -> DataFrame:
    """A squad is a home team in a season; numbered in the order of season and team."""
    squads = staged_matches.select("Temporada", F.col("ID_local").alias("ID_equipo")).distinct()
    return dense_index(squads, ["Temporada", "ID_equipo"], "ID_plantel")


def line_ups(matches: DataFrame) -> DataFrame:
    """Both sides of each match, in one scan: ``Temporada, ID_equipo`` and the wide line-up columns as one array."""
    sides = F.array(
        F.struct(F.col("home_team_api_id").alias("ID_equipo"), F.array(*HOME_SLOTS).alias("slots")),
        F.struct(F.col("away_team_api_id").alias("ID_equipo"), F.array(*AWAY_SLOTS).alias("slots")),
    )
    return matches.select(F.col("season").alias("Temporada"), F.inline(sides))


#: Places in a line-up that a task makes distinct, if the number of matches is known.
ROSTER_PLACES = 1 << 21


def stage_rosters(matches: DataFrame, squads: DataFrame, match_count: int | None = None) -> DataFrame:
    """Members of each of the ``squads``, all or some. A side whose team has none of them in the season has no roster.

    Sides meet the squads while they are two rows a match. Only then are they players, who are made distinct as two
    numbers: ``distinct`` combines before it shuffles, and spreads a team with a large part of the matches by player.
    Whoever asks for few squads has few players to make distinct.

    With ``match_count``, about how many matches there are, players are shuffled before any of them are combined, to as
    many tasks as keeps ``ROSTER_PLACES`` in each. That is for the rosters of all squads: no task then holds more of
    them in memory when there are more matches.
    """
    seasons = squads.select(F.col("Temporada").alias("its_season"), F.col("ID_equipo").alias("its_team"), "ID_plantel")
    same = (F.col("Temporada") == F.col("its_season")) & (F.col("ID_equipo") == F.col("its_team"))
    members = (
        line_ups(matches)
        .join(seasons, same)
        .select("ID_plantel", F.explode("slots").alias("slot"))
        .select("ID_plantel", F.col("slot").try_cast("bigint").alias("ID_jugador"))
        .filter(F.col("ID_jugador").isNotNull())
    )
    if match_count is not None:
        places = match_count * (len(HOME_SLOTS) + len(AWAY_SLOTS))
        tasks = max(matches.sparkSession.sparkContext.defaultParallelism, 1 + places // ROSTER_PLACES)
        members = members.repartition(tasks, "ID_plantel", "ID_jugador")
    return members.distinct()


def explode_goal_xml(
    documents: DataFrame,
    id_column: str = "match_api_id",
    xml_column: str = "goal",
    malformed: str = "fail",
    players: str = "number",
) -> DataFrame:
    """One row per goal of the distinct (match, document) pairs: ``ID_Gol, ID_Partido, ID_Jugador, Tipo,
    Subtipo``.

    Parsing costs far more than moving the text. So copies are dropped first, on the map side already,
    and the shuffle that takes spreads the parsing evenly, even after a file that cannot be split.

    Text that is not a goal document stops the job with its match id, or is left out with
    ``malformed="skip"`` (``malformed_goal_documents`` lists it).

    ``players`` says what becomes of a player's id that is no number: with ``"number"`` its document is malformed, so
    that no scorer is lost in silence; with ``"text"`` all players' ids are kept as text, in a column of text; with
    ``"null"`` it is null. An empty id is null in any case.
    """
    if malformed not in ("fail", "skip"):
        raise ValueError("malformed must be 'fail' or 'skip'")
    if players not in ("number", "text", "null"):
        raise ValueError("players must be 'number', 'text' or 'null'")
    xml = F.col("xml")
    texts = documents.select(F.col(id_column).alias("ID_Partido"), F.col(xml_column).alias("xml"))
    parsed = texts.filter(xml.isNotNull()).distinct().withColumn("doc", parse_document(xml))
    complaint = F.concat(F.lit("malformed goal document of match "), F.col("ID_Partido").cast("string"))
    rejected = F.raise_error(complaint) if malformed == "fail" else F.lit(None)
    values = F.when(is_malformed(xml, F.col("doc"), players == "number"), rejected).otherwise(goals_of(F.col("doc")))
    goals = parsed.select("ID_Partido", values.alias("goals"))
    # The outer form, for explode alone makes the optimizer add "array not empty" below the distinct,
    # where every document would be parsed once more.
    exploded = goals.select("ID_Partido", F.explode_outer("goals").alias("goal"))
    player = F.col("goal.player1")
    player = F.when(F.trim(player) != "", F.trim(player)) if players == "text" else player.try_cast("bigint")
    return exploded.filter(F.col("goal").isNotNull()).select(
        F.col("goal.id").try_cast("bigint").alias("ID_Gol"),
        "ID_Partido",
        player.alias("ID_Jugador"),
        goal_type(F.col("goal.stats")).alias("Tipo"),
        goal_subtype(F.col("goal.subtype")).alias("Subtipo"),
    )


def malformed_goal_documents(
    documents: DataFrame, id_column: str = "match_api_id", xml_column: str = "goal", players: str = "number"
) -> DataFrame:
    """The documents ``explode_goal_xml`` does not accept."""
    rows = documents.withColumn("_doc", parse_document(F.col(xml_column)))
    return rows.filter(is_malformed(F.col(xml_column), F.col("_doc"), players == "number")).select(id_column, xml_column)


def stage_attributes(ratings: DataFrame, **season_rule) -> DataFrame:
    """Rating rows under their staged names, with the season of their date."""
    return ratings.select(
        F.col("player_api_id").alias("ID_jugador"),
        F.col("date").alias("Fecha"),
        F.col("overall_rating").alias("Puntos_Generales"),
        F.col("potential").alias("Potencial"),
        F.col("preferred_foot").alias("Pie_Preferido"),
        *(F.col(raw).alias(staged) for raw, staged in SKILLS.items()),
        season_of(F.col("date"), **season_rule).alias("Temporada"),
    )


def stage_all(
    raw: dict[str, DataFrame], malformed: str = "fail", landed: bool = False, players: str = "number", **season_rule
) -> dict[str, DataFrame]:
    """Every staged table by name, ready for ``write_tables``.

    Seven tables come from the raw matches. Unless they are ``landed`` in a columnar format already,
    they are copied to one first: the text is read once, and each table then reads its own columns.
    """
    raw_matches = raw["enunciado_partidos"]
    if not landed:
        raw_matches = written(raw_matches)
    matches = stage_matches(raw_matches)
    squads = stage_squads(matches)
    return {
        "tabla_pais": stage_countries(raw["enunciado_paises"]),
        "tabla_jugador": stage_players(raw["enunciado_jugadores"]),
        "tabla_temporada": stage_seasons(raw_matches),
        "tabla_liga": stage_leagues(raw["enunciado_liga"], raw["enunciado_paises"], raw_matches),
        "tabla_equipos": stage_teams(raw["enunciado_equipos"], raw_matches),
        "tabla_goles": explode_goal_xml(raw_matches, malformed=malformed, players=players),
        "tabla_partidos": matches,
        "tabla_resultado": stage_outcomes(matches),
        "tabla_plantel": squads,
        "tabla_conformacion_plantel": stage_rosters(raw_matches, squads, raw_matches.count()),
        "tabla_atributos_jugador": stage_attributes(raw["enunciado_jugadores_atributos"], **season_rule),
    }
