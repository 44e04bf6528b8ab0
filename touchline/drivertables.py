"""The driver's tables in the roles of a league.

Orders are matches, customers are teams, parts are players and line items are goals and ratings. Every
column is arithmetic on the given tables, so the work of a query grows with them.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import season_of
from touchline.plans.staging import stage_attributes, stage_rosters, stage_squads
from touchline.schemas import (
    ABSENT,
    AWAY_SLOTS,
    HOME_SLOTS,
    OPEN_PLAY,
    OWN_GOAL,
    PENALTY_IN_PLAY,
    SHOOT_OUT,
    SKILLS,
    SLOTS,
    UNKNOWN_TYPE,
)
from touchline.scope import Scope

SCOPE = Scope(2, ("1996/1997", "1997/1998", "1998/1999", "1999/2000"))
FIRST_YEAR, LAST_YEAR = 1996, 2000
LEAGUES = 5
COUNTRY = "ASIA"
# A team of the scope's league.
TEAM = "Customer#000000007"

# (return flag, line status) -> type of goal
GOAL_TYPES = {
    "NO": OPEN_PLAY,
    "NF": PENALTY_IN_PLAY,
    "RO": SHOOT_OUT,
    "RF": OWN_GOAL,
    "AO": UNKNOWN_TYPE,
    "AF": ABSENT,
}

# type of goal -> the tags inside its statistics; no statistics at all for a type not listed
STATS_TAGS = {
    OPEN_PLAY: "<goals>1</goals><shoton>1</shoton>",
    PENALTY_IN_PLAY: "<goals>1</goals><penalty>1</penalty>",
    SHOOT_OUT: "<penalties>1</penalties>",
    OWN_GOAL: "<owngoals>1</owngoals>",
    UNKNOWN_TYPE: "<corners>1</corners>",
}


def _by_flags(values: dict[str, str]) -> Column:
    """The value for a line item's return flag and line status."""
    flags = F.concat("l_returnflag", "l_linestatus")
    chosen = F
    for pair, value in values.items():
        chosen = chosen.when(flags == pair, value)
    return chosen


class DriverTables:
    """Raw and staged league tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, directory: str):
        def read(table: str) -> DataFrame:
            return spark.read.parquet(f"{directory}/{table}.parquet")

        self.orders, self.customer, self.part = read("orders"), read("customer"), read("part")
        self.lineitem, self.region = read("lineitem"), read("region")
        # counted once, when the tables are opened, as their schemas are read
        self.team_count, self.player_count = self.customer.count(), self.part.count()
        self.match_count = self.orders.count()

    # ---- raw tables -------------------------------------------------------------------------

    @cached_property
    def raw_countries(self) -> DataFrame:
        return self.region.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"))

    @cached_property
    def raw_leagues(self) -> DataFrame:
        return self.region.select(
            F.concat("r_name", F.lit(" League")).alias("name"), F.col("r_regionkey").cast("bigint").alias("country_id")
        )

    @cached_property
    def raw_players(self) -> DataFrame:
        return self.part.select(F.col("p_partkey").alias("player_api_id"), F.col("p_name").alias("player_name"))

    @cached_property
    def raw_teams(self) -> DataFrame:
        return self.customer.select(F.col("c_custkey").alias("team_api_id"), F.col("c_name").alias("team_long_name"))

    @cached_property
    def raw_matches(self) -> DataFrame:
        away = (F.col("o_custkey") + 5 * (1 + F.col("o_orderkey") % 29)) % self.team_count
        bare = self.orders.select(
            F.col("o_orderkey").alias("match_api_id"),
            (F.col("o_custkey") % LEAGUES).alias("league_id"),
            (F.col("o_custkey") % LEAGUES).alias("country_id"),
            season_of(F.col("o_orderdate")).alias("season"),
            F.col("o_orderdate").alias("date"),
            F.col("o_custkey").alias("home_team_api_id"),
            away.alias("away_team_api_id"),
            (F.floor("o_totalprice") % 5).cast("int").alias("home_team_goal"),
            (F.floor(F.col("o_totalprice") / 7) % 4).cast("int").alias("away_team_goal"),
        )
        # what all slots of a side share is computed once
        match, odd = F.col("match_api_id"), F.col("match_api_id") % 3
        shared = bare.select(
            "*",
            (F.col("home_team_api_id") * 11 + odd).alias("home_base"),
            (F.col("away_team_api_id") * 11 + odd).alias("away_base"),
            (match % 17).alias("rest"),
        )
        return shared.select(
            *bare.columns,
            *(self._slot("home_base", i, i).alias(c) for i, c in zip(SLOTS, HOME_SLOTS)),
            *(self._slot("away_base", i, i + 11).alias(c) for i, c in zip(SLOTS, AWAY_SLOTS)),
        )

    def _slot(self, base: str, number: int, gap: int) -> Column:
        """A player, or nobody where (match + gap) is divisible by 17."""
        player = (F.col(base) + number * number) % self.player_count
        return F.when(F.col("rest") != -gap % 17, player.cast("double"))

    @cached_property
    def raw_ratings(self) -> DataFrame:
        quantity, line = F.floor("l_quantity"), F.col("l_linenumber")

        def skill(k: int) -> Column:
            value = ((quantity + k * line) % 100).cast("double")
            return F.when(line != 5, value) if k == 5 else value

        return self.lineitem.select(
            F.col("l_partkey").alias("player_api_id"),
            F.col("l_shipdate").alias("date"),
            F.when(line != 7, quantity.cast("double")).alias("overall_rating"),
            F.when(line != 6, (60 + line).cast("double")).alias("potential"),
            F.when(line % 2 == 0, "left").otherwise("right").alias("preferred_foot"),
            *(skill(k).alias(c) for k, c in enumerate(SKILLS, start=1)),
        )

    @cached_property
    def goal_documents(self) -> DataFrame:
        """One document per line item: its goal and, for every third one, an own goal without player
        whose subtype is empty."""
        number = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("number")
        line = F.col("l_linenumber")
        tags = {flags: f"<stats>{STATS_TAGS[kind]}</stats>" for flags, kind in GOAL_TYPES.items() if kind in STATS_TAGS}
        parts = self.lineitem.select(
            F.col("l_orderkey").alias("match_api_id"),
            number,
            number.cast("string").alias("id"),
            F.when(line != 7, F.concat(F.lit("<player1>"), F.col("l_partkey").cast("string"), F.lit("</player1>")))
            .otherwise("").alias("player"),
            _by_flags(tags).otherwise("").alias("stats"),
            F.when(line % 2 == 0, "<subtype>header</subtype>").otherwise("").alias("subtype"),
        )
        second = F.when(
            F.col("number") % 3 == 0,
            F.concat(F.lit("<value><id>-"), "id", F.lit("</id><subtype/><stats><owngoals/></stats></value>")),
        ).otherwise("")
        document = F.concat(
            F.lit("<goal><value><comment>n</comment>"), "stats", "player", "subtype",
            F.lit("<id>"), "id", F.lit("</id></value>"), second, F.lit("</goal>"),
        )
        return parts.select("match_api_id", document.alias("goal"))

    # ---- staged tables ----------------------------------------------------------------------

    @cached_property
    def matches(self) -> DataFrame:
        """Order keys are unique, so the staged matches need no ``distinct``."""
        return self.raw_matches.select(
            F.col("match_api_id").alias("ID_partido"),
            F.col("league_id").alias("ID_liga"),
            F.col("season").alias("Temporada"),
            F.col("date").alias("Fecha"),
            F.col("home_team_api_id").alias("ID_local"),
            F.col("away_team_api_id").alias("ID_visitante"),
            F.col("home_team_goal").alias("Goles_local"),
            F.col("away_team_goal").alias("Goles_visitante"),
        )

    @cached_property
    def teams(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("ID_equipo"),
            F.col("c_name").alias("Nombre"),
            (F.col("c_custkey") % LEAGUES).alias("ID_liga"),
        )

    @cached_property
    def leagues(self) -> DataFrame:
        return self.region.select(
            F.concat("r_name", F.lit(" League")).alias("Nombre_liga"),
            F.col("r_name").alias("Nombre_pais"),
            F.col("r_regionkey").cast("bigint").alias("ID"),
        )

    @cached_property
    def players(self) -> DataFrame:
        return self.part.select(F.col("p_partkey").alias("ID"), F.col("p_name").alias("Nombre"))

    @cached_property
    def goals(self) -> DataFrame:
        return self.lineitem.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID_Gol"),
            F.col("l_orderkey").alias("ID_Partido"),
            F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("ID_Jugador"),
            _by_flags(GOAL_TYPES).alias("Tipo"),
            F.when(F.col("l_linenumber") % 2 == 0, "header").otherwise(ABSENT).alias("Subtipo"),
        )

    @cached_property
    def attributes(self) -> DataFrame:
        return stage_attributes(self.raw_ratings)

    # Squads are kept by the executors once a question has needed them: nothing is written or run while planning, and
    # what is lost with an executor is made again from the orders. Rosters are made inside each question's plan, of no
    # more squads than it can ask for: the rosters of all of them are many times the matches.

    @cached_property
    def squads(self) -> DataFrame:
        return stage_squads(self.matches).persist()

    @cached_property
    def rosters(self) -> DataFrame:
        """Of all squads."""
        return stage_rosters(self.raw_matches, self.squads, self.match_count)

    @cached_property
    def scope_rosters(self) -> DataFrame:
        """Of the squads that a question about the scope can ask for."""
        return stage_rosters(self.raw_matches, SCOPE.near_squads(self.squads, self.teams, self.matches))

    @cached_property
    def last_rosters(self) -> DataFrame:
        """Of all squads, of any league, of the scope's last season."""
        return stage_rosters(self.raw_matches, self.squads.filter(SCOPE.only_last().season()))


@cache
def driver_tables(spark: SparkSession, directory: str) -> DriverTables:
    return DriverTables(spark, directory)
