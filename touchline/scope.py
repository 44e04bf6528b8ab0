"""The part of the data a question is asked about."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators import rows_with, rows_within


@dataclass(frozen=True)
class Scope:
    """One league and an ordered list of seasons; the last one is the "last season".

    ``clustered`` says that rosters and goals are stored in the order of their squads and matches, as ``write_tables``
    leaves them. Then it pays to ask for the range of the scope's ids first, so that the scan passes over the rest.
    """

    league_id: int
    seasons: tuple[str, ...]
    clustered: bool = False

    def __post_init__(self):
        if not self.seasons:
            raise ValueError("a scope needs at least one season")
        object.__setattr__(self, "seasons", tuple(self.seasons))

    @property
    def last_season(self) -> str:
        return self.seasons[-1]

    def only_last(self) -> Scope:
        return replace(self, seasons=(self.last_season,))

    def league(self, column: str = "ID_liga") -> Column:
        return F.col(column) == F.lit(self.league_id)

    def season(self, column: str = "Temporada") -> Column:
        return F.col(column).isin(*self.seasons)

    def matches(self, matches: DataFrame) -> DataFrame:
        """Both predicates are plain comparisons on stored columns: they reach the file scan and,
        for matches stored by league and season, skip whole directories."""
        return matches.filter(self.league() & self.season())

    def teams(self, teams: DataFrame) -> DataFrame:
        return teams.filter(self.league()).select("ID_equipo").distinct()

    def squads(self, squads: DataFrame, teams: DataFrame) -> DataFrame:
        """Squads of the seasons whose team plays in the league."""
        return squads.filter(self.season()).join(self.teams(teams), "ID_equipo", "left_semi")

    def near_squads(self, squads: DataFrame, teams: DataFrame, matches: DataFrame) -> DataFrame:
        """Squads of the seasons whose team is listed in the league or played in its matches, on either side. All that
        a question about the scope asks for are among them, whichever of the two it goes by."""
        played = self.matches(matches).select(F.explode(F.array("ID_local", "ID_visitante")).alias("ID_equipo"))
        asked = played.union(self.teams(teams)).distinct()
        return rows_with(squads.filter(self.season()), asked, ["ID_equipo"])

    def near_rosters(self, rosters: DataFrame, squads: DataFrame, teams: DataFrame) -> DataFrame:
        """Roster rows among which all of the scope's squads are; without ``clustered`` all rows."""
        return rows_within(rosters, "ID_plantel", self.squads(squads, teams), "ID_plantel") if self.clustered else rosters

    def near_goals(self, goals: DataFrame, matches: DataFrame) -> DataFrame:
        """Goals among which all of the scope's matches are; without ``clustered`` all goals."""
        return rows_within(goals, "ID_Partido", self.matches(matches), "ID_partido") if self.clustered else goals
