"""All questions over one set of staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from touchline.plans import charts, players, teams
from touchline.scope import Scope


def answers(tables: dict[str, DataFrame], scope: Scope, country: str) -> dict[str, DataFrame]:
    """The answer to each question by name, not yet computed. ``tables`` holds the staged tables by name,
    as ``read_staged`` returns them. The calendar years are those the seasons touch."""
    matches, names = tables["tabla_partidos"], tables["tabla_equipos"]
    squads, rosters = tables["tabla_plantel"], tables["tabla_conformacion_plantel"]
    people, goals, ratings = tables["tabla_jugador"], tables["tabla_goles"], tables["tabla_atributos_jugador"]
    years = int(scope.seasons[0].split("/")[0]), int(scope.last_season.split("/")[1])
    strength = charts.squad_strength(ratings, rosters, squads, names, scope)
    rated = charts.rated_squads(ratings, rosters, squads, names, scope)
    sides = charts.league_sides(matches, names, scope)
    return {
        "league_lookup": teams.league_id_of(tables["tabla_liga"], country),
        "most_wins": teams.most_wins(matches, names, scope),
        "most_losses_per_season": teams.most_losses_per_season(matches, names, scope),
        "most_draws_last_season": teams.most_draws_last_season(matches, names, scope),
        "most_goals_for": teams.most_goals_for(matches, names, scope),
        "goal_difference": teams.goal_difference(matches, names, scope),
        "squad_sizes": teams.squad_sizes(rosters, squads, names, scope),
        "top_scorers": players.top_scorers(goals, matches, people, scope),
        "player_team_wins": players.player_team_wins(matches, squads, rosters, people, scope),
        "teams_per_player": players.teams_per_player(matches, squads, rosters, people, scope),
        "least_variation_potential": players.least_variation(ratings, rosters, squads, names, scope),
        "least_variation_overall": players.least_variation(
            ratings, rosters, squads, names, scope, "Puntos_Generales"
        ),
        "season_churn": teams.season_churn(matches, names, scope),
        "penalty_leaders": players.penalty_leaders(goals, matches, squads, rosters, names, scope),
        "yearly_goals": charts.yearly_goals(matches, names, scope.league_id, *years, in_all_years=True),
        "avg_goals_season": charts.season_goal_averages(matches, scope),
        "avg_goals_team_season": charts.team_goal_averages(matches, names, scope),
        "attributes_vs_goals": charts.attributes_vs_goals(sides, strength, names),
        "goal_histogram": charts.goal_histogram(sides, rated),
        "goal_histogram_by_team": charts.goal_histogram(sides, rated, teams=names),
        "season_role_totals": teams.season_role_totals(matches, scope),
        "home_team_list": teams.home_team_list(matches, scope),
    }
