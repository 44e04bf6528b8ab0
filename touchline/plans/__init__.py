from touchline.plans.charts import (
    attributes_vs_goals,
    goal_averages,
    goal_histogram,
    league_sides,
    rated_squads,
    season_goal_averages,
    squad_match_goals,
    squad_strength,
    team_goal_averages,
    teams_in_all_years,
    yearly_goals,
)
from touchline.plans.players import (
    least_variation,
    penalty_goals,
    penalty_leaders,
    player_goals,
    player_team_counts,
    player_team_wins,
    player_wins,
    rating_spans,
    scoped_rosters,
    team_penalties,
    teams_per_player,
    top_scorers,
)
from touchline.plans.report import answers
from touchline.plans.staging import (
    explode_goal_xml,
    line_ups,
    malformed_goal_documents,
    stage_all,
    stage_attributes,
    stage_countries,
    stage_leagues,
    stage_matches,
    stage_outcomes,
    stage_players,
    stage_rosters,
    stage_seasons,
    stage_squads,
    stage_teams,
)
from touchline.plans.teams import (
    absent_next_season,
    goal_difference,
    home_team_list,
    league_id_of,
    most_draws_last_season,
    most_goals_for,
    most_losses_per_season,
    most_wins,
    season_churn,
    season_role_totals,
    squad_sizes,
    team_draws,
    team_goals,
    team_losses,
    team_wins,
    teams_by_season,
)
