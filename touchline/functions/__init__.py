from touchline.functions.goal_xml import goal_subtype, goal_type, goals_of, is_malformed, parse_document
from touchline.functions.outcome import outcome
from touchline.functions.seasons import season_of

__all__ = ["goal_subtype", "goal_type", "goals_of", "is_malformed", "outcome", "parse_document", "season_of"]
