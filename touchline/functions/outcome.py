"""Outcome of a match from one side's point of view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.schemas import DRAWN, LOST, WON


def outcome(goals_for: Column, goals_against: Column) -> Column:
    """A match without a full score counts as drawn."""
    return F.when(goals_for > goals_against, WON).when(goals_for < goals_against, LOST).otherwise(DRAWN)
