"""What may stand before a goal document."""

from pyspark.sql import functions as F

from touchline import plans
from touchline.functions import parse_document

GOAL = "<goal><value><id>7</id></value></goal>"


def test_only_a_prologue_is_taken_off(spark):
    accepted = [GOAL, f" \n{GOAL}", f"\ufeff{GOAL}", f"<?xml version='1.0'?>{GOAL}", f"\ufeff <?xml version='1.0'?>{GOAL}"]
    rejected = [f"<{GOAL}", f"x{GOAL}", f"<!DOCTYPE goal>{GOAL}", "<", ""]
    df = spark.createDataFrame([*enumerate(accepted + rejected)], "match_api_id BIGINT, goal STRING")
    found = plans.explode_goal_xml(df, malformed="skip").collect()
    assert sorted(r.ID_Partido for r in found) == [*range(len(accepted))]
    assert {r.ID_Gol for r in found} == {7}


def test_text_that_starts_with_an_element_meets_no_pattern(spark):
    """Taking off what is not there costs a seventh of the parsing."""
    plan = spark.createDataFrame([(GOAL,)], "goal STRING").select(parse_document(F.col("goal")))._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith(goal" in plan and plan.index("StartsWith(goal") < plan.index("regexp_replace(goal")
