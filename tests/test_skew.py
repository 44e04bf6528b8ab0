"""Hot keys: one team, match or squad that holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from touchline import plans
from touchline.schemas import STAGED
from touchline.scope import Scope
from touchline.sources import write_tables

from tests.league import S1, S2, rows
from tests.plans import executed

SCOPE = Scope(1, (S1, S2))
COUNT = 120_000


def as_staged(df, name):
    names = [part.split()[0] for part in STAGED[name].split(", ")]
    return df.select(*names)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Team 1 plays a third of the matches, match 1 has a third of the goals, squad 0 a third of the members."""
    out = str(tmp_path_factory.mktemp("hot"))
    i = F.col("id")
    third = i % 3 == 0
    tables = {
        "tabla_partidos": spark.range(1, COUNT, numPartitions=16).select(
            i.alias("ID_partido"), F.lit(1).cast("bigint").alias("ID_liga"), F.when(i % 2 == 0, S1).otherwise(S2).alias("Temporada"),
            F.lit("2013-01-01").cast("timestamp_ntz").alias("Fecha"),
            F.when(third, 1).otherwise(2 + i % 997).cast("bigint").alias("ID_local"), 
            F.when(~third & (i % 5 == 1), 1).otherwise(2 + (i + 1) % 997).cast("bigint").alias("ID_visitante"),
            (i % 4).cast("int").alias("Goles_local"), (i % 3).cast("int").alias("Goles_visitante"),
        ),
        "tabla_equipos": spark.range(1, 2000).select(
            i.alias("ID_equipo"), F.concat(F.lit("T"), i.cast("string")).alias("Nombre"), F.lit(1).cast("bigint").alias("ID_liga")
        ),
        "tabla_goles": spark.range(0, 5 * COUNT, numPartitions=16).select(
            i.alias("ID_Gol"), F.when(third, 1).otherwise(i % COUNT).alias("ID_Partido"), (i % 5003).alias("ID_Jugador"),
            F.lit("penal en juego").alias("Tipo"), F.lit("-").alias("Subtipo"),
        ),
        "tabla_jugador": spark.range(0, 5 * COUNT).select(i.alias("ID"), F.concat(F.lit("P"), i.cast("string")).alias("Nombre")),
        "tabla_plantel": spark.range(0, 1000).select(
            F.when(i % 2 == 0, S1).otherwise(S2).alias("Temporada"), (1 + i).alias("ID_equipo"), i.alias("ID_plantel")
        ),
        "tabla_conformacion_plantel": spark.range(0, 5 * COUNT, numPartitions=16).select(
            F.when(third, 0).otherwise(i % 1000).alias("ID_plantel"), i.alias("ID_jugador")
        ),
    }
    found = {}
    for name, df in tables.items():
        as_staged(df, name).write.parquet(f"{out}/{name}")
        found[name] = spark.read.parquet(f"{out}/{name}")
    return found


@pytest.fixture
def shuffled(conf):
    """Shuffle every join and treat partitions of this small data like large ones."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="128KB",
        spark__sql__shuffle__partitions="32",
    )


def hot_plans(t):
    matches, teams, goals, people = (t[n] for n in ("tabla_partidos", "tabla_equipos", "tabla_goles", "tabla_jugador"))
    squads, rosters = t["tabla_plantel"], t["tabla_conformacion_plantel"]
    sides = plans.league_sides(matches, teams, SCOPE)
    strength = squads.withColumn("Suma_Atributos_Plantel", F.lit(1.0))
    return {
        "hot match": plans.top_scorers(goals, matches, people, SCOPE),
        "hot squad": plans.player_team_wins(matches, squads, rosters, people, SCOPE),
        "hot team": plans.squad_match_goals(sides, strength),
    }


@pytest.mark.parametrize("case", ["hot match", "hot squad", "hot team"])
def test_hot_keys_of_joins_are_split(spark, hot, case, shuffled):
    df = hot_plans(hot)[case]
    assert "isSkewJoin=true" in executed(df) or "SortMergeJoin(skew=true)" in executed(df)


@pytest.mark.parametrize("case", ["hot match", "hot squad", "hot team"])
def test_splitting_changes_no_result(spark, hot, case, conf, request):
    expected = rows(hot_plans(hot)[case])
    request.getfixturevalue("shuffled")
    assert rows(hot_plans(hot)[case]) == expected and expected


def test_hot_groups_are_combined_before_they_are_shuffled(hot, shuffled):
    """Between the scan of a fact and its first shuffle there is a partial aggregate."""
    matches, teams, rosters, squads = (
        hot[n] for n in ("tabla_partidos", "tabla_equipos", "tabla_conformacion_plantel", "tabla_plantel")
    )
    for fact, df in (
        ("tabla_partidos", plans.most_wins(matches, teams, SCOPE)),
        ("tabla_partidos", plans.goal_difference(matches, teams, SCOPE)),
        ("tabla_partidos", plans.season_churn(matches, teams, SCOPE)),
        ("tabla_conformacion_plantel", plans.squad_sizes(rosters, squads, teams, SCOPE)),
        ("tabla_partidos", plans.stage_outcomes(matches)),
    ):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(n for n, line in enumerate(lines) if "FileScan" in line and f"/{fact}" in line)
        shuffle = max(n for n, line in enumerate(lines[:scan]) if "Exchange hashpartitioning" in line)
        assert any("HashAggregate" in line for line in lines[shuffle:scan])


@pytest.mark.parametrize("size, least, most", [("64KB", 6, 40), ("64MB", 2, 2)])
def test_a_hot_folder_is_written_by_several_tasks(spark, hot, conf, tmp_path, size, least, most):
    """Files per folder follow from the size asked for: league 1 has two seasons of a size beyond 64 KB."""
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes=size, spark__sql__shuffle__partitions="8")
    write_tables({"tabla_partidos": hot["tabla_partidos"]}, str(tmp_path))
    files = list((tmp_path / "tabla_partidos" / "ID_liga=1").glob("*/*.parquet"))
    assert least <= len(files) <= most
    assert spark.read.parquet(str(tmp_path / "tabla_partidos")).count() == COUNT - 1
