"""What the executed plans look like."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from touchline import plans
from touchline.operators import two_sided
from touchline.schemas import STAGED
from touchline.scope import Scope
from touchline.sources import write_tables

from tests import league as L
from tests.league import S1, S2, S3, SCOPE
from tests.plans import executed, scans, shuffles

SF_DIR = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return executed(driver.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", list(driver.QUERIES))
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "MapInPandas"):
        assert operator not in plan
    # only squads are numbered by windows: over a bucket of teams, or over the counts of buckets
    for line in plan.splitlines():
        if "Window [" in line:
            assert "_bucket" in line or "sum(_n" in line


@pytest.mark.parametrize("name", list(driver.QUERIES))
def test_planning_runs_no_job_and_makes_no_folder(spark, name, monkeypatch):
    monkeypatch.setattr("tempfile.mkdtemp", lambda *a, **k: pytest.fail("a folder was made"))
    tables = driver.DriverTables(spark, SF_DIR)
    context = spark.sparkContext
    context.setJobGroup(f"planning {name}", name)
    df = driver.QUERIES[name](tables)
    df._jdf.queryExecution().executedPlan()
    jobs = context.statusTracker().getJobIdsForGroup(f"planning {name}")
    context._jsc.clearJobGroup()
    # what reads a file's schema is not of the query
    assert not jobs


# query -> scans of the matches, shuffles that write (reused ones and the sort's included)
SINGLE_SCAN = {
    "most_wins": 2, "most_wins_either_role": 2, "most_draws_last_season": 2, "most_goals_for": 2,
    "goal_difference": 2, "goal_difference_top_only": 3, "most_losses_per_season": 3, "season_churn": 2,
    "season_role_totals": 2, "home_team_list": 0, "yearly_goals": 2, "yearly_goals_steady_teams": 3,
    "avg_goals_season": 2, "avg_goals_team_season": 3, "stage_matches": 1, "stage_outcomes": 1,
}


@pytest.mark.parametrize("name", SINGLE_SCAN)
def test_matches_are_scanned_once(spark, name):
    plan = plan_of(spark, name)
    assert scans(plan, "orders.parquet") == 1
    # the number of teams is a subquery of its own, one row from each task
    counting = int("ReadSchema: struct<>" in plan)
    assert shuffles(plan) <= SINGLE_SCAN[name] + counting


def test_goals_and_ratings_are_scanned_once(spark):
    for name in ("top_scorer", "penalty_leaders", "least_variation_potential", "attributes_vs_goals", "stage_goals_xml"):
        assert scans(plan_of(spark, name), "lineitem.parquet") == 1


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Matches as one table without folders."""
    out = str(tmp_path_factory.mktemp("stored"))
    played = [(s, 1, 2, 1, 0) for s in (S1, S2, S3)]
    write_tables({"tabla_partidos": L.matches(spark, played)}, out, partitioned={})
    return spark.read.schema(STAGED["tabla_partidos"]).parquet(f"{out}/tabla_partidos")


def test_scope_reaches_the_scan(stored):
    plan = executed(plans.season_role_totals(stored, SCOPE))
    assert "PushedFilters: [IsNotNull(ID_liga), EqualTo(ID_liga,1), In(Temporada" in plan


def test_only_needed_columns_are_read(stored):
    plan = executed(two_sided(stored).groupBy("team").sum("goals_for"))
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert read == "ID_local:bigint,ID_visitante:bigint,Goles_local:int,Goles_visitante:int"


def test_years_reach_the_scan_as_a_range(spark, stored):
    teams = L.teams(spark, (1,), (2,))
    plan = plans.yearly_goals(stored, teams, 1, 2012, 2013)._jdf.queryExecution().executedPlan().toString()
    assert "(Fecha" in plan and "2012-01-01 00:00:00" in plan and "2014-01-01 00:00:00" in plan
    assert "year(" not in plan.split("FileScan")[1].split("PartitionFilters")[0]


def test_only_an_extreme_is_always_broadcast(spark, conf):
    """Without room for a broadcast every join shuffles, but for the one row an extreme is."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    one_row = {"most_wins": 1, "penalty_leaders": 1, "most_losses_per_season": 0}
    for name in (*one_row, "attributes_vs_goals", "absent_next_season", "stage_rosters", "stage_league", "stage_team"):
        plan = plan_of(spark, name)
        assert plan.count("BroadcastExchange") == one_row.get(name, 0)


# the answer and its extreme read one shuffle of the counts
SHARED = [
    "most_wins", "most_draws_last_season", "most_goals_for", "goal_difference_top_only", "most_losses_per_season",
    "top_scorer", "player_team_wins", "teams_per_player", "squads_per_player", "least_variation_potential",
    "least_variation_global_guard", "penalty_leaders", "penalty_leaders_fixed_season",
]


@pytest.mark.parametrize("name", SHARED)
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_extremes_share_the_counts(spark, conf, name, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold, spark__sql__adaptive__autoBroadcastJoinThreshold=threshold)
    plan = plan_of(spark, name)
    assert "ReusedExchange" in plan
    assert scans(plan, "lineitem.parquet") <= 1
    # rosters are kept, and their own plan is printed with each use of them
    assert "InMemoryTableScan" in plan or scans(plan, "orders.parquet") <= 1


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """400 squads of 40 seasons with 20 players each and 800 matches of 10 goals, as ``write_tables`` leaves them."""
    out = str(tmp_path_factory.mktemp("clustered"))
    ids = spark.range(400).select(F.col("id").alias("ID_plantel"))
    season = F.concat(F.lit("S"), F.lpad(F.floor(F.col("ID_plantel") / 10).cast("string"), 2, "0")).alias("Temporada")
    squads = ids.select(season, (F.col("ID_plantel") % 10).alias("ID_equipo"), "ID_plantel")
    number = F.explode(F.sequence(F.lit(0), F.lit(19))).alias("n")
    player = (F.col("ID_plantel") % 10 * 20 + F.col("n")).alias("ID_jugador")
    members = squads.select("Temporada", "ID_plantel", number).select("Temporada", "ID_plantel", player)
    ratings = [c.strip().split(" ") for c in STAGED["tabla_atributos_jugador"].split(",")]
    known = ("ID_jugador", "Temporada")
    tables = {
        "tabla_plantel": squads,
        "tabla_equipos": spark.createDataFrame([(t, f"team {t}", 1) for t in range(10)], STAGED["tabla_equipos"]),
        "tabla_conformacion_plantel": members.select("ID_plantel", "ID_jugador"),
        "tabla_atributos_jugador": members.select(
            *[F.col(c) if c in known else F.lit(1 if t == "DOUBLE" else None).cast(t).alias(c) for c, t in ratings]
        ),
        "tabla_goles": spark.range(8000).select(
            F.col("id").alias("ID_Gol"), F.floor(F.col("id") / 10).alias("ID_Partido"), (F.col("id") % 7).alias("ID_Jugador"),
            F.lit("n").alias("Tipo"), F.lit("").alias("Subtipo"),
        ),
        "tabla_partidos": spark.createDataFrame(
            [(i, 1, "S07", None, 1, 2, 0, 0) for i in range(100, 120)], STAGED["tabla_partidos"]
        ),
    }
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    write_tables(tables, out)
    spark.conf.set(coalesce, "true")
    return {n: spark.read.schema(STAGED[n]).parquet(f"{out}/{n}") for n in tables}


def rows_scanned(df, table):
    """The rows that each scan of a table brought out."""
    rows = []

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        if kind == "FileSourceScanExec" and table in node.relation().location().rootPaths().mkString(","):
            rows.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    visit(plan)
    return rows


ASKED = {
    "squad_sizes": lambda t, s: plans.squad_sizes(t["tabla_conformacion_plantel"], t["tabla_plantel"], t["tabla_equipos"], s),
    "squad_strength": lambda t, s: plans.squad_strength(*_rated(t), s),
    "rated_squads": lambda t, s: plans.rated_squads(*_rated(t), s),
    "least_variation": lambda t, s: plans.least_variation(*_rated(t), s),
    "player_goals": lambda t, s: plans.player_goals(t["tabla_goles"], t["tabla_partidos"], s),
}


def _rated(t):
    names = ("tabla_atributos_jugador", "tabla_conformacion_plantel", "tabla_plantel", "tabla_equipos")
    return [t[n] for n in names]


@pytest.mark.parametrize("name", ASKED)
def test_a_clustered_scope_passes_over_other_squads_and_matches(clustered, name):
    table = "tabla_goles" if name == "player_goals" else "tabla_conformacion_plantel"
    ask = ASKED[name]
    whole, some = (ask(clustered, Scope(1, ("S07", "S08"), clustered=c)) for c in (False, True))
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))
    assert max(rows_scanned(whole, table)) == 8000
    assert max(rows_scanned(some, table)) <= 2500


def test_seasons_pass_over_other_ratings(clustered):
    strength = ASKED["squad_strength"](clustered, Scope(1, ("S07", "S08")))
    assert max(rows_scanned(strength, "tabla_atributos_jugador")) <= 2500
