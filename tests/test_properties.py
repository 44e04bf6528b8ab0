"""Questions over random leagues against plain Python."""

import random
from collections import Counter, defaultdict

import pytest

from touchline import plans
from touchline.operators import rows_without

from tests import league as L
from tests.league import S1, S2, S3, S4, SCOPE, rows

SEASONS = (S1, S2, S3, S4)


class League:
    """A random league as Python lists and as tables."""

    def __init__(self, spark, seed):
        rnd = random.Random(seed)
        self.played = []
        for season in SEASONS:
            present = rnd.sample(range(1, 9), 5)
            for _ in range(20):
                home, away = rnd.sample(present, 2)
                self.played.append((season, home, away, rnd.randint(0, 3), rnd.randint(0, 3), rnd.choice([1, 1, 1, 2])))
        self.league_of = {t: 1 if t < 8 else 2 for t in range(1, 9)}
        self.squads = sorted({(m[0], m[1]) for m in self.played})
        self.members = {i: rnd.sample(range(10, 30), 4) for i in range(len(self.squads))}
        kinds = ["normal", "penal en juego", "penal por desempate"]
        self.goals = [
            (rnd.randint(1, len(self.played)), rnd.choice([None, *range(10, 30)]), rnd.choice(kinds)) for _ in range(150)
        ]
        self.ratings = [
            (rnd.randint(10, 29), rnd.choice(SEASONS), rnd.choice([None, 60.0, 61.0, 65.0, 70.0]), rnd.choice([None, 1.0, 2.0]))
            for _ in range(60)
        ]
        self.t_matches = L.matches(spark, self.played)
        self.t_teams = L.teams(spark, *((t, f"T{t}", g) for t, g in self.league_of.items()))
        self.t_squads = L.squads(spark, *self.squads)
        self.t_rosters = L.rosters(spark, self.members)
        self.t_goals, self.t_ratings = L.goals(spark, self.goals), L.ratings(spark, self.ratings)
        self.t_players = L.players(spark, *range(10, 30))
        self.scoped = [(i, m) for i, m in enumerate(self.played, start=1) if m[5] == 1]
        self.scoped_squads = [i for i, (_, t) in enumerate(self.squads) if self.league_of[t] == 1]


@pytest.fixture(scope="module", params=range(3))
def league(spark, request):
    return League(spark, request.param)


def leaders(counts):
    return {k: n for k, n in counts.items() if n == max(counts.values())}


def test_churn_is_the_change_in_teams(league):
    present = defaultdict(set)
    for _, (season, home, away, *_) in league.scoped:
        present[season] |= {home, away}
    expected = []
    for before, after in zip(SEASONS, SEASONS[1:]):
        expected += [(t, f"T{t}", before, "Descendio") for t in present[before] - present[after]]
        expected += [(t, f"T{t}", after, "Ascendio") for t in present[after] - present[before]]
    churn = rows(plans.season_churn(league.t_matches, league.t_teams, SCOPE))
    assert churn == sorted(expected, key=repr)
    gone = sorted([(t, s) for t, _, s, state in churn if state == "Descendio"], key=repr)
    assert rows(plans.absent_next_season(league.t_matches, SCOPE)) == gone
    by_season = plans.teams_by_season(league.t_matches, SCOPE)
    first, second = (by_season.filter(by_season.season == s).select("team") for s in SEASONS[:2])
    assert {r[0] for r in rows(rows_without(first, second, ["team"]))} == present[S1] - present[S2]


def test_scorers(league):
    numbers = {i for i, _ in league.scoped}
    counts = Counter(p for m, p, _ in league.goals if m in numbers)
    known = {p: n for p, n in counts.items() if p is not None}
    found = plans.top_scorers(league.t_goals, league.t_matches, league.t_players, SCOPE)
    assert rows(found) == sorted([(f"P{p}", n) for p, n in leaders(known).items()], key=repr)
    nameless = plans.top_scorers(league.t_goals, league.t_matches, league.t_players, SCOPE, null_player_counts=True)
    assert rows(nameless) == sorted([(f"P{p}", n) for p, n in leaders(counts).items() if p], key=repr)


def test_player_wins(league):
    home, away = Counter(), Counter()
    for _, (season, h, a, gh, ga, _) in league.scoped:
        home[season, h] += gh > ga
        away[season, a] += ga > gh
    wins = {k: home[k] + away[k] for k in home if home[k] and away[k]}
    counts = Counter()
    for i, squad in enumerate(league.squads):
        for player in league.members[i]:
            counts[player] += wins.get(squad, 0)
    found = plans.player_team_wins(league.t_matches, league.t_squads, league.t_rosters, league.t_players, SCOPE)
    assert rows(found) == sorted([(p, f"P{p}", n) for p, n in leaders(counts).items()], key=repr)


@pytest.mark.parametrize("squads", [True, False])
def test_teams_per_player(league, squads):
    hosts = {(m[0], m[1]) for _, m in league.scoped}
    met = defaultdict(list)
    for i, squad in enumerate(league.squads):
        for player in league.members[i] if squad in hosts else []:
            met[player].append(squad[1])
    counts = {p: len(t) if squads else len(set(t)) for p, t in met.items()}
    found = plans.teams_per_player(
        league.t_matches, league.t_squads, league.t_rosters, league.t_players, SCOPE, count_squads=squads
    )
    assert rows(found) == sorted([(p, f"P{p}", n) for p, n in leaders(counts).items()], key=repr)


def test_penalties(league):
    season_of = {i: m[0] for i, m in league.scoped}
    counts = Counter()
    for match, player, kind in league.goals:
        if match in season_of and player and kind != "normal":
            for i in league.scoped_squads:
                season, team = league.squads[i]
                counts[team] += season == season_of[match] and player in league.members[i]
    found = plans.penalty_leaders(
        league.t_goals, league.t_matches, league.t_squads, league.t_rosters, league.t_teams, SCOPE
    )
    assert rows(found) == sorted([(f"T{t}", n) for t, n in leaders(counts).items()], key=repr)


@pytest.mark.parametrize("guard", [True, False])
def test_least_variation(league, guard):
    inside = {p for i in league.scoped_squads for p in league.members[i]}
    values = defaultdict(list)
    for player, _, potential, _ in league.ratings:
        if potential is not None and player in inside:
            values[player].append(potential)
    spans = {p: max(v) - min(v) for p, v in values.items() if guard or len(v) > 1}
    args = league.t_ratings, league.t_rosters, league.t_squads, league.t_teams, SCOPE
    found = plans.least_variation(*args, global_guard=guard)
    assert rows(found) == sorted([(p, s) for p, s in spans.items() if s == min(spans.values())], key=repr)


def pairs_of(league, season_free):
    """(squad, match, goals, strength) built pair by pair."""
    complete = [(p, s, pot + 18 * skill) for p, s, pot, skill in league.ratings if None not in (pot, skill)]
    strength = {}
    for i, (season, team) in enumerate(league.squads):
        if season_free:
            inside = [
                value
                for p, _, value in complete
                if p in league.members[i]
                for q in league.scoped_squads
                if p in league.members[q]
            ]
        elif i in league.scoped_squads:
            inside = [value for p, s, value in complete if p in league.members[i] and s == season]
        else:
            inside = []
        if inside:
            strength[i] = sum(inside)
    found = set()
    for number, (season, home, away, gh, ga, _) in enumerate(league.played, start=1):
        if 1 in (league.league_of[home], league.league_of[away]):
            for team, goals in ((home, gh), (away, gh if season_free else ga)):
                for i, (s, t) in enumerate(league.squads):
                    if t == team and (season_free or s == season) and i in strength:
                        found.add((i, number, goals, strength[i]))
    return found


@pytest.mark.parametrize("free", [True, False])
def test_strength_and_goals(league, free):
    expected = pairs_of(league, free)
    strength = plans.squad_strength(
        league.t_ratings, league.t_rosters, league.t_squads, league.t_teams, SCOPE, season_free=free
    )
    sides = plans.league_sides(league.t_matches, league.t_teams, SCOPE, away_uses_home_goals=free)
    assert rows(plans.squad_match_goals(sides, strength, free)) == sorted(expected, key=repr)
    assert rows(plans.goal_histogram(sides, strength, free)) == sorted(
        Counter(g for _, _, g, _ in expected).items(), key=repr
    )
    by_team = defaultdict(list)
    for squad, _, goals, total in expected:
        by_team[f"T{league.squads[squad][1]}"].append((goals, total))
    found = {r[0]: r[1:] for r in rows(plans.attributes_vs_goals(sides, strength, league.t_teams, free))}
    assert found.keys() == by_team.keys()
    for name, pairs in by_team.items():
        wanted = sum(g for g, _ in pairs) / len(pairs), sum(s for _, s in pairs) / len(pairs)
        assert found[name] == pytest.approx(wanted)
