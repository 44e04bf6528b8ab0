"""Groups of similar texts against all pairs."""

import random
import re
from itertools import combinations

from touchline.llm import jaccard
from touchline.llm.jaccard import jaccard_groups, one_of_each

SCHEMA = "doc_id long, text string"


def shingles(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, s), (j, t) in combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 85 * len(s | t):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    line = [word() for _ in range(12)]
    rows = ["", None, " \t", "One", "one", "a b", "A  b", "a b c d", "é É", "É é", "x " * 300]
    for _ in range(60):  # a line that many share, between words of their own
        rows.append(" ".join([word() for _ in range(rng.randint(3, 60))] + line))
    base = [word() for _ in range(120)]
    for _ in range(80):  # near copies, more and less alike, so that chains of links arise
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = word()
        rows.append(" ".join(copy[rng.randint(0, 3) :]))
    rows += [" ".join(line + [word()]) for _ in range(20)]
    for n in (100, 101, 102, 117, 118, 119):  # sizes at the bound
        rows.append(" ".join(base[:100] + [word() for _ in range(n - 100)]))
    rows += [rows[80], rows[80].upper()]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_groups_equal_all_pairs(spark):
    rows = corpus(3)
    got = jaccard_groups(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_empty_tables_null_ids_repeated_rows_and_clashing_names(spark):
    assert jaccard_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d e", 1, 2), (None, "a b c d e", 1, 2), (5, None, 1, 2), (5, None, 1, 2), (6, "p q", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, a long, label long")
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_groups(df).collect()))
    assert got == [(0, 2, 0), (0, 2, 0), (5, 0, 5), (5, 0, 5), (6, 1, 6)]
    kept = one_of_each(df)
    assert kept.columns == df.columns and kept.count() == 5


def test_one_of_each_removes_rows_and_no_text_without_a_copy(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, a), (5, a), (5, b), (None, a), (7, None), (8, b), (8, b), (8, "alone here in this table")]
    for repeat in (1, 2):
        df = spark.createDataFrame(rows * repeat, SCHEMA).repartition(3)
        want = sorted([(1, a), (5, b), (None, a), (7, None), (8, "alone here in this table")] * repeat, key=str)
        assert sorted(map(tuple, one_of_each(df).collect()), key=str) == want
    nameless = spark.createDataFrame([(None, a), (None, a)], SCHEMA)
    assert one_of_each(nameless).count() == 2


def test_only_the_sets_of_a_rounds_pairs_travel(spark, monkeypatch):
    rng = random.Random(5)
    line = " ".join(f"l{i}" for i in range(12))  # makes classes of texts that are linked with none
    rows = [" ".join(f"w{rng.randrange(9000)}" for _ in range(12)) + " " + line for _ in range(40)]
    rows += [" ".join(f"n{i}" for i in range(60)) + end for end in ("", " more", " other")]
    met = []

    def watched(pairs, parts, percent):
        ids = {i for p in pairs.collect() for i in (p.x, p.y)}
        met.append((ids, {r.id for r in parts.select("id").collect()}))
        return links(pairs, parts, percent)

    links = jaccard.links
    monkeypatch.setattr(jaccard, "links", watched)
    rows = list(enumerate(rows))
    got = jaccard_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert met and all(0 < len(ids) == len(parts) <= 3 for ids, parts in met)


def test_a_pair_of_the_last_round_is_made_once(spark):
    about = spark.range(3).selectExpr("id", f"struct(100L AS n, {', '.join(f'0L AS s{i}' for i in range(jaccard.SIGNS))}) AS about")
    rows = [(key, i, i) for i in range(3) for key in range(30) if (key + i) % 3]
    labelled = spark.createDataFrame(rows, "key long, id long, label long")
    assert sorted(map(tuple, jaccard._left_pairs(labelled, about, 85).collect())) == [(0, 1), (0, 2), (1, 2)]
