"""Line dedup, collocations and ranked search against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from touchline.llm import lexical, line_runs
from touchline.llm.collocations import collocations
from touchline.llm.common import BitFilter
from touchline.llm.lexical import Best, Corpus, Shard, compress, max_score, search
from touchline.llm.line_runs import LineRuns, drop_repeated_lines

from touchline.llm.queries import ORACLES, QUERIES
from touchline.llm.rolling import Roller
from verification.check import connect

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("name", ["op11_phrase_fingerprints", "op12_block_max_search", "op13_levelled_line_dedup"])
def test_queries_equal_their_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    want = connect(sf_dir).execute(ORACLES[name]).df()
    found = QUERIES[name](spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert sorted(map(tuple, found[columns].values.tolist())) == sorted(map(tuple, want[columns].values.tolist()))


# lines


def lines_by_hand(rows, documents, characters):
    def key(line):
        return line.strip(BLANK).translate(UPPER)

    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= characters:
                held[key(line)].add(i)
    last = {k: max(ids, key=lambda i: (i is not None, i or 0)) for k, ids in held.items() if len(ids) >= documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def line_rows(seed):
    rng = random.Random(seed)
    common = ["All rights reserved here", "  ALL rights Reserved here\t", "éééééééééééééééééééé", "É" * 20, "ten chars.", "a\x0bb" * 9, ""]
    rows = []
    for i in range(150):
        lines = [rng.choice(common) if rng.random() < 0.6 else f"line {rng.randrange(60)} of the shared ones" for _ in range(rng.randrange(6))]
        rows.append((i, "\n".join(lines)))
    hot = "this line is in a third of all documents"
    rows += [(1000 + i, f"{hot}\nown {i} line that stands nowhere else\n{hot}") for i in range(60)]
    rows += [(None, hot), (None, "All rights reserved here"), (7, hot), (7, rows[7][1]), (5000, None), (5001, ""), (5002, "x" * 300_000 + "\n" + hot)]
    return rows


@pytest.mark.parametrize("options", [{}, {"documents": 2, "batches": 1}, {"documents": 5, "batches": 5, "fanout": 3, "characters": 5}])
def test_repeated_lines_equal_brute_force(spark, options):
    rows = line_rows(3)
    docs = spark.createDataFrame([(i, t, i, "h", 0) for i, t in rows], "doc_id long, text string, h0 long, gone string, keep int")
    found = drop_repeated_lines(docs.repartition(5), **options).collect()
    want = lines_by_hand(rows, options.get("documents", 3), options.get("characters", 20))
    assert sorted(map(tuple, found), key=str) == want


def test_repeated_lines_of_texts_with_text_ids_and_none(spark):
    rows = [(f"d{i}", "one and the same long line\nown") for i in range(4)]
    found = drop_repeated_lines(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in found) == [("d0", 1), ("d1", 1), ("d2", 1), ("d3", 0)]
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_settled_lines_are_left_out_and_levels_are_compacted(spark):
    runs = LineRuns(spark, documents=2, fanout=2)
    sizes = []
    for batch in range(4):
        ids = [100 - batch * 10, 99 - batch * 10]
        lines = [(1, 1, i) for i in ids] + [(2, batch, i) for i in ids[:1]]
        runs.add(spark.createDataFrame(lines, "h0 long, h1 long, doc_id long"))
        sizes.append([[r.count() for r in level] for level in runs.levels])
    # the hot line is written once, by the first batch; two runs make one of the next level
    assert sizes[0] == [[2]] and sizes[1] == [[], [3]] and sizes[2] == [[1], [3]] and sizes[3] == [[], [], [5]]
    assert [tuple(r) for r in runs.repeated().collect()] == [(1, 1, 100)]
    files = runs.runs[0].inputFiles()
    assert all("line_run_" in f for f in files)
    runs.close()
    assert runs.repeated() is None


def test_a_late_larger_id_is_kept_although_the_line_is_settled(spark):
    runs = LineRuns(spark, documents=2)
    runs.add(spark.createDataFrame([(1, 1, 5), (1, 1, 6)], "h0 long, h1 long, doc_id long"))
    runs.add(spark.createDataFrame([(1, 1, 50), (1, 1, 4)], "h0 long, h1 long, doc_id long"))
    assert [tuple(r) for r in runs.repeated().collect()] == [(1, 1, 50)]
    runs.close()


def test_runs_are_joined_without_a_shuffle(spark, conf):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    runs = LineRuns(spark)
    runs.add(spark.range(5000).selectExpr("id AS h0", "id AS h1", "id AS doc_id"))
    run = runs.runs[0]
    plan = run.join(run.withColumnsRenamed({"documents": "d", "keep": "k"}), ["h0", "h1"], "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan.split("== Physical Plan ==")[1]
    runs.close()


def test_line_keys_by_hand():
    assert line_runs._key(b"  x" * 3, 20) is None
    assert line_runs._key("é".encode() * 10, 20) is None and line_runs._key("é".encode() * 20, 20)
    assert line_runs._key(b" \x0bABC\t", 3) == hashlib.blake2b(b"abc", digest_size=16).digest()


# collocations


def phrases_by_hand(rows, words, times, top, inside):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            own = re.findall("[^ \t]+", piece)
            n[lang] += len(own)
            for size in range(1, words + 1):
                f.update((lang, tuple(own[i : i + size])) for i in range(len(own) - size + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= times}
    covered = set()
    for (lang, p), a in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                q = (lang, p[i : i + size])
                if 100 * a >= inside * candidates[q]:
                    covered.add(q)
    by_lang = defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) in covered:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        phrase = " ".join(p)
        by_lang[lang].append((-score, -a, phrase.encode(), phrase, f[lang, p[:k]], f[lang, p[k:]]))
    out = []
    for lang, found in by_lang.items():
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase, -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows(seed):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "of", "the", "é", "É", "state", "\x00", "日本", "a-b", "x" * 40]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = []
    for _ in range(250):
        some = rng.choices(vocabulary, weights, k=rng.randrange(30))
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0c"]) for w in some)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return rows + [("en", "the end of the line " * 40)] * 3 + [("en", None), ("fr", ""), ("fr", ".;. ,")]


@pytest.mark.parametrize(
    "options",
    [{"times": 5}, {"times": 5, "bits": 4}, {"times": 3, "bits": 1, "words": 3, "top": 7}, {"times": 8, "inside": 60}, {"times": 10_000}],
)
def test_phrases_equal_brute_force(spark, options):
    rows = phrase_rows(1)
    docs = spark.createDataFrame([(lang, t, 1, "x", 2) for lang, t in rows], "lang string, text string, a int, phrase string, k int")
    found = sorted(map(tuple, collocations(docs.repartition(4), **options).collect()))
    want = phrases_by_hand(rows, options.get("words", 5), options["times"], options.get("top", 2000), options.get("inside", 100))
    assert found == want and (want or options["times"] == 10_000)


@pytest.fixture
def small_parts(monkeypatch):
    """Workers import the module anew, so that small chunks are tried in this process."""
    from touchline.llm import collocations as module

    def change(chunk, part):
        monkeypatch.setattr(module, "CHUNK", chunk)
        monkeypatch.setattr(module, "PART", part)
        return module

    return change


@pytest.mark.parametrize("chunk, part", [(300, 50), (3000, 7), (10**6, 10**6)])
def test_chunks_and_buckets_lose_nothing(small_parts, chunk, part):
    module = small_parts(chunk, part)
    rows = phrase_rows(2)
    batch = pa.RecordBatch.from_pylist([{"lang": lang or "und", "text": t or ""} for lang, t in rows])
    words, pairs = Counter(), Counter()
    for lang, t in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (t or "").translate(UPPER)):
            own = re.findall("[^ \t]+", piece)
            words.update((lang or "und", w.encode()) for w in own)
            pairs.update((lang or "und", f"{a} {b}".encode()) for a, b in zip(own, own[1:]))
    found = [r for out in module._entries(7, [], 64)([batch]) for r in out.to_pylist()]
    assert {r["bucket"] for r in found} <= set(range(7))
    assert sum(int(np.frombuffer(r["counts"], np.uint32).sum()) for r in found) == sum(words.values())
    numbers = {x for r in found for x in np.frombuffer(r["fingerprints"], np.uint64).tolist()}
    assert len(numbers) == len(words)
    for r in found:
        some = np.frombuffer(r["fingerprints"], np.uint64)
        assert (np.diff(some) > 0).all() if len(some) > 1 else True
        assert {int(x) * 7 >> 64 for x in some.tolist()} == {r["bucket"]}
    held = BitFilter(np.full(1 << 10, np.uint64(2**64 - 1)))
    out = [b for b in module._exact(1)(module._spelled(7, [lambda: held] * 2, 64)([batch]))]
    counted = {(r["lang"], r["phrase"]): r["a"] for b in out for r in b.to_pylist() if r["n"]}
    assert counted == dict(words + pairs)
    assert sum(r["a"] for b in out for r in b.to_pylist() if r["n"] == 0) == sum(words.values())


def test_words_of_one_hash_are_told_apart(small_parts, monkeypatch):
    module = small_parts(1 << 20, 1 << 20)
    roller = Roller()
    monkeypatch.setattr(roller, "spans", lambda sums, start, end: np.zeros(len(start), np.uint64))
    chunk = module.Chunk(roller, True)
    chunk.add([b"one two. one", b"two three"])
    chunk.close()
    assert [chunk.spelled[i] for i in chunk.words] == [b"one", b"two", b"one", b"two", b"three"]
    assert chunk.piece.tolist() == [0, 0, 1, 2, 2]
    start = np.array([0, 2, 3])
    assert sorted(chunk.told_apart(start, np.zeros(3, np.uint64), 1)) == [(0, 2), (3, 1)]


def test_scores_beyond_64_bits(spark):
    docs = spark.createDataFrame([("en", "a b")], "lang string, text string")
    assert collocations(docs, times=1).collect()[0].score == 2000
    big = spark.sql("SELECT CAST(1000 * CAST(3e14 AS DECIMAL(19,0)) AS DECIMAL(23,0)) * CAST(9e14 AS DECIMAL(15,0)) AS product, CAST(3e14 AS DECIMAL(19,0)) * CAST(3e14 AS DECIMAL(19,0)) AS square")
    assert big.select(F.expr("product div square")).first()[0] == 3000
    assert collocations(docs.limit(0)).count() == 0


# search


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def ranked_by_hand(rows, items, top):
    held = [(i, Counter(words_of(t))) for i, t in rows]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t in set(words_of(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if none else i, -score))
    return sorted(out, key=str)


def search_rows(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "x_y", "A1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(40)))) for i in range(n)]
    rows += [(2000 + i, "w3 w3 w50 w51") for i in range(60)] + [(None, "w3 w50"), (5, "w3 w50"), (7000, None), (7001, ""), (7002, "--- !"), (7003, "w1 " * 70_000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(12)))) for i in range(25)]
    return rows, items + [(100, None), (101, "w3 w50"), (101, "w1"), (102, "no such term"), (None, "W3. w51!")]


@pytest.mark.parametrize("top", [1, 3, 10])
def test_ranks_equal_brute_force(spark, top):
    rows, items = search_rows(4)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, rank int, term string").repartition(6)
    asked = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id int, text string, doc_id int")
    found = search(docs, asked, top=top, block=60)
    assert sorted(map(tuple, found.collect()), key=str) == ranked_by_hand(rows, items, top)


def test_search_without_documents_or_items(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y")], "doc_id string, text string")
    asked = spark.createDataFrame([("q", "x")], "item_id string, text string")
    # every document holds the term: floor(1000 ln(6 / 5)) is above 0, and the lesser id comes first
    assert [(r.rank, r.doc_id) for r in search(docs, asked).orderBy("rank").collect()] == [(1, "a"), (2, "b")]
    assert search(docs.limit(0), asked).count() == 0 and search(docs, asked.limit(0)).count() == 0


def shard_of(rows, number):
    held = [(i, words_of(t)) for i, t in rows if words_of(t)]
    corpus = Corpus(len(held), sum(len(w) for _, w in held))
    lengths = np.array([len(w) for _, w in held])
    found = [np.array([number[t] for t in w if t in number], np.int64) for _, w in held]
    some, df, starts, sizes, last, most, at, data = compress(corpus, found, lengths)
    return corpus, df, Shard([i for i, _ in held], corpus.norms(lengths), some, starts, sizes, last, most, at, data.tobytes())


def test_blocks_are_left_compressed_and_results_stay_the_same():
    rows, items = search_rows(5, 30_000)
    rows = [(i if i is not None else 9999, t) for i, t in rows]
    number = {t: n for n, t in enumerate(sorted({t for _, q in items for t in words_of(q)}))}
    corpus, df, shard = shard_of(rows, number)
    weight = dict(zip(shard.terms.tolist(), corpus.weights(df).tolist(), strict=True))
    blocks = read = 0
    want = defaultdict(list)
    for item, rank, doc, score in ranked_by_hand(rows, [(str(n), q) for n, (_, q) in enumerate(items)], 10):
        want[item].append((rank, doc, score))
    for n, (_, q) in enumerate(items):
        best = Best(10)
        counts = max_score(shard, [(number[t], weight[number[t]]) for t in sorted(set(words_of(q))) if number.get(t) in weight], best)
        blocks, read = blocks + counts["blocks"], read + counts["read"]
        assert [(r, d, -s) for r, (s, _, d) in enumerate(best.rows, 1)] == sorted(want[str(n)])
    assert 0 < read < blocks * 0.9


def test_postings_are_read_as_they_were_written():
    rng = random.Random(6)
    found = [np.array([rng.randrange(5) for _ in range(rng.choice([0, 3, 300, 70_000 if d == 11 else 1]))], np.int64) for d in range(700)]
    lengths = np.array([max(1, len(x)) for x in found])
    corpus = Corpus(700, int(lengths.sum()))
    some, df, starts, sizes, last, most, at, data = compress(corpus, found, lengths)
    shard = Shard(list(range(700)), corpus.norms(lengths), some, starts, sizes, last, most, at, data.tobytes())
    for place, term in enumerate(some.tolist()):
        a, b = shard.blocks(place)
        documents, value = shard.read_all(range(a, b))
        tf = np.array([int((x == term).sum()) for x in found])
        assert documents.tolist() == np.flatnonzero(tf).tolist() and len(documents) == df[place]
        assert value.tolist() == lexical.impacts(tf[documents], shard.norms[documents]).tolist()
        for block in range(a, b):
            own, impact = shard.read(block)
            assert len(own) == sizes[block] and own[-1] == last[block] and impact.max() == most[block]


def test_norms_of_very_long_texts_are_exact():
    corpus = Corpus(10**10, 10**13)
    assert corpus.norms(np.array([10**8, 5])).tolist() == [10 + 90 * 10**8 * 10**10 // 10**13, 10 + 90 * 5 * 10**10 // 10**13]
