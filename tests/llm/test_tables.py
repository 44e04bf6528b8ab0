"""Packing, exact dedup, shards, the classifier and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_jaccard import shingles
from touchline.llm import decontaminate, quality
from touchline.llm.exact_dedup import exact_dedup, exact_groups
from touchline.llm.packing import OpenBins, pack
from touchline.llm.quality import classify, good_documents
from touchline.llm.rolling import Roller
from touchline.llm.sharding import grown_shard_of, shuffled_shards, write_shards

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["", None, "A b  c", "a B  c", "É x", "é x", "a b c <|endoftext|> d", "it's  \n\n 12 a.", "x y " * 900, "A b  c", "日本 語 a"]


def odd(spark, texts=TEXTS):
    rows = [(i, t, i, "s") for i, t in enumerate(texts)] + [(None, "a b  c", 1, None), (2, "A b  c", 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard int, Kept string").repartition(3)


def test_packing_equals_the_tokenizer_and_fills_without_gaps(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = odd(spark)
    rows = pack(docs, length=64).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for i, text in enumerate(TEXTS):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in pieces[i]})
        assert [p[1] for p in own] == list(np.cumsum([0] + [p[2] for p in own])[:-1]) and sum(p[2] for p in own) == len(ids)
        assert all(p[2] == 64 for p in own[1:]) and (len(own) == 1 or own[0][2] <= 64)
        assert [p[3] for p in own] == [zlib.crc32(ids[p[1] : p[1] + p[2]].tobytes()) for p in own]
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for placed in by.values():
        placed.sort()
        assert [o for o, _ in placed] == list(np.cumsum([0] + [n for _, n in placed])[:-1]) and sum(n for _, n in placed) <= 64
    assert pack(docs.limit(0)).count() == 0


def test_open_bins_take_the_closest_fit_and_close_the_fullest():
    bins = OpenBins(10, 2)
    bins.put(0, 3)
    bins.put(1, 6)
    bins.put(2, 5)  # no room: the one with 3 left closes
    assert bins.fit(4) == (2, 5) and bins.fit(4) == (1, 6) and bins.fit(1) is None


def test_exact_groups_equal_brute_force(spark):
    docs = odd(spark)
    source = [(r.doc_id, (r.text or "").translate(UPPER)) for r in docs.collect()]
    for words in (1 << 20, 1, 2):  # with few cells every row may be a repeat
        rows = exact_groups(docs, words=words).collect()
        sizes = Counter(t for _, t in source)
        best = {t: max((i for i, u in source if u == t and i is not None), default=None) for t in sizes}
        sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in sizes}
        want = sorted(str((i, best[t], sizes[t], sha[t])) for i, t in source)
        assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in rows) == want
        assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(sha.values())
        assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(sizes)
    assert exact_groups(docs.limit(0)).count() == 0


def test_shards_hold_all_rows_gapless_and_grow_into_the_new_one(spark, tmp_path):
    rng = random.Random(1)
    docs = odd(spark, TEXTS + ["w " * rng.randrange(90) for _ in range(300)])
    sharded = shuffled_shards(docs, shards=5, bucket_bytes=2000)
    rows = sharded.collect()
    key = lambda r: str(tuple(r))
    assert Counter(key(r.record) for r in rows) == Counter(key(r) for r in docs.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(5)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sharded.select("shard", grown_shard_of(F.col("record.doc_id"), F.col("shard"), 5).alias("grown")).collect()
    assert all(r.grown in (r.shard, 5) for r in moved) and any(r.grown == 5 for r in moved)
    six = {r.record.doc_id: r.shard for r in shuffled_shards(docs, shards=6).collect()}
    assert all(six[r.record.doc_id] in (r.shard, 5) for r in rows)
    order = [r.record.doc_id for r in sorted(rows, key=lambda r: r.slot) if r.shard == 0 and r.record.doc_id is not None]
    assert order != sorted(order)
    write_shards(sharded, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)
    assert shuffled_shards(docs.limit(0)).count() == 0


def test_classifier_tells_held_out_documents_apart(spark):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ae", "io", "ou")]
    rows = [(i, " ".join(rng.choice(words) + ("!!" if i % 3 == 0 else "") for _ in range(30)), "en") for i in range(600)]
    docs = spark.createDataFrame([*rows, (9001, None, "x"), (None, "", "x")], "doc_id long, text string, score string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(600)] + [(None, 1), (7, None)], "doc_id long, quality int")
    got = classify(docs, labels).collect()
    assert len(got) == 602 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    tested = [r for r in got if r.doc_id is not None and r.doc_id < 9000 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert sum(r.predicted == int(r.doc_id % 3 != 0) for r in tested) >= 0.97 * len(tested) > 100
    assert {r.score for r in classify(docs, labels.limit(0)).collect()} == {0.5}
    assert classify(docs.limit(0), labels).count() == 0


def test_every_word_has_its_own_vector(spark, monkeypatch):
    """Features against plain sums by word, of far more words than are broadcast; the share of those that are broadcast
    changes no score."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfg") + rng.choice("aeiou") for _ in range(rng.choice((1, 3, 5))))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 400))) for _ in range(300)] + ["", None, "ba ba"]
    texts += texts[:2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    split = [(t or "").split() for t in texts]
    hashes = dict(zip(words := sorted({w for ws in split for w in ws}), quality._words(quality.Roller(), [w.encode() for w in words])[0].tolist()))
    assert len(words) > 1.2 * len({h % (1 << 15) for h in hashes.values()})  # in rows by hash many would share one
    own = {}
    for w in words:
        dimension, sign = quality.random_vectors(np.array([hashes[w]], np.uint64))
        own[w] = np.bincount(dimension[0], weights=sign[0], minlength=quality.DIMENSIONS)
    count, context = Counter(w for ws in split for w in ws), {w: np.zeros(quality.DIMENSIONS) for w in words}
    for ws in split:
        for i, w in enumerate(ws):
            for j in range(max(0, i - quality.REACH), min(len(ws), i + quality.REACH + 1)):
                if j != i:
                    context[w] += own[ws[j]]
    total = sum(count.values())
    vector = {w: (context[w] / (np.linalg.norm(context[w]) + 1e-9) + own[w] / 2) * (1e-2 / (1e-2 + count[w] / total)) for w in words}
    scores = []
    for frequent in (1 << 15, 100, 0):
        monkeypatch.setattr(quality, "FREQUENT", frequent)
        vectors = quality.WordVectors(docs.select("text"))
        got = {r.doc_id: np.frombuffer(r.features, np.float32) for r in vectors.features(docs, "text", ["doc_id"]).collect()}
        for i, ws in enumerate(split):
            mean = sum(vector[w] for w in ws) / len(ws) if ws else np.zeros(quality.DIMENSIONS)
            assert np.allclose(got[i], [*mean, np.linalg.norm(mean), np.log1p(len(ws))], atol=1e-5)
        scores.append({i: x.tobytes() for i, x in got.items()})
        assert scores[-1] == scores[0] and got[0].tobytes() == got[len(texts) - 2].tobytes()


def test_quality_stage_without_usable_labels_rejects_nothing(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(None, 1), (7, None)], "doc_id long, quality int")
    for none in (labels, labels.limit(0)):
        kept = good_documents(docs, none)
        assert kept.columns == docs.columns
        assert Counter(map(str, kept.collect())) == Counter(map(str, docs.collect()))


def test_pipeline_keeps_columns_and_clean_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert out.join(docs, "doc_id", "left_anti").count() == 0 and out.count() > 0.7 * docs.count()


def test_pipeline_equals_its_stages_by_hand(spark):
    """From end to end: what each stage keeps against plain Python; the first and the last by what they promise."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r.doc_id: r.predicted for r in classify(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    left = {r.doc_id: r.text or "" for r in good.collect()}
    assert set(left) == {i for i, predicted in scores.items() if predicted} and 0 < len(left) < docs.count()
    # exact copies: the largest id stays
    last = {t.translate(UPPER): i for i, t in sorted(left.items())}
    left = {i: left[i] for i in last.values()}
    # groups of similar texts: the smallest id stays
    sets = {i: shingles(t, 5) for i, t in left.items()}
    parent = {i: i for i in left}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(sorted(left), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    left = {i: t for i, t in left.items() if root(i) == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    index = decontaminate.Index(items, decontaminate.EDITS, decontaminate.REGION)
    left = {i: t for i, t in left.items() if not decontaminate.passages(index, Roller(), decontaminate.normal(t))}
    assert not any(decontaminate.normal(q) in decontaminate.normal(t) for t in left.values() for _, q in items if len(q) > 12)
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = defaultdict(int)
    for r in packed:
        got[r.doc_id] += r.length
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}


def test_words_that_are_counted_in_parts_are_counted_once(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"text": ["a b c " * 50, "", "b c d", "a"] * 30})
    whole = {w: n for out in quality._counts([batch]) for w, n in zip(out["word"].to_pylist(), out["n"].to_pylist())}
    monkeypatch.setattr(quality.chunks, "__defaults__", (200,))
    parts = {w: n for out in quality._counts([batch]) for w, n in zip(out["word"].to_pylist(), out["n"].to_pylist())}
    assert whole == parts and sorted(whole.values()) == [30, 1530, 1530, 1530]


def test_repeated_labelled_rows_come_to_the_driver_once(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id % 2 AS doc_id", "concat('some text ', id % 2) AS text")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "Network", lambda features, marks: seen.append(len(marks)) or (lambda x: np.zeros(len(x))))
    quality.fit(docs, labels, sample=2)
    assert seen == [2]


def test_words_reach_their_chunk_packed(spark, monkeypatch):
    """What a chunk is told goes many words to a row, and sums in as few bytes as they need."""
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(3000)}x" for _ in range(50)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(quality, "FREQUENT", 0)
    seen = quality.WordVectors(docs.select("text"))
    grouped = type(docs).groupBy
    told = []
    monkeypatch.setattr(type(docs), "groupBy", lambda df, *c: (told.append(df) if c == ("chunk",) else None) or grouped(df, *c))
    whole = {r.doc_id: r.features for r in seen.features(docs, "text", ["doc_id"]).collect()}
    packs = [r for r in told[0].collect() if r.text is None]
    asked = len({w for t in texts for w in t.split()})
    assert 0 < len(packs) < asked / 10
    assert all(len(r.sums) < 8 * quality.DIMENSIONS for r in told[0].collect() if r.text is not None)
    # many small packs hold the same
    monkeypatch.setattr(quality, "TOLD", 20)
    assert {r.doc_id: r.features for r in seen.features(docs, "text", ["doc_id"]).collect()} == whole


def test_texts_get_their_words_in_turns(spark, monkeypatch):
    """Each turn asks for the words of its own texts only, and turns change no feature."""
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(900)}x" for _ in range(30)) for _ in range(90)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(quality, "FREQUENT", 0)
    seen = quality.WordVectors(docs.select("text"))
    one = {r.doc_id: r.features for r in seen.features(docs, "text", ["doc_id"], turns=1).collect()}
    grouped = type(docs).groupBy
    told = []
    monkeypatch.setattr(type(docs), "groupBy", lambda df, *c: (told.append(df) if c == ("chunk",) else None) or grouped(df, *c))
    assert {r.doc_id: r.features for r in seen.features(docs, "text", ["doc_id"]).collect()} == one
    counts = [df.where("text IS NOT NULL").count() for df in told]
    assert len(counts) == quality.TURNS and sum(counts) == len(texts) and max(counts) < len(texts) / 2


def test_sums_survive_being_narrowed():
    for most in (0, 1, 127, 128, 1 << 40, (1 << 62) - 1):
        x = np.array([[most, -most] * (quality.DIMENSIONS // 2)] * 3)
        assert (quality._wide(quality._narrow(x)) == x).all()
    assert quality._wide(quality._narrow(x) + quality._narrow(x[:1] % 100))[3].tolist() == (x[0] % 100).tolist()


def test_quality_stage_sends_no_text_along(spark, monkeypatch):
    """Rows are kept by their text's score: those without id, those that share one, and all columns."""
    good, bad = "fine words here", "zz !! zz"
    rows = [(i, good + f" {i % 7}" if i % 2 else bad + f" {i % 7}", i) for i in range(200)] + [(None, good + " 1", 1), (None, bad + " 2", 2), (3, bad + " 2", 3), (3, good + " 3", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more long").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200) if i != 3], "doc_id long, quality int")
    kept = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: kept.append(fit(*a, **k)) or kept[-1])
    found = good_documents(docs, labels)
    assert Counter(found.collect()) == Counter(r for r in docs.collect() if r.text.startswith("fine"))
    assert not any(t == "string" for _, t in kept[0].rows.dtypes)
