"""Repeated phrases and strings against brute force."""

import hashlib
import random
import re
from collections import Counter

import pyspark.sql.types as T
import pytest

from touchline.llm.bwt_dedup import remove_strings
from touchline.llm.phrase_dedup import remove_phrases

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def brute(symbols: list[list], size: int) -> list[list[bool]]:
    met = Counter(tuple(s[i : i + size]) for s in symbols for i in range(len(s) - size + 1))
    out = []
    for s in symbols:
        gone = [False] * len(s)
        for i in range(len(s) - size + 1):
            if met[tuple(s[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append(gone)
    return out


def corpus(seed: int, alphabet: str, copies: int = 25) -> list[str | None]:
    """Texts with shared parts, edited copies, exact copies, periodic texts and empty ones."""
    rng = random.Random(seed)
    fresh = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [fresh(rng.randint(30, 300)) for _ in range(4)]
    texts = ["", None, "a", "ab " * 90, " \t\n ", "é" * 60]
    for _ in range(30):
        texts.append(fresh(rng.randint(0, 60)) + rng.choice(shared)[rng.randint(0, 20) :] + fresh(rng.randint(0, 60)))
    first = fresh(400)
    for _ in range(copies):  # near copies: one place changed
        at = rng.randrange(400)
        texts.append(first[:at] + rng.choice(alphabet) + first[at + 1 :])
    texts += [first, first, texts[8], texts[8]]
    rng.shuffle(texts)
    return texts


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1])
@pytest.mark.parametrize("bucket", [4000, 6])  # with 6, most anchors are too large for a bucket
def test_phrases_equal_brute_force(spark, seed, bucket):
    texts = corpus(seed, "ab c")
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    got = {r.doc_id: r for r in remove_phrases(frame(spark, texts), 6, 3, bucket).collect()}
    assert len(got) == len(texts)
    for i, gone in enumerate(brute(words, 6)):
        kept = " ".join(w for w, g in zip(words[i], gone, strict=True) if not g)
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (len(words[i]), sum(gone), kept)


@pytest.mark.parametrize("seed", [2])
@pytest.mark.parametrize(("size", "gram", "bucket", "shard"), [(48, 10, 4000, 32), (20, 4, 5, 64), (7, 7, 50, 16)])
def test_strings_equal_brute_force(spark, seed, size, gram, bucket, shard):
    texts = corpus(seed, "abé")
    data = [(t or "").encode() for t in texts]
    got = {r.doc_id: r for r in remove_strings(frame(spark, texts), size, gram, bucket, shard).collect()}
    assert len(got) == len(texts)
    for i, gone in enumerate(brute([list(d) for d in data], size)):
        kept = bytes(b for b, g in zip(data[i], gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(data[i]), sum(gone), spans)
        assert bytes(got[i].kept) == kept


@pytest.mark.parametrize("remove", [remove_phrases, remove_strings])
def test_empty_tables_null_ids_and_clashing_names(spark, remove):
    assert remove(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame(
        [(None, "x " * 500, 1, "s"), (None, "x " * 500, 2, "t"), (3, None, 3, "u")],
        "doc_id long, text string, kept int, K0 string",
    )
    rows = remove(odd).collect()
    assert sorted((r.doc_id or 0, len(r.kept or "")) for r in rows) == [(0, 0), (0, 0), (3, 0)]


def test_whole_texts_of_any_length(spark):
    """A passage repeated far from the start of a very long text is found."""
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randrange(10**9)}" for _ in range(60))
    long = " ".join(str(rng.randrange(10**9)) for _ in range(250_000))
    rows = {r.doc_id: r for r in remove_phrases(frame(spark, [f"{long} {passage} end", f"begin {passage}"])).collect()}
    assert (rows[0].n_removed, rows[1].n_removed, rows[1].kept) == (60, 60, "begin")
    assert hashlib.sha256(rows[0].kept.encode()).digest() == hashlib.sha256(f"{long} end".encode()).digest()
