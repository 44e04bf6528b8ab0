"""Bigram scores and revisits against plain Python."""

import math
from collections import Counter

import pytest

from touchline.llm import lm_score
from touchline.llm.lm_score import score
from touchline.llm.revisits import canonical_url, resolve_revisits
from touchline.llm.rolling import Roller


def test_revisits_equal_a_scan(spark):
    urls = ["http://A.org/x", "https://www.a.org/x/#f", "http://b.org/?utm_source=q", "http://b.org", None]
    rows = []
    for i in range(120):
        kind = "response" if i % 3 == 0 else "revisit"
        etag = f"e{i % 2}" if i % 4 else None
        date = f"d{i % 3 // 2}" if i % 5 else None
        headers = {"date": f"t{i}", "x-own": str(i), "etag": str(etag)} if i % 7 else None
        rows.append((i, urls[i % 5], (i * 37) % 50 if i % 11 else None, kind, etag, date, headers))
    schema = "record_id long, url string, time long, kind string, etag string, last_modified string, headers map<string,string>"
    records = spark.createDataFrame(rows, schema)
    key = {r.url: r.key for r in records.select("url", canonical_url(records.url).alias("key")).distinct().collect()}
    assert key[urls[0]] == key[urls[1]] == "a.org/x" and key[urls[2]] == key[urls[3]] == "b.org"
    for stretches in (1, 8):
        got = {r.record_id: r for r in resolve_revisits(records, stretches).collect()}
        assert set(got) == {r[0] for r in rows if r[3] == "revisit"}
        for i, url, time, kind, etag, date, headers in rows:
            if kind == "response":
                continue
            before = [r for r in rows if r[3] == "response" and time is not None and r[2] is not None and url and r[1] and key[r[1]] == key[url] and (r[2], r[0]) < (time, i)]
            if not before:
                assert (got[i].state, got[i].original_id, got[i].headers) == ("missing", None, None)
                continue
            best = max(before, key=lambda r: (r[2], r[0]))
            state = "unverified"
            if etag and best[4]:
                state = "resolved" if etag == best[4] else "changed"
            elif date and best[5]:
                state = "resolved" if date == best[5] else "changed"
            want = {**(best[6] or {}), **{k: v for k, v in (headers or {}).items() if k in ("date", "etag")}}
            assert (got[i].original_id, got[i].state) == (best[0], state)
            assert got[i].headers == (want if state != "changed" else None)
    assert resolve_revisits(records.limit(0)).count() == 0


def test_ids_of_any_type_and_clashing_columns(spark):
    rows = [("x", "a b a b", 1), ("x", "a b a b", 1), (None, "a b", 2), ("y", None, 3), ("z", " \n", 4)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, chunk int").selectExpr("*", "chunk AS n", "chunk AS word")
    labels = spark.createDataFrame([("x", 1)], "doc_id string, quality int")
    got = score(docs, labels).collect()
    assert sorted((r.doc_id or "", r.n_words) for r in got) == [("", 2), ("x", 4), ("x", 4), ("y", 0), ("z", 0)]
    assert all((r.score is None) == (r.n_words == 0) for r in got)
    assert len({r.score for r in got if r.doc_id == "x"}) == 1


def test_words_of_a_long_buffer_are_hashed_in_parts(monkeypatch):
    text = b"  a bb ccc\td " + b"x" * 40 + b"\nlast a"
    whole = [x.tolist() for x in lm_score._words_of(Roller(), text)]
    assert len(whole[0]) == 7 and whole[0][0] == whole[0][-1]
    monkeypatch.setattr(lm_score, "PART", 3)
    assert [x.tolist() for x in lm_score._words_of(Roller(), text)] == whole
    assert [len(x) for x in lm_score._pairs(Roller(), [b"", b" "])] == [0, 0, 0]


@pytest.mark.parametrize("shared", [lm_score.SHARED, -1])
def test_scores_equal_plain_counts(spark, monkeypatch, shared):
    """With one text in a third of the rows; the good ids shared or joined."""
    monkeypatch.setattr(lm_score, "SHARED", shared)
    good = ["a b c a b c d", "a b a b"]
    rest = ["d d c b", "b a d d yy", "c c a", "zz zz zz b"] + ["e f e b"] * 3 + ["", "a b new words d d", "once"]
    docs = spark.createDataFrame([*enumerate(good + rest), (99, None)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(0, 1), (1, 1), (1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    sides = {"t": [t.split() for t in good], "b": [t.split() for t in rest]}
    one = {s: Counter(w for ws in sides[s] for w in ws) for s in sides}
    pair = {s: Counter(p for w in ws for p in zip(["<"] + w, w)) for s, ws in sides.items()}
    after = {s: Counter(v for (v, _), n in pair[s].items() for _ in range(n)) for s in sides}
    vocabulary = {w for w in one["t"] | one["b"] if one["t"][w] + one["b"][w] >= 3}
    assert {"e", "f", "zz"} <= vocabulary
    total = sum(one["t"].values())

    def loss(s, v, w):
        scale = total / sum(one[s].values())
        n = sum(one[s][x] for x in one[s] if x not in vocabulary) if w not in vocabulary else one[s][w]
        p = (n * scale + 1) / (total + len(vocabulary) + 1)
        if w not in vocabulary or pair["t"][v, w] + pair["b"][v, w] < 2:
            return -math.log(p)
        return -math.log(0.6 * (pair[s][v, w] / after[s][v] if after[s][v] else 0) + 0.4 * p)

    got = {r.doc_id: r.score for r in score(docs, labels).collect()}
    assert got[99] is None and len(got) == len(good + rest) + 1
    for i, text in enumerate(good + rest):
        words = text.split()
        if not words:
            assert got[i] is None
            continue
        want = sum(loss("t", v, w) - loss("b", v, w) for v, w in zip(["<"] + words, words)) / len(words)
        assert got[i] == pytest.approx(want, abs=1e-9)
    assert {r.score for r in score(docs, labels.limit(0)).collect()} == {0.0, None}
    assert score(docs.limit(0), labels).count() == 0
