"""Removal of repeated phrases, located by Aho-Corasick automata.

Which 35-word windows may recur, and where, comes from ``recurrence``. Its buckets are the shards: a shard confirms
the phrases that recur among its passages, compiles an automaton of them, and streams all its passages through
the automaton to locate every occurrence. Documents are cut into passages so that each reaches only the shards that
hold its anchors; streaming every document through every shard would cost the square of the input.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.common import arrow_bytes, table
from touchline.llm.recurrence import Windows, marked, with_spans

WORDS = 35
ANCHOR_WORDS = 8
#: Passages in a shard: with some 12 windows of 35 words each, their automaton stays below 100 MB.
SHARD_PASSAGES = 2000


def _symbols(passages: list[list[bytes]]) -> list[str]:
    """Each passage as a string with one character for each word."""
    number: dict[bytes, int] = defaultdict(lambda: len(number))
    coded = [[number[w] for w in passage] for passage in passages]
    # no surrogates; a shard has far fewer words than there are other characters
    return ["".join([chr(c + 0x100 if c < 0xD000 else c + 0x1000) for c in passage]) for passage in coded]


def locate_phrases(size: int):
    """For a shard's passages: which windows of ``size`` words recur."""

    def run(shard: pa.Table) -> pa.Table:
        import ahocorasick

        passages = _symbols([cover.split() for cover in shard["cover"].to_pylist()])
        times = shard["times"].to_pylist()
        met: dict[str, int] = defaultdict(int)
        for passage, n in zip(passages, times, strict=True):
            for i in range(len(passage) - size + 1):
                met[passage[i : i + size]] += n
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase, n in met.items():
            if n > 1:
                automaton.add_word(phrase)
        del met
        automaton.make_automaton()
        masks = []
        for passage in passages:
            starts = np.zeros(len(passage) - size + 1, bool)
            if len(automaton):
                starts[[end - size + 1 for end, _ in automaton.iter(passage)]] = True
            masks.append(np.packbits(starts).tobytes())
        return pa.table({"anchor": shard["anchor"], "context": shard["context"], "mask": pa.array(masks, pa.binary())})

    return run


def _kept(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, spans in zip(arrow_bytes(batch["text"]), batch["spans"].to_pylist(), strict=True):
                words = text.split()
                gone = marked(len(words), size, spans)
                counts.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(compress(words, (~gone).tolist()) if removed[-1] else words))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_phrases(
    docs: DataFrame,
    words: int = WORDS,
    anchor_words: int = ANCHOR_WORDS,
    shard_passages: int = SHARD_PASSAGES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_removed, kept (text: the kept words, joined by blanks).

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window of ``words`` words in a row that covers it occurs at
    any other place, in the same document or another. Windows are judged on the whole input. A null text is an
    empty one, without words; texts with fewer words than a window keep all; rows that repeat lose all windows."""
    windows = Windows(True, words, anchor_words)
    rows = with_spans(docs, windows, locate_phrases(words), id_column, text_column, shard_passages)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_kept(words), f"doc_id {id_type}, n_words long, n_removed long, kept binary")
    return found.withColumn("kept", found["kept"].cast("string"))


def op5_phrase_automata(spark, sf_dir) -> DataFrame:
    found = remove_phrases(table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "n_words", "n_removed", "sha2(kept, 256) AS kept_sha256")


OP5_SQL = r"""
WITH held AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, unnest([md5(array_to_string(words[i : i + 34], ' ')) FOR i IN range(1, len(words) - 33)]) AS window_hash,
         unnest(range(1, len(words) - 33)) AS start
  FROM held WHERE len(words) >= 35
), again AS (SELECT window_hash FROM windows GROUP BY window_hash HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 35)) AS place FROM windows SEMI JOIN again USING (window_hash)),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM held),
cut AS (
  SELECT doc_id, count(*) AS n_words, count(g.place) AS n_removed,
         string_agg(word, ' ' ORDER BY p.place) FILTER (g.place IS NULL) AS kept
  FROM placed p LEFT JOIN gone g USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN cut USING (doc_id)
"""
