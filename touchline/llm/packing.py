"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents are tokenised where they are read; from there on only pieces travel (id, place, length, checksum). The
pieces are dealt by hash to groups of many thousands, and each group is packed online: a fixed number of open
sequences, kept in a bitset by their free space, of which the one that fits most closely takes the piece. When
there is no room for another open sequence, the fullest closes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import Plain, arrow_bytes, table
from touchline.llm.rolling import Roller
from touchline.session import written

LENGTH = 1024
END = 2
#: Open sequences of a group.
OPEN = 4096
#: Pieces that arrive together, the longest first: with pieces in any order, best fit fills one sequence less in
#: a hundred. Not above ``OPEN``, so that the long ones of a block need not be closed before the short ones come.
BLOCK = 4096
#: Pieces in a group, on average. A group leaves at most ``OPEN`` sequences unfilled.
GROUP_PIECES = 250_000
#: Words of the tokeniser's cache in a task; it starts anew when full.
CACHE_WORDS = 1_000_000
#: Texts that look up their words together.
TEXTS = 200

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokenizer:
    """The ids of ``tokenizers``, found word by word: only words that a task has not met yet are tokenised.

    The vocabulary cuts a text before every blank that stands alone between two other characters, so a text's ids
    are those of its words with their blank in front. Where a neighbour of the blank may be white space, the text
    is not cut. Words are told apart by 64-bit hashes and looked up in the same vocabulary's ranks, which gives the
    ids of ``tokenizers`` in a quarter of the time; a text with a special token in it goes to ``tokenizers``."""

    def __init__(self, vocabulary: str, ranks: str) -> None:
        import base64
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            self.special = [t["content"].encode() for t in json.load(f).get("added_tokens", [])]
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
        self.spelt = np.zeros(max(table.values()) + 1, np.int64)
        self.spelt[list(table.values())] = [len(spelling) for spelling in table]
        self.roller = Roller()
        self._forget()

    def _forget(self) -> None:
        self.known, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _alone(self, word: bytes) -> np.ndarray:
        return np.array(self.words.encode_ordinary(word.decode("utf-8", "replace")), np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add words, each with its blank in front."""
        ids = self._alone(b"".join(words))
        last = np.searchsorted(np.cumsum(self.spelt[ids]), np.cumsum([len(w) for w in words])) + 1
        first = np.concatenate(([0], last[:-1]))
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.at = np.insert(self.at, where, first + len(self.pool))
        self.size = np.insert(self.size, where, last - first)
        self.pool = np.concatenate((self.pool, ids))

    def _cuts(self, buffer: np.ndarray) -> np.ndarray:
        """Where a blank stands between characters that are surely no white space: of ASCII, or of two bytes
        other than those that begin with C2."""
        seen = (buffer > 32) & (buffer < 127)
        two = (buffer >= 0xC3) & (buffer <= 0xDF)
        after = seen | two
        before = seen.copy()
        before[1:] |= two[:-1]
        cut = np.zeros(len(buffer), bool)
        cut[1:-1] = (buffer[1:-1] == 32) & before[:-2] & after[2:]
        return np.flatnonzero(cut)

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.known) > CACHE_WORDS:
            self._forget()
        special = {i: t for i, t in enumerate(texts) if any(s in t for s in self.special)}
        texts = [b"" if i in special else t for i, t in enumerate(texts)]
        # a line end between texts, so that no blank beside it is cut at
        held = b"\n".join(texts)
        buffer = np.frombuffer(held, np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        cuts = self._cuts(buffer)
        bound = np.searchsorted(cuts, ends)  # how many cuts lie before a text's end
        before = np.concatenate(([0], bound[:-1]))
        # words between two cuts; the first and the last word of a text are looked up alone
        inner = np.ones(max(0, len(cuts) - 1), bool)
        inner[bound[(bound > 0) & (bound < len(cuts))] - 1] = False
        number = np.flatnonzero(inner)
        hashes = self.roller.spans(self.roller.prefix(self.roller.bytes[buffer]), cuts[number], cuts[number + 1])
        kinds, some, which = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.known, kinds)
        new = where == len(self.known)
        new[~new] = self.known[where[~new]] != kinds[~new]
        if new.any():
            at = number[some[new]]
            self._learn(kinds[new], [held[i:j] for i, j in zip(cuts[at].tolist(), cuts[at + 1].tolist(), strict=True)])
            where = np.searchsorted(self.known, kinds)
        size = self.size[where][which]
        until = np.cumsum(size)
        flat = np.repeat(self.at[where][which] - (until - size), size) + np.arange(until[-1] if len(until) else 0)
        ids = self.pool[flat]
        until = np.concatenate(([0], until))
        reach = np.concatenate(([0], np.cumsum(inner)))  # inner words up to a cut
        out = []
        for i, text in enumerate(texts):
            if i in special:
                whole = self.whole.encode(special[i].decode("utf-8", "replace"), add_special_tokens=False).ids
                out.append(np.array(whole, np.uint32))
            elif before[i] == bound[i]:
                out.append(self._alone(text))
            else:
                first, last = cuts[before[i]], cuts[bound[i] - 1]
                middle = ids[until[reach[before[i]]] : until[reach[bound[i] - 1]]]
                out.append(np.concatenate((self._alone(held[starts[i] : first]), middle, self._alone(held[last : ends[i]]))))
        return out


def cut(ids: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, checksum) of a document's ids, four bytes each. Only a longer document is cut; its
    first piece takes what is over, so that all others are full."""
    n = len(ids) // 4
    size = n % length or min(n, length)
    start, piece = 0, 0
    while start < n:
        yield piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)])
        start, piece, size = start + size, piece + 1, length


class OpenBins:
    """A bounded number of open sequences by free space. Bit f of ``held`` tells that some have f free."""

    def __init__(self, length: int, most: int) -> None:
        self.length, self.most = length, most
        self.held, self.open = 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(length + 1)]

    def _pop(self, space: int) -> int:
        bins = self.by_space[space]
        number = bins.pop()
        if not bins:
            self.held &= ~(1 << space)
        self.open -= 1
        return number

    def fit(self, size: int) -> tuple[int, int] | None:
        """Take out the open sequence with the least space of at least ``size``: its number and space."""
        fitting = self.held >> size
        if not fitting:
            return None
        space = size + (fitting & -fitting).bit_length() - 1
        return self._pop(space), space

    def put(self, number: int, space: int) -> None:
        """Put a sequence with ``space`` left back, closing the fullest first if there is no room."""
        if not space:
            return
        if self.open == self.most:
            self._pop((self.held & -self.held).bit_length() - 1)
        self.by_space[space].append(number)
        self.held |= 1 << space
        self.open += 1


def _tokenise(id_type: pa.DataType, vocabulary: str, ranks: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(vocabulary, ranks)
        tail = end.to_bytes(4, "little")
        for batch in (b.slice(i, TEXTS) for b in batches for i in range(0, b.num_rows, TEXTS)):
            found = tokenizer(arrow_bytes(batch["text"]))
            rows = [(i, *piece) for i, ids in enumerate(found) for piece in cut(ids.tobytes() + tail, length)]
            which, piece, start, size, crc = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(which, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (start, size, crc)],
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def _pack(length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins: dict[int, OpenBins] = {}  # a task has few groups: there are about as many partitions
        opened: dict[int, int] = {}
        for batch in (b.slice(i, BLOCK) for b in batches for i in range(0, b.num_rows, BLOCK)):
            batch = batch.sort_by([("length", "descending")])
            numbers, offsets = [], []
            for group, size in zip(batch["group"].to_pylist(), batch["length"].to_pylist(), strict=True):
                own = bins.get(group)
                if own is None:
                    own, opened[group] = bins.setdefault(group, OpenBins(length, most)), 0
                found = own.fit(size)
                if found:
                    number, space = found
                else:
                    number, space = (group << 40) + opened[group], length
                    opened[group] += 1
                numbers.append(number)
                offsets.append(length - space)
                own.put(number, space - size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    length: int = LENGTH,
    end: int = END,
    open_bins: int = OPEN,
    group_pieces: int = GROUP_PIECES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``vocabulary`` is a file of ``tokenizers`` and ``ranks`` the same vocabulary as ranks; without them the public
    byte-level vocabulary is used. A null or empty text is the end token alone. Rows that repeat, or whose id is
    null, are packed like any others. An empty table gives an empty result."""
    import public_tokenizers

    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = Plain(docs)
    source = plain.df.select(F.col(plain[id_column]).cast("long").alias("doc_id"), F.col(plain[text_column]).alias("text"))
    pieces = written(source.mapInArrow(_tokenise(pa.int64(), vocabulary, ranks, length, end), PIECES))
    groups = max(1, round(pieces.count() / group_pieces))
    dealt = pieces.withColumn(
        "group", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)).cast("long")
    ).repartition(groups, "group")
    return dealt.mapInArrow(_pack(length, open_bins), f"{PIECES}, sequence_id long, offset long")


def op1_best_fit_packing(spark, sf_dir) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
