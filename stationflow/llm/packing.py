"""Harmonic packing of tokenised documents into fixed-capacity sequences."""

from __future__ import annotations

import os
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stationflow.llm.common import ids_and_text

CAPACITY = 4096
END_ID = 2
#: A piece may leave this share of its slot empty; a longer tail is cut once more.
SLACK = 1 / 64
#: Words whose ids a worker keeps; the store is emptied when it is full.
WORDS_KEPT = 300_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
#: White space on which str.split() and the tokenizer may differ.
ODD_SPACE = re.compile("[\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

#: Words of letters on which Python and the tokenizer surely agree about case and class.
PLAIN = regex.compile("[\x21-\x7e\xa1-\u024f]+")
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class WordIds(dict):
    """Ids of words as little-endian bytes. The tokenizer drops white space and never joins across it.

    Plain Latin words that aren't in the store go through tiktoken's merge loop with
    the same vocabulary, which is many times faster on single words; ``END`` stands
    for the vocabulary's word end. All other words go through ``tokenizers``.
    """

    made: dict[str, WordIds] = {}
    END = "\0"  # never part of the words that meet it

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {}
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if token not in special:
                ends = token.endswith("</w>") and token != "</w>"
                ranks[bytes(byte[c] for c in (token[:-4] if ends else token)) + self.END.encode() * ends] = number
        self.merge = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @classmethod
    def of(cls, path: str) -> WordIds:
        """One store for each worker process."""
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        if PLAIN.fullmatch(word) and "<|" not in word:
            ids = array("I", self.merge(self.END.join([*PARTS.findall(word.lower()), ""]))).tobytes()
        else:
            ids = self.whole(word)
        if len(word) <= 64:
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; none for null."""
        if not text:
            return b""
        if ODD_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


def cut(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """``(length, class)`` of the pieces of a document of ``n`` ids.

    Class j holds lengths above capacity/(j+1) and up to capacity/j, j to a sequence.
    A tail that would leave more than ``slack`` of its slot empty gives up a piece
    that fills a slot of the next class; what is left shrinks with each cut, so a tail
    has few pieces.
    """
    pieces = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        j = capacity // rest
        slot = capacity // j
        if slot - rest <= slack * slot:
            pieces.append((rest, j))
            break
        pieces.append((capacity // (j + 1), j + 1))
        rest -= capacity // (j + 1)
    return pieces


class Bins:
    """The open sequences of one worker: one for each class, closed at its fixed count."""

    def __init__(self, worker: int, capacity: int) -> None:
        self.next_id, self.capacity = worker << 32, capacity
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.rows: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, length, ids, tokens in pieces:
            self.rows.append((doc_id, start, length, ids, tokens, self.next_id, offset))
            offset += length
        self.next_id += 1

    def add(self, doc_id: int | None, ids: bytes, slack: float) -> None:
        tokens, start = len(ids) // 4, 0
        for length, j in cut(tokens, self.capacity, slack):
            here = self.open[j]
            here.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], tokens))
            start += length
            if len(here) == j:
                self.close(self.open.pop(j))

    def finish(self) -> None:
        """Put what is left in unfinished classes together, longest first, each where it first fits."""
        left = sorted((p for ps in self.open.values() for p in ps), key=lambda p: -p[2])
        self.open.clear()
        bins: list[list[tuple]] = []
        room: list[int] = []
        for p in left:
            at = next((i for i, r in enumerate(room) if r >= p[2]), len(room))
            if at == len(room):
                bins.append([])
                room.append(self.capacity)
            bins[at].append(p)
            room[at] -= p[2]
        for b in bins:
            self.close(b)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


def harmonic_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, slack: float = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents with their place in sequences of at most ``capacity`` ids.

    Returns ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ``ids``
    are little-endian unsigned 32-bit ids, and every document ends with ``end_id``.
    Each worker packs the rows of its own input splits by itself: no shuffle, and at
    most one open sequence of each class in memory. Null and empty texts are one
    piece of ``end_id`` alone; repeated rows are packed once each; a null id stays
    null; a very long text fills whole sequences; other columns are left out; an
    empty table gives an empty result. ``tokenizer`` is the file's path, which must
    be readable on every executor.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, words = Bins(TaskContext.get().partitionId(), capacity), WordIds.of(tokenizer)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bins.add(doc_id, words.encode(text) + end, slack)
                if len(bins.rows) >= 4096:
                    yield bins.batch()
        bins.finish()
        yield bins.batch()

    return ids_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
