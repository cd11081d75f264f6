"""Ranked lexical search: hashed max-sketches give upper bounds, documents are rescored exactly in descending order of them."""

from __future__ import annotations

import math
import string
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import ids_and_text, staged

TOP = 20
#: Cells of a document's sketch, and documents whose sketches a task holds at a time.
CELLS, DOCS_AT_ONCE = 2048, 256
#: Characters of item text that one pass may send to the executors.
ITEM_CHARS = 1 << 20
#: Bytes of a text that are cut into terms at a time.
TEXT_BYTES = 1 << 20
#: Terms whose cell a task remembers.
REMEMBERED = 200_000
#: Sums of up to CELLS products in float32 are off by less than this share.
SLACK = 1 + CELLS * 2.0**-23
SEED = 42
#: Fixed values of the score.
UNIT, TF_UNIT, LENGTH_UNIT, B_PCT, WEIGHT_UNIT = 1_000_000_000, 1000, 12, 25, 1000
_KEEP = set(string.ascii_letters + string.digits)
#: Bytes to terms: A-Z lower-cased, every other ASCII sign but letters and digits a blank.
_TABLE = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b) in _KEEP else 32 for b in range(256))
PART_ARROW = pa.schema([("term", pa.binary()), ("n", pa.int64()), ("terms", pa.int64())])
HIT_ARROW = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def term_counts(text: str | None) -> Counter[bytes]:
    """How often each term occurs: runs of ASCII letters, digits and all signs beyond ASCII, A-Z lower-cased. A long text is cut in pieces between terms."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    found: Counter[bytes] = Counter()
    at = 0
    while at < len(data):
        end = data.find(b" ", at + TEXT_BYTES)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all terms of theirs, and in how many documents each asked term occurs."""

    docs: int
    terms: int
    df: dict[bytes, int]

    def weight(self, term: bytes) -> int:
        return math.floor(WEIGHT_UNIT * math.log((2 * self.docs + 2) / (2 * self.df.get(term, 0) + 1)))

    def length(self, n: int) -> int:
        """The document's m."""
        return 100 - B_PCT + (B_PCT * n * self.docs // self.terms if n else 0)


def impact(tf: int, m: int) -> int:
    return UNIT * tf // (TF_UNIT * tf + LENGTH_UNIT * m)


class Cells(dict):
    """The cell of a term, remembered."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[term] = cell = xxhash.xxh3_64_intdigest(term, SEED) % CELLS
        return cell


def sketch(counts: Counter[bytes], m: int, cells: Cells, out: np.ndarray) -> None:
    """Fold the impacts of a document into coordinatewise maxima in ``out``."""
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    at = np.fromiter((cells[t] for t in counts), np.int64, len(counts))
    np.maximum.at(out, at, (UNIT * tf // (TF_UNIT * tf + LENGTH_UNIT * m)).astype(np.float32))


class Asked:
    """Items as weights by cell, for bounds of many items at once, and by term, for exact scores."""

    def __init__(self, items: list[tuple[int, Counter[bytes]]], corpus: Corpus):
        self.items = [k for k, _ in items]
        self.terms = [[(t, n * corpus.weight(t)) for t, n in counts.items() if corpus.df.get(t)] for _, counts in items]
        weights, cells = np.zeros((CELLS, len(items))), Cells()
        for k, terms in enumerate(self.terms):
            for t, w in terms:
                weights[cells[t], k] += w
        self.cells = weights.astype(np.float32)

    def score(self, k: int, counts: Counter[bytes], m: int) -> int:
        return sum(w * impact(counts[t], m) for t, w in self.terms[k] if t in counts)

    def bounds(self, sketches: np.ndarray) -> np.ndarray:
        """At least the score of each document (row) for each item (column)."""
        return (sketches @ self.cells).astype(np.float64) * SLACK


class Leaders:
    """The ``top`` best documents of each item so far, as ``(-score, doc_id)`` in order; those without an id come last."""

    def __init__(self, n: int, top: int):
        self.top, self.best = top, [[] for _ in range(n)]
        self.least = np.ones(n)  # a document must reach this bound to be looked at

    def offer(self, k: int, score: int, doc: int | None) -> None:
        best = self.best[k]
        if score > 0:
            insort(best, (-score, doc is None, doc or 0))
            del best[self.top :]
            if len(best) == self.top:
                self.least[k] = -best[-1][0]


def search_block(asked: Asked, corpus: Corpus, ids: list, texts: list, cells: Cells, leaders: Leaders) -> int:
    """Offer a block of documents to the leaders; how many were rescored.

    Each item's documents are rescored in descending order of their bounds, until the bound falls below the item's last leader.
    """
    counts = [term_counts(t) for t in texts]
    lengths = [corpus.length(c.total()) for c in counts]
    sketches = np.zeros((len(ids), CELLS), np.float32)
    for c, m, row in zip(counts, lengths, sketches, strict=True):
        if c:
            sketch(c, m, cells, row)
    bounds = asked.bounds(sketches)
    looked = 0
    for k in np.flatnonzero((bounds >= leaders.least).any(0)):
        for d in np.argsort(-bounds[:, k], kind="stable"):
            if bounds[d, k] < leaders.least[k]:
                break
            leaders.offer(k, asked.score(k, counts[d], lengths[d]), ids[d])
            looked += 1
    return looked


def corpus_counts(texts: DataFrame, terms: set[bytes]) -> Corpus:
    """Counts over all documents; document counts of the asked ``terms`` alone."""
    sent = texts.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, df = sent.value, Counter()
        docs = total = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts = term_counts(text)
                docs += bool(counts)
                total += counts.total()
                df.update(asked.intersection(counts))
        rows = [(None, docs, total), *((t, n, 0) for t, n in df.items())]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PART_ARROW, strict=True)], schema=PART_ARROW)

    parts = texts.select("text").mapInArrow(run, "term binary, n long, terms long")
    rows = parts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("terms").alias("terms")).collect()  # a row for each asked term
    whole = next((r for r in rows if r["term"] is None), None)
    return Corpus(whole["n"] if whole else 0, whole["terms"] if whole else 0, {bytes(r["term"]): r["n"] for r in rows if r["term"] is not None})


def item_blocks(items: DataFrame, item_chars: int) -> Iterator[tuple[list, bool]]:
    """Rows ``item, text`` in blocks of about ``item_chars`` of text, and whether there are several."""
    chars = items.agg(F.sum(F.length("text") + 1).alias("n")).first()["n"] or 0
    blocks = -(-2 * chars // item_chars) if chars > item_chars else 1
    cut = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    for k in range(blocks):
        yield cut.where(F.col("block") == k).orderBy("item").collect(), blocks > 1  # bounded by item_chars


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", item_chars: int = ITEM_CHARS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents with the highest scores above 0 for each item, equal scores by id.

    A term's weight falls with the documents that hold it; a document's impact for a term grows with its occurrences,
    and less so in long documents, all in whole numbers. Two passes read the texts: the first counts, the second folds each document's
    impacts into the maxima of CELLS cells by a hash of the term, multiplies a block of such sketches with all items' weights by
    cell, and rescores exactly what these bounds let in. Bounds only save work; scores and ranks are exact. What leaves a task is
    its leaders; they meet by groups of tasks first, so no task gets those of all.

    Items of more than ``item_chars`` characters are taken in several passes. Null and empty texts, and those
    without a term, have no terms and no result; they don't count as documents. Documents without an id count and are ranked after
    equal scores with one. Repeated rows are documents each, and so are repeated items (each gets its own ranks); items
    without an id are taken like others, with a null id. Texts of any length are taken whole; other columns are left out; empty tables give an empty result.
    """
    texts = ids_and_text(docs, id_col, text_col)
    # items of one text and id are told apart by a number of theirs
    named = staged(items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).withColumn("item", F.monotonically_increasing_id()))
    found = None
    for rows, several in item_blocks(named.select("item", "text"), item_chars):
        counts = [(r["item"], term_counts(r["text"])) for r in rows]
        corpus = corpus_counts(texts, {t for _, c in counts for t in c})
        part = _leaders(texts, Asked(counts, corpus), corpus, top)
        part = staged(part) if several else part  # so that an executor holds one block at a time
        found = part if found is None else found.unionByName(part)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "deal").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _leaders(texts: DataFrame, asked: Asked, corpus: Corpus, top: int) -> DataFrame:
    """``item, doc_id, score, deal``: each task's leaders; ``deal`` is a group of tasks."""
    sent = texts.sparkSession.sparkContext.broadcast((asked, corpus))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, corpus = sent.value
        cells, leaders = Cells(), Leaders(len(asked.items), top)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                block = batch.slice(at, DOCS_AT_ONCE)
                search_block(asked, corpus, block.column(0).to_pylist(), block.column(1).to_pylist(), cells, leaders)
        hits = [(asked.items[k], None if unnamed else doc, -score) for k, best in enumerate(leaders.best) for score, unnamed, doc in best]
        columns = list(zip(*hits, strict=True)) or [[]] * len(HIT_ARROW)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, HIT_ARROW, strict=True)], schema=HIT_ARROW)

    return texts.mapInArrow(run, "item long, doc_id long, score long").withColumn("deal", (F.spark_partition_id() / 64).cast("int"))
