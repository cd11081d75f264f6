"""Near-duplicates by the Jaccard similarity of word shingles: families from the SimHash tries, compared exactly."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import ids_and_text, join_copies, of_texts, per_row, staged, stretches
from stationflow.llm.graph import connected_components
from stationflow.llm.simhash_dedup import _settle, near_links

SHINGLE = 5
JACCARD = 0.8
#: Fingerprint words of 64 bits, and bits that may differ in one. At JACCARD a bit differs with probability 0.151, so
#: a pair agrees in a whole block of a word and within the budget with 0.44, and in none of ten words with 0.003. Unrelated
#: texts agree in some word with 0.036 in 200,000; two more words check a pair, which leaves 1e-5 of such, and all but 1e-6 of pairs at JACCARD.
WORDS, MAX_BITS, CHECKS = 10, 11, (1, 5)
SEED = 42
#: Texts, and bytes of shingle hashes, of one part of a family; two parts meet in a task.
PART_TEXTS, PART_BYTES = 512, 8 << 20
COLUMNS = 4096
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_TURN = np.random.default_rng(SEED + 1).integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mark_of(words: list[bytes]) -> int:
    """A 64-bit hash of the words in order; texts with the same words have the same shingles."""
    return xxhash.xxh3_64_intdigest(b" ".join(words), SEED)


def shingles(words: list[bytes]) -> np.ndarray:
    """The sorted distinct hashes of all runs of five words; of the whole text if it is shorter; none without a word."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([mark_of(words)], np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(w) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += _mixed(w[k : k + n] * _TURN[k])
    return np.unique(_mixed(total))


def long_fingerprint(found: np.ndarray) -> np.ndarray:
    """The SimHash of a set of hashes in WORDS words of 64 bits."""
    votes = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(found), 512):
        bits = np.unpackbits(_mixed(found[at : at + 512, None] * _ODD).astype(">u8").view(np.uint8), axis=1)
        votes += bits.sum(0, dtype=np.uint16)
    return np.packbits(2 * votes > len(found)).view(">u8").astype(np.uint64).view(np.int64)


def _marks(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n, fps`` of every row: its words' hash, how many shingles, and its fingerprint."""

    def run(ids: list, texts: list) -> tuple[list, ...]:
        marks, sizes, fps = np.empty(len(texts), np.uint64), [], []
        for k, text in enumerate(texts):  # one text's words at a time
            words = words_of(text)
            found = shingles(words)
            marks[k] = mark_of(words)
            sizes.append(len(found))
            fps.append(long_fingerprint(found))
        return ids, marks.view(np.int64), sizes, fps

    kinds = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int32()), ("fps", pa.list_(pa.int64()))])
    return per_row(docs, run, "doc_id long, mark long, n int, fps array<long>", kinds)


def _sets(docs: DataFrame) -> DataFrame:
    """``mark, shingles`` of every row, the hashes as bytes."""

    def run(ids: list, texts: list) -> tuple[list, ...]:
        marks, found = np.empty(len(texts), np.uint64), []
        for k, text in enumerate(texts):
            words = words_of(text)
            marks[k] = mark_of(words)
            found.append(shingles(words).tobytes())
        return marks.view(np.int64), found

    return per_row(docs, run, "mark long, shingles binary", pa.schema([("mark", pa.int64()), ("shingles", pa.binary())]))


def similar_classes(sets: list[np.ndarray], least: float = JACCARD) -> np.ndarray:
    """The class of each set under links of a Jaccard similarity of ``least`` or more, as its first place.

    Common hashes are counted for all pairs at once, as the product of the incidence matrix with
    itself, a slice of columns at a time.
    """
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    found, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    many = np.repeat(np.bincount(column) > 1, np.bincount(column))
    column, owner = column[many], owner[many]
    column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]])) if len(column) else column
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[owner[a:b], column[a:b] - at] = 1
        common += has @ has.T
    near = np.triu(common >= least * (size[:, None] + size - common) - 1e-6, 1)
    label = np.arange(len(sets))
    _settle(label, *np.nonzero(near))
    return label


def _compared(families: DataFrame) -> DataFrame:
    """Links ``src, dst`` that join what is similar within each ``root, a, b`` of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for at, n in stretches(batch.column(4)) for row in zip(*(c.slice(at, n).to_pylist() for c in batch.columns), strict=True))
        for _, group in groupby(rows, key=lambda r: r[:3]):
            marks, sets = zip(*((r[3], np.frombuffer(r[4], np.uint64)) for r in group), strict=True)
            if len(marks) > 1:
                marks, label = np.array(marks, np.int64), similar_classes(list(sets))
                moved = np.flatnonzero(label != np.arange(len(label)))
                yield pa.RecordBatch.from_arrays([pa.array(marks[moved]), pa.array(marks[label[moved]])], ["src", "dst"])

    keys = ("root", "a", "b")
    return families.select(*keys, "mark", "shingles").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "src long, dst long")


def near_copy_roots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, component_id`` for every row of ``docs``; the least id of those linked by similar texts.

    Texts whose SimHash agrees in a whole block of some word, within MAX_BITS there and nearly so in two more words,
    make up families: each word's tries are joined with themselves under that budget, pairs are checked before they link, and only
    forests leave their tasks. So families hold similar texts alone, however many texts there are. Within its family every text is then compared exactly with
    every other. A family of many texts is dealt into parts, two of which meet in a task, so
    no task holds more than two parts and no pairs are written.
    """
    texts = ids_and_text(docs, id_col, text_col)
    marks = staged(_marks(texts))
    firsts = staged(marks.groupBy("mark").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("fps").alias("fps")))
    words = firsts.where("n > 0").select(F.col("mark").alias("node"), "fps", F.posexplode("fps").alias("word", "fp"))
    words = words.select("node", "word", "fp", *(F.element_at("fps", (F.col("word") + k) % WORDS + 1).alias(f"c{i}") for i, k in enumerate(CHECKS, 1)))
    family = staged(connected_components(near_links(words, MAX_BITS)).join(firsts, F.col("node") == F.col("mark")).select("mark", "root", "n", "first_id"))
    parts = F.greatest(F.ceil(F.count("*") / PART_TEXTS), F.ceil(F.sum("n") * 8 / PART_BYTES)).cast("int")
    sizes = family.groupBy("root").agg(parts.alias("parts"))
    wanted = staged(family.select(F.col("first_id").alias("doc_id")).distinct())  # written, so that Spark knows its size before it moves texts
    sets = _sets(texts.join(wanted, "doc_id", "left_semi")).dropDuplicates(["mark"])  # rows of one id may have several texts
    dealt = family.join(sizes, "root").join(sets, "mark").withColumn("mine", F.pmod(F.xxhash64("mark"), "parts").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    links = _compared(dealt.select("root", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mark", "shingles"))
    roots = staged(connected_components(links))
    linked = roots.join(firsts, F.col("node") == F.col("mark")).select("mark", "root", "first_id")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = staged(firsts.join(linked.join(least, "root").select("mark", "component_id"), "mark", "left").select("mark", "copies", F.coalesce("component_id", "first_id").alias("component_id")))
    return join_copies(marks.select("doc_id", "mark"), classes, "mark", marks.count()).select("doc_id", "mark", "component_id")


def keep_one_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its near copies, once each; all columns stay, whatever their names.

    Of several rows with one id, those whose own text is not a copy of a smaller id's count, and of
    these the first in order of text, then of the other columns, stays. Rows without an id
    cannot be told apart and stay. Null and empty texts are copies of each other; texts of any length are
    compared whole, one text's words at a time; an empty table gives an empty result.
    """
    taken = {c.lower() for c in docs.columns}
    name_id, name_mark, name_row = (next(n for k in range(len(taken) + 1) if (n := f"{base}{k}") not in taken) for base in ("copy_id_", "copy_mark_", "copy_row_"))
    known = docs.where(F.col(id_col).isNotNull())
    roots = staged(near_copy_roots(known, id_col, text_col))
    key = F.col(id_col).cast("long") == F.col(name_id)
    # small tables are written, so that Spark knows their sizes before it moves texts: it broadcasts them while they are small
    twice = staged(roots.groupBy(F.col("doc_id").alias(name_id)).agg(F.count("*").alias("n")).where("n > 1").select(name_id))
    gone = staged(roots.where("doc_id <> component_id").select(F.col("doc_id").alias(name_id)).unionByName(twice).distinct())
    kept = known.join(gone, key, "left_anti").unionByName(docs.where(F.col(id_col).isNull()))
    if twice.isEmpty():
        return kept
    # rows of one id are told apart by their texts
    mark = of_texts(lambda texts: [int(np.uint64(mark_of(words_of(t))).astype(np.int64)) for t in texts], "long", pa.int64())
    firsts = roots.where("doc_id = component_id").withColumnsRenamed({"doc_id": name_id, "mark": name_mark}).join(twice, name_id, "left_semi").select(name_id, F.col(name_mark).alias(name_row)).distinct()
    rows = staged(known.join(twice, key, "left_semi")).withColumn(name_mark, mark(F.col(text_col).cast("string")))
    rows = rows.join(firsts, key & (F.col(name_mark) == F.col(name_row)), "left_semi")
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    picked = rows.groupBy(F.col(id_col).alias(name_id)).agg(F.min_by(whole, F.struct(F.col(f"`{text_col}`"), *(F.col(f"`{c}`") for c in plain))).alias(name_row)).select(f"{name_row}.*")
    return kept.unionByName(picked)
