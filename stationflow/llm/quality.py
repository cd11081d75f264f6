"""Document quality by nearest-neighbour voting over latent-semantic vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import held_out, ids_and_text, per_row

#: Hashed byte trigrams, and pairs of byte classes, are the terms; beside them stand the
#: shares of a text in trigrams of each frequency, which repetition moves.
TRIGRAMS, CLASSES, FREQUENCIES = 4096, 32, 13
TERMS = TRIGRAMS + CLASSES * CLASSES
FACTORS = 48
NEIGHBOURS = 25
#: Labelled rows of each label that are broadcast: the bound of the learning sample.
ROWS_PER_LABEL = 600
CHUNK = 1 << 20
BLOCK = 256
#: Trigrams added to a text's size, so that few trigrams don't look like repeated ones.
SHORT = 200


def _byte_classes() -> np.ndarray:
    """A class for each byte: letters by case, digits, spaces, line ends, other signs by their low bits."""
    kind = np.empty(256, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            kind[b] = 0
        elif c.islower():
            kind[b] = 1
        elif c.isupper():
            kind[b] = 2
        elif c.isdigit():
            kind[b] = 3
        elif c in "\r\n":
            kind[b] = 4
        elif c.isspace():
            kind[b] = 5
        else:
            kind[b] = 6 + b % 26
    return kind


BYTE_CLASS = _byte_classes()


def term_counts(text: str | None) -> np.ndarray:
    """How often each term is in a whole text."""
    counts = np.zeros(TERMS, np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    for at in range(0, len(data), CHUNK):
        b = data[at : at + CHUNK + 2]  # the next chunk's first terms start in this one
        if len(b) > 2:
            w = b.astype(np.uint32)
            h = (w[:-2] * np.uint32(0x9E3779B1) + w[1:-1] * np.uint32(0x85EBCA6B) + w[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(20)
            counts[:TRIGRAMS] += np.bincount(h, minlength=TRIGRAMS)
        c = BYTE_CLASS[b[: CHUNK + 1]].astype(np.int32)
        if len(c) > 1:
            counts[TRIGRAMS:] += np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)
    return counts


#: Cosines that differ by less are ties.
TIE = 1e-6


@dataclass
class LatentVotes:
    """Term weights, the projection to latent factors, and the labelled rows there."""

    idf: np.ndarray
    project: np.ndarray  # weighted terms x factors
    rows: np.ndarray  # labelled rows x factors, of length one
    label: np.ndarray
    prior: float

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(weighted(counts, self.idf) @ self.project)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled rows, and those as near as the last of them, weighted by cosine."""
        z = self.vectors(counts)
        cosine = z @ self.rows.T
        k = min(NEIGHBOURS, len(self.label))
        least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
        weight = np.where(cosine >= least - TIE, np.maximum(cosine, 0), 0).astype(np.float64) ** 4
        total = weight.sum(1)
        vote = weight @ self.label / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, vote, self.prior), 0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted terms and frequency shares of each text, each part of length one."""
    share = counts[:, :TRIGRAMS] / (counts[:, :TRIGRAMS].sum(1, keepdims=True) + SHORT)
    row, term = np.nonzero(share)
    mass = share[row, term]
    octave = np.minimum(-np.log2(mass), FREQUENCIES - 1).astype(np.int64)
    spread = np.bincount(row * FREQUENCIES + octave, mass, len(counts) * FREQUENCIES).reshape(-1, FREQUENCIES)
    return np.concatenate([_unit(np.log1p(counts) * idf), np.sqrt(spread).astype(np.float32)], 1)


def fit_votes(counts: np.ndarray, label: np.ndarray, prior: float, factors: int = FACTORS) -> LatentVotes | None:
    """Latent factors of the labelled rows' weighted counts; None without rows of both labels or any."""
    if not len(label):
        return None
    idf = (np.log((1 + len(label)) / (1 + (counts > 0).sum(0))) + 0.1).astype(np.float32)
    x = weighted(counts, idf)
    values, vectors = np.linalg.eigh((x @ x.T).astype(np.float64))
    top = [k for k in np.argsort(-values)[:factors] if values[k] > 1e-9]
    project = (x.T @ (vectors[:, top] / np.sqrt(values[top]))).astype(np.float32)
    return LatentVotes(idf, project, _unit(x @ project), label.astype(np.float64), prior)


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_label: int = ROWS_PER_LABEL) -> LatentVotes | None:
    """The voters: ``per_label`` rows of each label at most, by a hash of the id, none held out.

    A document with several labels counts with the larger share of them (label 1 on a tie).
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    size = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}  # two rows
    if not size:
        return None
    picked = None
    for y in sorted(size):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        picked = part if picked is None else picked.unionByName(part)
    rows = ids_and_text(docs, id_col, text_col).join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))

    def run(ys: list, texts: list) -> tuple[list, ...]:
        return ys, [term_counts(t).astype("<f4").tobytes() for t in texts]

    got = per_row(rows.orderBy("doc_id").select("y", "text"), run, "y long, counts binary", pa.schema([("y", pa.int64()), ("counts", pa.binary())])).collect()
    counts = np.array([np.frombuffer(r["counts"], "<f4") for r in got]).reshape(-1, TERMS)
    return fit_votes(counts, np.array([r["y"] for r in got]), size.get(1, 0) / sum(size.values()))


def score_quality(docs: DataFrame, votes: LatentVotes | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``: how likely label 1 is, for every whole text.

    Null, empty and very short texts have no term and get the learned share of label 1
    (0.5 if nothing was labelled); repeated rows stay; other columns are left out; an
    empty table gives an empty result. Every text is compared with all labelled rows;
    rows that tie with the last of the nearest vote too.
    """

    def run(ids: list, texts: list) -> tuple[list, ...]:
        if votes is None:
            return ids, [0.5] * len(ids)
        parts = [votes.scores(np.stack([term_counts(t) for t in texts[at : at + BLOCK]])) for at in range(0, len(texts), BLOCK)]
        return ids, np.concatenate(parts) if parts else []

    return per_row(ids_and_text(docs, id_col, text_col), run, "doc_id long, score double", pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]))
