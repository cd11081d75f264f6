"""Language identification with a small byte convolutional network, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import held_out, ids_and_text, of_texts, per_row

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Learning rows for each language and windows for each row: the bound of the training sample.
DOCS_PER_LANG = 500
WINDOWS_PER_DOC = 3
EPOCHS = 8
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Windows that one step of inference holds.
AT_ONCE = 128


@dataclass
class ByteNet:
    """Byte embeddings, filters of several widths (as one matrix over the widest), pooling, softmax."""

    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # max width * EMBED x filters
    bias: np.ndarray
    out: np.ndarray  # filters x langs
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest response of each filter over a window's positions; with ``where``, also its position."""
        wide = max(WIDTHS)
        x = self.embed[np.pad(windows, ((0, 0), (0, wide - 1)))]
        n, length, _ = x.shape
        view = np.lib.stride_tricks.as_strided(x, (n, length - wide + 1, wide * EMBED), (x.strides[0], x.strides[1], x.strides[2]))
        reply = (np.ascontiguousarray(view).reshape(-1, wide * EMBED) @ self.filters).reshape(n, -1, self.filters.shape[1])
        return reply.max(1), reply.argmax(1) if where else None

    def proba(self, windows: np.ndarray) -> np.ndarray:
        """Language probabilities of every window of bytes."""
        parts = []
        for at in range(0, len(windows), AT_ONCE):
            pool, _ = self.pooled(windows[at : at + AT_ONCE])
            z = np.maximum(pool + self.bias, 0) @ self.out + self.out_bias
            e = np.exp(z - z.max(1, keepdims=True))
            parts.append(e / e.sum(1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.langs)), np.float32)


def windows_of(text: str) -> np.ndarray:
    """The lower-cased text's UTF-8 bytes as rows of WINDOW bytes, the last one padded with zeros."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    return np.pad(data, (0, -len(data) % WINDOW)).reshape(-1, WINDOW)


def sample_windows(docs: DataFrame, text_col: str, lang_col: str, id_col: str, per_lang: int) -> tuple[np.ndarray, list[str]]:
    """A bounded sample of learning windows: ``per_lang`` rows of each language, by a hash of the id."""
    learn = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    learn = learn.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return np.zeros((0, WINDOW), np.uint8), []
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_lang / n)).otherwise(share)
    order = F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5
    learn = learn.withColumn("h", order).where(F.col("h") < share).orderBy("h").limit(2 * per_lang * len(counts))

    def run(ids: list, texts: list) -> tuple[list, ...]:
        rng = np.random.default_rng(0)
        picks = []
        for text in texts:
            got = windows_of(text) if LETTER.search(text) else np.zeros((0, WINDOW), np.uint8)
            picks.append([got[k].tobytes() for k in rng.permutation(len(got))[:WINDOWS_PER_DOC]])
        return ids, picks

    # the language goes through in place of the id
    got = per_row(learn.select("lang", "text"), run, "lang string, w array<binary>", pa.schema([("lang", pa.string()), ("w", pa.list_(pa.binary()))])).collect()
    rows = [(r["lang"], w) for r in got for w in r["w"]]
    return np.array([np.frombuffer(bytes(w), np.uint8) for _, w in rows], np.uint8).reshape(-1, WINDOW), [lang for lang, _ in rows]


def train(windows: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 0) -> ByteNet | None:
    """Fit the network by Adam; windows are also shown cut short, as short texts look. None without rows."""
    names = sorted(set(langs))
    if not names:
        return None
    rng, wide, total = np.random.default_rng(seed), max(WIDTHS), FILTERS * len(WIDTHS)
    y = np.searchsorted(names, langs)
    mask = np.concatenate([np.repeat([[j < w * EMBED] for j in range(wide * EMBED)], FILTERS, 1) for w in WIDTHS], 1).astype(np.float32)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    net = ByteNet(names, draw(256, EMBED), draw(wide * EMBED, total) * mask, np.zeros(total, np.float32), draw(total, len(names)), np.zeros(len(names), np.float32))
    params = [net.embed, net.filters, net.bias, net.out, net.out_bias]
    moment, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = (len(y) / (len(names) * np.maximum(np.bincount(y, minlength=len(names)), 1)))[y].astype(np.float32)
    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            x = windows[at].copy()
            short = rng.random(len(at)) < 0.3
            x[short] *= np.arange(WINDOW) < rng.integers(8, WINDOW, len(at))[short, None]
            pool, best = net.pooled(x, where=True)
            act = np.maximum(pool + net.bias, 0)
            z = act @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(at)), y[at]] -= 1
            dz = p * weight[at, None] / len(at)
            dact = (dz @ net.out.T) * (act > 0)
            spots = np.pad(x, ((0, 0), (0, wide - 1)))[np.arange(len(at))[:, None, None], best[:, :, None] + np.arange(wide)]  # the bytes under each filter's best reply
            patch = net.embed[spots].reshape(len(at), total, wide * EMBED)
            dpatch = (dact[:, :, None] * net.filters.T).reshape(-1, EMBED)
            dembed = np.stack([np.bincount(spots.ravel(), dpatch[:, k], 256) for k in range(EMBED)], 1)
            grads = [dembed, np.einsum("nf,nfk->kf", dact, patch) * mask, dact.sum(0), act.T @ dz, dz.sum(0)]
            step += 1
            rate = 0.01 * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for q, g, m, v in zip(params, grads, moment, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def predict(net: ByteNet | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and its mean probability over all windows of each text, weighted by their bytes."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    pending: list[tuple[int, np.ndarray]] = []

    def settle() -> None:
        if not pending:
            return
        windows = np.concatenate([w for _, w in pending])
        weight = (windows != 0).sum(1)
        p = net.proba(windows) * weight[:, None]
        ends = np.cumsum([len(w) for _, w in pending])
        starts = np.concatenate([[0], ends[:-1]])
        total, bytes_in = np.add.reduceat(p, starts), np.maximum(np.add.reduceat(weight, starts), 1)
        for (i, _), row, n in zip(pending, total, bytes_in, strict=True):
            k = int(row.argmax())
            langs[i], scores[i] = net.langs[k], float(min(1.0, row[k] / n))
        pending.clear()

    held = 0
    for i, text in enumerate(texts):
        if net is not None and text and LETTER.search(text):
            pending.append((i, windows_of(text)))
            held += len(pending[-1][1])
            if held >= 4096:
                settle()
                held = 0
    settle()
    return langs, scores


def fit_language_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_lang: int = DOCS_PER_LANG) -> ByteNet | None:
    """The network fitted on a bounded sample of the labelled rows that aren't held out."""
    return train(*sample_windows(docs, text_col, lang_col, id_col, per_lang))


def identify_language(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every whole text.

    Null texts, and texts without a letter, are ``und`` with score 0, as is everything
    if no row was labelled. Repeated rows stay; a null id stays null; other columns are
    left out; an empty table gives an empty result. Texts of any length are read whole, in
    windows of WINDOW bytes.
    """

    def run(ids: list, texts: list) -> tuple[list, ...]:
        return ids, *predict(net, texts)

    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    return per_row(ids_and_text(docs, id_col, text_col), run, "doc_id long, lang_pred string, score double", schema)


def keep_identified(docs: DataFrame, net: ByteNet | None, least_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose language the network names with ``least_score`` or more."""

    def sure(texts: list) -> list:
        return [s if lang != UNKNOWN else -1.0 for lang, s in zip(*predict(net, texts), strict=True)]

    return docs.where(of_texts(sure, "double", pa.float64())(F.col(text_col).cast("string")) >= least_score)
