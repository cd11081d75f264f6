"""Repeated strings against brute force, through the registered query and under small sizes."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.llm import queries, suffix_arrays, suffix_dedup

BIG = (1 << 63) - 1


def brute(rows, length=50):
    """For each row: removed runs and kept bytes."""
    first, nulls = {}, set()
    for doc, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            s = data[k : k + length]
            if doc is None:
                nulls.add(s)
            else:
                first[s] = min(first.get(s, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            low = first.get(data[k : k + length])
            if low is not None and (doc is None or low < doc):
                gone[k : k + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc, len(data), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def made(seed, n):
    """Texts that share passages, lines and headers, and odd ones."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefgh é日"), rng.integers(2, 9))) for _ in range(40)]
    prose = lambda k: " ".join(rng.choice(words, k))
    shared = [prose(20) for _ in range(4)]
    header = "Content-Type: x; "  # one common gram before different texts
    texts = []
    for k in range(n):
        parts = [prose(rng.integers(1, 30)) for _ in range(3)]
        parts.insert(int(rng.integers(0, 3)), str(rng.choice(shared)))
        texts.append((header if k % 3 == 0 else "") + " ".join(parts))
    return texts


@pytest.fixture(scope="module")
def documents():
    texts = made(3, 40)
    odd = [(1 << 60) + 1, (1 << 60) + 2, BIG, None, None, -(1 << 63), BIG - 1]
    rows = list(enumerate(texts)) + [(d, texts[0]) for d in odd] + [(None, texts[5] + "x" * 60), (7, texts[7]), (7, texts[7]), (90, None), (91, ""), (92, "a" * 49), (93, "a" * 300), (94, "a" * 120), (95, "日本" * 40), (96, "本日" * 40)]
    return rows


def written(spark, rows, path):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    table = table.withColumns({"tile": F.lit("t"), "none": F.lit(1), "data": F.lit(2), "shard": F.lit(None).cast("string"), "spans": F.lit(0)})
    table.write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.mark.parametrize("sizes", [{}, {"TILE_BYTES": 700, "BUCKET_BYTES": 900, "SHARD_BYTES": 600, "CHUNK": 300}])
def test_query_against_brute_force(spark, documents, tmp_path, monkeypatch, sizes):
    for name, size in sizes.items():
        monkeypatch.setattr(suffix_dedup, name, size)
    got = queries.op7_suffix_dedup(spark, written(spark, documents, tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(documents)


def test_hot_routes_change_nothing(spark, documents, monkeypatch):
    for name, size in {"TILE_BYTES": 700, "BUCKET_BYTES": 900, "SHARD_BYTES": 600}.items():
        monkeypatch.setattr(suffix_dedup, name, size)
    table = spark.createDataFrame(documents, "doc_id long, text string")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    for hot in (0, 200):
        got = suffix_dedup.remove_repeats(table, hot_bytes=hot).select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256))
        assert sorted(map(tuple, got.collect()), key=repr) == brute(documents)


@pytest.mark.parametrize("parts", [1 << 15, 2])
def test_equal_rows_are_spread(spark, monkeypatch, parts):
    """Rows that are equal, with and without an id, come out as often as they came in, and from several tiles."""
    for name, size in {"TILE_BYTES": 4000, "BUCKET_BYTES": 3000, "SHARD_BYTES": 2000, "PARTS": parts}.items():
        monkeypatch.setattr(suffix_dedup, name, size)
    texts = made(11, 12)
    rows = list(enumerate(texts)) + [(None, texts[3] + "tail")] * 300 + [(20, texts[4])] * 157 + [(21, "")] * 50 + [(None, None)] * 5000 + [(None, texts[3])] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string")
    dealt, size = suffix_dedup._dealt(table.select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), F.col("doc_id").isNull().alias("none"), F.coalesce("text", F.lit("")).cast("binary").alias("data")))
    assert size == sum(len((t or "").encode()) for _, t in rows)
    assert dealt.agg(F.sum("copies")).first()[0] == len(rows)
    held = dealt.where(F.col("none") & (F.octet_length("data") > 0)).groupBy("tile").agg(F.sum("copies").alias("n"), F.count("*").alias("rows")).collect()
    assert len(held) > 8 and sum(r["n"] for r in held) == 302 and sum(r["rows"] for r in held) < 150
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    got = suffix_dedup.remove_repeats(table).select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_long_texts_and_empty_table(spark, tmp_path):
    rng = np.random.default_rng(5)
    long = rng.bytes(700_000).hex()  # over 1 MiB, so over the seam of a chunk
    rows = [(1, long), (2, "b" + long[1_048_500:1_048_700] + "c"), (3, " " * 1_200_000), (4, long)]
    got = {r.doc_id: r for r in queries.op7_suffix_dedup(spark, written(spark, rows, tmp_path / "a")).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[3].n_removed, got[4].n_removed) == (0, 200, 0, len(long))
    assert queries.op7_suffix_dedup(spark, written(spark, [], tmp_path / "b")).count() == 0


@pytest.mark.parametrize("mean", [0, 1 << 40])
def test_both_forms_of_inducing(monkeypatch, mean):
    monkeypatch.setattr(suffix_arrays, "BUCKET_MEAN", mean)
    monkeypatch.setattr(suffix_arrays, "SIGN_BY_SIGN", 2)
    monkeypatch.setattr(suffix_arrays, "WAVES", 2)
    rng = np.random.default_rng(0)
    for _ in range(150):
        t = np.append(np.repeat(rng.integers(1, 5, 12), rng.integers(1, 6, 12)), 0).astype(np.uint8)
        b = t.tobytes()
        assert suffix_arrays.suffix_array(t, 5, len(b)).tolist() == sorted(range(len(b)), key=lambda i: b[i:])


def test_only_blocks_that_share_their_route_are_sorted(monkeypatch):
    """Strings' smallest ids are those of one suffix array over all blocks, though blocks alone on their route stay out of it."""
    rng = np.random.default_rng(8)
    texts = [rng.integers(97, 101, 3000).astype(np.uint8).tobytes() for _ in range(6)]
    texts += [texts[0][:1500] + texts[1][700:], texts[2][5:900] + b"x" + texts[2][900:], b"a" * 400, b"ab" * 200]
    cut = [(d, texts[d][a : b + 50]) for d, a, b in zip(*(x.tolist() for x in suffix_dedup.route_runs(texts, 50)[:3]), strict=True)]
    blocks = sorted({b for _, b in cut})
    low = np.array([min(d for d, x in cut if x == b) for b in blocks])
    real = low % 3 > 0
    want = suffix_dedup.earliest(blocks, low, real, 50)
    sorted_bytes, whole = [], suffix_dedup.earliest
    monkeypatch.setattr(suffix_dedup, "earliest", lambda some, *rest: sorted_bytes.append(sum(map(len, some))) or whole(some, *rest))
    got = suffix_dedup.earliest_by_route(blocks, low, real, 50)
    assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])
    assert 0 < sum(sorted_bytes) < sum(map(len, blocks)) / 2


def some_blocks():
    rng = np.random.default_rng(9)
    texts = [rng.integers(97, 101, 3000).astype(np.uint8).tobytes() for _ in range(5)]
    texts += [texts[0][:1500] + texts[1][700:], texts[2][5:900] + b"x" + texts[2][900:], texts[1][30:60] + texts[3][100:2000], b"a" * 400]
    cut = [(d, texts[d][a : b + 50]) for d, a, b in zip(*(x.tolist() for x in suffix_dedup.route_runs(texts, 50)[:3]), strict=True)]
    blocks = sorted({b for _, b in cut})
    return blocks, np.array([min(d for d, x in cut if x == b) for b in blocks])


def test_several_suffix_arrays_give_what_one_gives(monkeypatch):
    blocks, low = some_blocks()
    want = suffix_dedup.earliest(blocks, low, low % 3 > 0, 50)
    calls, whole = [], suffix_dedup.earliest
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 200)
    monkeypatch.setattr(suffix_dedup, "earliest", lambda some, *rest: calls.append(len(some)) or whole(some, *rest))
    got = suffix_dedup.earliest_by_route(blocks, low, low % 3 > 0, 50)
    assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1]) and len(calls) > 3


def a_tile(rows):
    return suffix_dedup.Tile(pd.DataFrame(rows, columns=["doc_id", "data"]).assign(none=False, copies=1))


def test_a_short_phrase_shares_no_route():
    """Texts that have 16 bytes in common over and over, but no string, stay in their tile."""
    rng = np.random.default_rng(10)
    rows = [(k, b" as of this day ".join(rng.bytes(40) for _ in range(30))) for k in range(6)]
    assert not len(suffix_dedup._shared_routes(suffix_dedup._tile_routes(0, a_tile(rows), 1, 50), 1 << 20)["shared"][0])


def test_a_text_is_taken_once(spark, monkeypatch):
    """Rows of one text come to one tile, or to several if they would crowd it, and are as if each had been searched."""
    texts = made(12, 9)
    tile = a_tile([(k, t.encode()) for k in range(4) for t in texts[:1]])
    doc, *_ = suffix_dedup._shared_runs(tile.texts, np.zeros(0, np.uint64), np.zeros(0, bool), 50)
    routes = suffix_dedup._tile_routes(0, tile, 1, 50)
    assert not len(suffix_dedup._shared_routes(routes, 1 << 20)["shared"][0]) and not len(doc)
    rows = [(k * 20 + j, t) for j, t in enumerate(texts) for k in range(4)] + [(None, t) for t in texts[:4]] * 2 + [(500 + k, texts[1]) for k in range(120)] + [(500, texts[1]), (-3, texts[8]), (600, "a" * 49), (601, "a" * 49)]
    for name, size in {"TILE_BYTES": 6000, "BUCKET_BYTES": 3000, "SHARD_BYTES": 2000}.items():
        monkeypatch.setattr(suffix_dedup, name, size)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    dealt, _ = suffix_dedup._dealt(table.select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), F.col("doc_id").isNull().alias("none"), F.col("text").cast("binary").alias("data")))
    tiles = {bytes(r["data"]).decode(): r["tiles"] for r in dealt.groupBy("data").agg(F.count_distinct("tile").alias("tiles")).collect()}
    assert tiles["a" * 49] == 1 and tiles[texts[1]] > 3
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    got = suffix_dedup.remove_repeats(table).select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_blocks_of_one_hash_stay_apart(monkeypatch):
    """Blocks are the same only if their bytes are, also if they are long."""
    monkeypatch.setattr(suffix_dedup, "_digests", lambda words, data, at, size, mark: np.zeros(len(at), np.uint64))
    rng = np.random.default_rng(13)
    rows = [(k, t.encode()) for k, t in enumerate(made(14, 12))] + [(20, b"a" * 500), (21, b"b" + b"a" * 500), (22, b"a" * 499 + b"b"), (23, rng.bytes(300)), (24, b"a" * 600)]
    tile = a_tile(rows)
    shared = np.unique(suffix_dedup.route_runs(tile.texts, 50)[3])
    b = suffix_dedup.TileBlocks(tile, (shared, np.zeros(len(shared), bool)), 3, 50)
    doc, first, last, _, _ = suffix_dedup.route_runs(tile.texts, 50)
    for of, d, x, y in zip(b.of.tolist(), doc.tolist(), first.tolist(), last.tolist(), strict=True):
        assert b.data[b.at[of] : b.at[of] + b.size[of]] == tile.texts[d][x : y + 50]


@pytest.mark.parametrize("length", [16, 19, 20, 33])
def test_other_lengths(spark, documents, length):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    got = suffix_dedup.remove_repeats(spark.createDataFrame(documents, "doc_id long, text string"), length=length)
    got = got.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(documents, length)
