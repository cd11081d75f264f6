"""Approximate nearest neighbours over sharded, robust-pruned directed graphs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.llm.common import join_copies, staged

DEGREE, BEAM, SEARCH_BEAM, ALPHA, SLACK = 32, 48, 128, 1.2, 2
#: Distinct vectors of one shard.
SHARD_ROWS = 12_288
AT_ONCE = 256


@dataclass
class Graph:
    """Unit vectors, each node's out-edges (-1: none) and a last row without any, and the node where searches start."""

    x: np.ndarray
    edges: np.ndarray
    entry: int

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of each query's final beam, nearest first (-1: none), and all nodes it expanded.

        All queries advance together: each expands its nearest unexpanded node, and the
        best ``beam`` of old and new nodes stay.
        """
        n, b = len(self.x), len(queries)
        rows = np.arange(b)
        ids = np.full((b, beam), -1, np.int64)
        far = np.full((b, beam), np.inf, np.float32)
        fresh = np.zeros((b, beam), bool)
        seen = np.zeros((b, n + 1), bool)
        seen[:, n] = True  # where missing edges point
        ids[:, 0], far[:, 0], fresh[:, 0] = self.entry, -(queries @ self.x[self.entry]), True
        seen[:, self.entry] = True
        last_ids, last_far, expanded = ids.copy(), far.copy(), []
        while len(rows):
            going = fresh.any(1)
            if 2 * going.sum() <= len(rows):  # finished queries step aside
                last_ids[rows], last_far[rows] = ids, far
                rows, ids, far, fresh, seen, queries = (a[going] for a in (rows, ids, far, fresh, seen, queries))
                continue
            line = np.arange(len(rows))
            at = np.where(fresh, far, np.inf).argmin(1)
            node = np.where(going, ids[line, at], -1)
            fresh[line, at] = False
            expanded.append(np.full(b, -1, np.int64))
            expanded[-1][rows] = node
            near = self.edges.take(node, 0, mode="wrap")  # the last row has no edges
            here = (near + (near < 0) * (n + 1) + line[:, None] * (n + 1)).ravel()
            flat = seen.reshape(-1)
            new = np.flatnonzero(~flat.take(here))
            flat[here[new]] = True
            row, node = new // near.shape[1], near.ravel().take(new)
            gap = -np.einsum("ij,ij->i", self.x.take(node, 0), queries.take(row, 0))
            # only nodes nearer than the beam's last can enter it
            enter = gap < far.max(1)[row]
            row, node, gap = row[enter], node[enter], gap[enter]
            if not len(row):
                continue
            count = np.bincount(row, minlength=len(rows))
            col = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            shape = (len(rows), int(count.max()))
            more, more_far, more_fresh = np.full(shape, -1, np.int64), np.full(shape, np.inf, np.float32), np.zeros(shape, bool)
            more[row, col], more_far[row, col], more_fresh[row, col] = node, gap, True
            ids, far, fresh = np.concatenate([ids, more], 1), np.concatenate([far, more_far], 1), np.concatenate([fresh, more_fresh], 1)
            best = np.argpartition(far, beam - 1, axis=1)[:, :beam]
            ids, far, fresh = (np.take_along_axis(a, best, 1) for a in (ids, far, fresh))
        order = np.argsort(last_far, axis=1, kind="stable")
        return np.take_along_axis(last_ids, order, 1), np.stack(expanded, 1)


def robust_prune(x: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-edges of each node of ``own``: nearest candidates (-1: none), each dropping those it is ``alpha`` nearer to."""
    b, m = candidates.shape
    line = np.arange(b)
    y = x[candidates]
    gap = 2 - 2 * np.matmul(y, x[own][:, :, None])[:, :, 0]
    gap[(candidates < 0) | (candidates == own[:, None])] = np.inf
    between = 2 - 2 * np.matmul(y, y.transpose(0, 2, 1))
    out = np.full((b, degree), -1, np.int64)
    for k in range(min(degree, m)):
        at = gap.argmin(1)
        live = np.isfinite(gap[line, at])
        if not live.any():
            break
        out[live, k] = candidates[line, at][live]
        gap[alpha * alpha * between[line, at] <= gap] = np.inf
        gap[line, at] = np.inf
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 0) -> Graph:
    """Insert nodes in random order, in batches that double: each searches the graph so far and prunes what it saw.

    Edges back may pile up to SLACK times the degree before a node is pruned, and are pruned to the degree in the end.
    """
    x = unit(vectors).astype(np.float32)
    n = len(x)
    graph = Graph(x, np.full((n + 1, SLACK * degree), -1, np.int64), int((x @ x.mean(0)).argmax()))
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != graph.entry]
    done = 0
    while done < len(order):
        batch = order[done : done + max(1, min(done + 1, AT_ONCE))]
        done += len(batch)
        pool = graph.search(x[batch], beam)[1]  # which ends with the whole beam expanded
        edges = robust_prune(x, batch, pool, degree, alpha)
        graph.edges[batch, :degree] = edges
        _link_back(graph, batch, edges, degree, alpha)
    full = np.flatnonzero((graph.edges[:n] >= 0).sum(1) > degree)
    for c in range(0, len(full), AT_ONCE):
        own = full[c : c + AT_ONCE]
        graph.edges[own, :degree] = robust_prune(x, own, graph.edges[own], degree, alpha)
    return Graph(x, graph.edges[:, :degree].copy(), graph.entry)


def _link_back(graph: Graph, batch: np.ndarray, edges: np.ndarray, degree: int, alpha: float) -> None:
    """Give each edge's target an edge back, pruning targets that then have more than there is room for."""
    source, target = np.repeat(batch, degree), edges.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    rank, room = np.arange(len(target)) - np.repeat(first, count), graph.edges.shape[1]
    for start in range(0, int(count.max(initial=0)), degree):  # many edges to one node come in parts
        here = (rank >= start) & (rank < start + degree)
        some = np.flatnonzero(count > start)
        more = np.full((len(some), degree), -1, np.int64)
        more[np.searchsorted(nodes[some], target[here]), rank[here] - start] = source[here]
        for c in range(0, len(some), AT_ONCE):
            own = nodes[some[c : c + AT_ONCE]]
            pool = np.concatenate([graph.edges[own], more[c : c + AT_ONCE]], 1)
            full = (pool >= 0).sum(1) > room
            graph.edges[own[~full]] = -np.sort(-pool[~full], 1)[:, :room]
            if full.any():
                graph.edges[own[full]] = -1
                graph.edges[own[full], :degree] = robust_prune(graph.x, own[full], pool[full], degree, alpha)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, in double precision."""
    v = np.asarray(vectors, np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to about one: exact, so that squares neither vanish nor overflow."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(-1, keepdims=True))[1])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, in double precision; rows of any size."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(-1) / (np.sqrt((a * a).sum(-1)) * np.sqrt((b * b).sum(-1)))


def sound_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v``: one row for each id; vectors null, empty, zero, or with null or non-finite components are left out.

    Of an id's several vectors, the smallest in array order counts.
    """
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(fine)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def build_index(vectors: DataFrame, keep: int, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """The index as a staged table: ``dim, shard, place, rep, members, v, edges``, one row for each distinct vector.

    Equal vectors are indexed once, under their smallest id ``rep``; ``members`` holds
    their ``keep`` smallest ids, all that ties to smaller ids can ever return. Shards
    are dealt by a hash and hold about ``shard_rows`` vectors of one dimension.
    """
    near = vectors.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("nth") <= keep)
    reps = staged(near.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members")).withColumns({"rep": F.col("members")[0], "dim": F.size("v")}))
    counts = reps.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))  # a row for each dimension
    dealt = reps.join(F.broadcast(counts), "dim").withColumn("shard", F.pmod(F.xxhash64("rep"), "shards").cast("int"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", ignore_index=True)
        graph = build_graph(np.stack(rows["v"]), degree, beam, alpha)
        rows["place"] = np.arange(len(rows), dtype="int32")
        rows["entry"] = graph.entry
        rows["edges"] = [e[e >= 0].astype("int32") for e in graph.edges[: len(rows)]]
        return rows[["dim", "shard", "shards", "place", "entry", "rep", "members", "v", "edges"]]

    schema = "dim int, shard int, shards int, place int, entry int, rep long, members array<long>, v array<double>, edges array<int>"
    return staged(dealt.groupBy("dim", "shard").applyInPandas(build, schema))


def _vectors(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Shard:
    """A shard's graph as its rows come in, and what searches of it find."""

    def __init__(self) -> None:
        self.parts: list[pa.RecordBatch] = []
        self.graph: Graph | None = None

    def ready(self) -> None:
        if self.graph is None and self.parts:
            rows = pa.Table.from_batches(self.parts).combine_chunks()
            self.v, self.members, edges = _vectors(rows["v"].chunk(0)), rows["members"].to_pylist(), rows["edges"].to_pylist()
            padded = np.full((len(edges) + 1, max(1, max(map(len, edges)))), -1, np.int64)
            for k, e in enumerate(edges):
                padded[k, : len(e)] = e
            self.graph = Graph(unit(self.v).astype(np.float32), padded, rows["entry"][0].as_py())
            self.parts = []

    def search(self, reps: list[int], queries: np.ndarray, keep: int, beam: int) -> pa.RecordBatch:
        found: tuple[list, list, list] = ([], [], [])
        self.ready()
        for at in range(0, len(queries) if self.graph else 0, AT_ONCE):
            part = queries[at : at + AT_ONCE]
            for k, ids in enumerate(self.graph.search(unit(part).astype(np.float32), beam)[0]):
                ids = ids[ids >= 0]
                scores = cosine(part[k][None], self.v[ids])
                best = sorted((-s, m) for i, s in zip(ids.tolist(), scores.tolist(), strict=True) for m in self.members[i])[:keep]
                found[0].extend([reps[at + k]] * len(best))
                found[1].extend(m for _, m in best)
                found[2].extend(-s for s, _ in best)
        return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], ["rep", "vec_id", "score"])


def search_index(index: DataFrame, queries: DataFrame, keep: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """``rep, vec_id, score``: for each query vector, the ``keep`` best ids of every shard of its dimension.

    ``queries`` holds distinct vectors as ``rep, v``. A shard's rows come once, before the
    queries, which stream past its graph; only the graph is held. Scores are exact cosines
    of the original vectors.
    """
    shards = index.groupBy(F.col("dim").alias("d")).agg(F.max("shards").alias("shards"))  # a row for each dimension
    asked = queries.join(F.broadcast(shards), F.size("v") == F.col("d"))
    null = lambda kind: F.lit(None).cast(kind)
    left = index.select("dim", "shard", F.lit(0).alias("kind"), F.col("place").cast("long").alias("place"), "entry", "members", "v", "edges")
    right = asked.select(F.col("d").alias("dim"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("kind"), F.col("rep").alias("place"), null("int").alias("entry"), null("array<long>").alias("members"), "v", null("array<int>").alias("edges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, Shard()
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])) if len(keys) else []
            for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
                part = batch.slice(a, b - a)
                if now != (own := tuple(keys[a, :2])):
                    now, shard = own, Shard()
                if keys[a, 2] == 0:
                    shard.parts.append(part)
                else:
                    yield shard.search(part.column("place").to_pylist(), _vectors(part.column("v")), keep, beam)

    rows = left.unionByName(right).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind", "place")
    return rows.mapInArrow(run, "rep long, vec_id long, score double")


def nearest(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row that ``is_query`` picks by ``vec_id``.

    Nearest means largest cosine in double precision, ties to the smaller id; a row is
    no candidate of its own. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows without an id; vectors of other dimensions
    are no candidates; repeated ids count once; other columns are left out; empty tables
    give an empty result.
    """
    vectors = staged(sound_vectors(df, id_col, vector_col))
    keep = k + 1  # one more, as a query's own row may be among them
    index = build_index(vectors, keep)
    total = vectors.count()
    reps = staged(vectors.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    mine = staged(join_copies(vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "v"), reps, "v", total).select("query_id", "rep", "copies"))
    asked = reps.join(mine.select("rep").distinct(), "rep", "left_semi").select("rep", "v")
    found = search_index(index, asked, keep, beam)
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)
    lists = top.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near"))
    lists = staged(lists.join(reps.select("rep", "copies"), "rep"))
    rest = join_copies(mine.select("query_id", "rep"), lists, "rep", total).select("query_id", F.slice(F.filter("near", lambda n: n["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return rest.select("query_id", F.posexplode("near").alias("pos", "n")).select("query_id", (F.col("pos") + 1).alias("rank"), "n.vec_id", "n.score")
