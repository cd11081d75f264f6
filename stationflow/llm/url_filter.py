"""Urls judged by host and path rules that are kept in cascades of Bloom filters."""

from __future__ import annotations

import math
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import staged

BLOCK, ALLOW = "block", "allow"
#: Hash functions of the levels over the first: of 16 keys that a level doesn't hold one passes.
LATER_HASHES = 4
#: Filter bytes of the first levels that one pass may send to the executors; longer lists are taken in several passes.
PASS_BYTES = 64 << 20
#: Judged keys that a task remembers at a time.
REMEMBERED = 100_000
#: Seed of the hash and bits of one bitmap, both fixed by Spark's functions.
SPARK_SEED, BITMAP_BITS = 42, 32768
_HEAD = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SCHEMA = "page_id long, host string, path string, rule string, verdict string"
ARROW = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])
KEY_ARROW = pa.schema([("verdict", pa.string()), ("key", pa.string())])

Shape = tuple[int, int]


def lower_ascii(col: Column) -> Column:
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, _HEAD, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, _HEAD, 2), F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter; its bits are a power of two in number."""

    bits: bytes
    seeds: tuple[int, ...]

    def holds(self, key: bytes) -> bool:
        last = 8 * len(self.bits) - 1
        for seed in self.seeds:
            at = xxhash.xxh64_intdigest(key, seed) & last
            if not self.bits[at >> 3] >> (at & 7) & 1:
                return False
        return True


def is_listed(levels: list[Level], key: bytes) -> bool:
    """Levels hold listed keys and their false positives by turns; the first that doesn't hold the key decides."""
    for k, level in enumerate(levels):
        if not level.holds(key):
            return k % 2 == 1
    return len(levels) % 2 == 1


def candidate_keys(host: str, path: str, shapes: Iterable[Shape]) -> Iterator[str]:
    """Every ending of the host with every beginning of the path, of those sizes that rules have; in the order of ``shapes``."""
    labels = host.split(".")
    for n, chars in shapes:
        if n <= len(labels) and chars <= len(path):
            yield ".".join(labels[-n:]) + path[:chars]


def _bits(n: int, hashes: int) -> int:
    return 1 << max(3, math.ceil(math.log2(max(1, n) * hashes / math.log(2))))


def build_level(keys: DataFrame, n: int, hashes: int, number: int) -> Level:
    """The filter of ``n`` keys (column ``key``): bitmaps that Spark builds by parts, over positions by its own hash."""
    size = _bits(n, hashes)
    turns = [64 * number + k for k in range(hashes)]
    places = keys.select(F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(t), "key"), F.lit(size)) + 1 for t in turns])).alias("at"))
    parts = places.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bits = bytearray(max(size, BITMAP_BITS) // 8)
    for row in parts.collect():  # the filter itself, bounded by PASS_BYTES
        at = (row["part"] - 1) * BITMAP_BITS // 8
        bits[at : at + BITMAP_BITS // 8] = row["bits"]
    return Level(bytes(bits[: size // 8]), tuple(xxhash.xxh64_intdigest(t.to_bytes(4, "little"), SPARK_SEED) for t in turns))


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    """The keys that a level holds."""
    held = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [k for k in batch.column(0).to_pylist() if held.value.holds(k.encode())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["key"])

    return keys.mapInArrow(run, "key string")


def _universe_hits(urls: DataFrame, shapes: list[Shape], firsts: dict[str, Level]) -> DataFrame:
    """``verdict, key``, each once: the candidate keys of all urls that a first level holds."""
    sent = urls.sparkSession.sparkContext.broadcast(firsts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[str, str]] = set()
        for batch in batches:
            keys = {k for h, p in set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)) if h for k in candidate_keys(h, p, shapes)}
            new = {(verdict, k) for k in keys for verdict, level in sent.value.items() if level.holds(k.encode())} - told
            told = told | new if len(told) < REMEMBERED else new
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in new], pa.string()) for c in (0, 1)], schema=KEY_ARROW)

    return urls.select("host", "path").mapInArrow(run, "verdict string, key string").distinct()


def build_cascades(urls: DataFrame, rules: DataFrame, shapes: list[Shape], universe: int) -> dict[str, list[Level]]:
    """The cascade of each verdict: exact for the rules' keys and for every candidate key of ``urls`` (``host, path``).

    The first level holds the listed keys, so sparsely that about as many others of the
    ``universe`` pass; the next holds those that pass though they aren't listed, the next the
    listed keys that it takes for such, and so on until none is left. Only keys that pass a level leave their task.
    """
    keys = {v: rules.where(F.col("verdict") == v).select("key").distinct() for v in (BLOCK, ALLOW)}
    sizes = {v: df.count() for v, df in keys.items()}
    cascades = {v: [build_level(keys[v], n, min(40, max(1, math.ceil(math.log2(max(2, universe) / n)))), 0)] for v, n in sizes.items() if n}
    if not cascades:
        return {}
    hits = staged(_universe_hits(urls, shapes, {v: levels[0] for v, levels in cascades.items()}))
    for v, levels in cascades.items():
        wrong, right = staged(hits.where(F.col("verdict") == v).select("key").join(keys[v], "key", "left_anti")), keys[v]
        while n := wrong.count():
            levels.append(build_level(wrong, n, LATER_HASHES, len(levels)))
            wrong, right = staged(_passing(right, levels[-1])), wrong
    return cascades


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    ``rules`` has ``host, path, verdict`` (``block`` or ``allow``). A rule fits its host and all
    subdomains, where the url's path starts with the rule's. Of those that fit, the longest text of host and path wins, then
    the longer host; if one host and path is listed for both verdicts, ``block`` wins. Without a rule the
    verdict is ``default``. Rules without a host, and those whose path begins
    with another sign than ``/``, fit nothing; a null path is empty; other verdicts and repeats are left out.

    Membership is read off cascades of Bloom filters, so pages are never joined with rules; a cascade is exact
    for all candidate keys of the table, from which its levels are built. A list whose filters exceed
    ``pass_bytes`` is dealt by a hash of its keys and taken in several passes.

    A null url, and one without ``://``, has an empty host and path and no rule; so has an empty one. Urls of
    any length are taken whole; repeated rows and rows without an id stay, one result row each; other
    columns are left out; an empty table gives an empty result, an empty list the default for all.
    """
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    found = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    rules = rules.select(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rules = rules.where((F.col("host") != "") & ~F.col("host").rlike("[/?#]") & F.col("path").rlike("^(/|$)") & F.col("verdict").isin(BLOCK, ALLOW))
    rules = rules.select(F.concat("host", "path").alias("key"), "verdict", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")).distinct()
    # one row for each pair of a number of labels and a length
    shapes = [(r["labels"], r["chars"]) for r in rules.select("labels", "chars").distinct().collect()]
    listed, universe = rules.count(), found.count() * len(shapes)
    passes = -(-_bits(listed, max(1, math.ceil(math.log2(max(2, universe) / listed)))) // (8 * pass_bytes)) if listed else 0
    for k in range(passes):
        part = rules.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == k)
        cascades = build_cascades(found, part, shapes, universe)
        if cascades:
            found = _judged(found, cascades, shapes)
            found = staged(found) if k + 1 < passes else found  # so that an executor holds one part at a time
    return found


def _judged(found: DataFrame, cascades: dict[str, list[Level]], shapes: list[Shape]) -> DataFrame:
    """Rows with the best rule of the cascades, or with the one they had if that is better."""
    sent = found.sparkSession.sparkContext.broadcast(cascades)
    deep, long = max(n for n, _ in shapes), max(n for _, n in shapes)

    def best(host: str, path: str) -> tuple[str, str] | None:
        for key in sorted(candidate_keys(host, path, shapes), key=rank, reverse=True):
            for verdict in (BLOCK, ALLOW):
                if verdict in sent.value and is_listed(sent.value[verdict], key.encode()):
                    return key, verdict
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], tuple[str, str] | None] = {}
        for batch in batches:
            ids, hosts, paths, rules, verdicts = (c.to_pylist() for c in batch.columns)
            for k, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                at = (".".join(host.rsplit(".", deep)[-deep:]) if host.count(".") >= deep else host, path[:long])
                if at not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[at] = best(*at) if host else None
                if (got := known[at]) and (rules[k] is None or rank(got[0]) > rank(rules[k])):
                    rules[k], verdicts[k] = got
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, hosts, paths, rules, verdicts), ARROW, strict=True)], schema=ARROW)

    return found.mapInArrow(run, SCHEMA)


def rank(rule: str) -> tuple[int, int]:
    """The longest rule is best, of these the one with the longest host."""
    return len(rule), len(rule.partition("/")[0])
