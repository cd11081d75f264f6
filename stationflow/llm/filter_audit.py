"""Audit of filters that are applied in any order: what each order removes, by counting paths through the lattice of filter sets."""

from __future__ import annotations

import string
from dataclasses import dataclass
from itertools import permutations
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import staged

#: Orders grow with the factorial of the filters.
MOST_FILTERS = 8
LEAST_WORDS, DISTINCT_PCT, CAPITALS_PCT = 50, 65, 5
_BLANKS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Edge:
    """The step that applies filter ``bit`` in the state where those of ``state`` have been applied."""

    state: int
    bit: int
    paths: int


def lattice(n: int) -> list[Edge]:
    """All steps between sets of ``n`` filters, with the number of orders that take each.

    The orders that reach a state are summed forward from the empty set, those that leave it backward from the full one;
    a step is part of as many orders as reach its start times as leave its end.
    """
    states = sorted(range(1 << n), key=int.bit_count)
    reach, leave = {0: 1}, {(1 << n) - 1: 1}
    for s in states[1:]:
        reach[s] = sum(reach[s & ~(1 << k)] for k in range(n) if s >> k & 1)
    for s in states[-2::-1]:
        leave[s] = sum(leave[s | 1 << k] for k in range(n) if not s >> k & 1)
    return [Edge(s, k, reach[s] * leave[s | 1 << k]) for s in states for k in range(n) if not s >> k & 1]


def first_of_text(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id, digest`` and others) with ``copy``: whether a smaller doc_id has the same digest.

    Only digests that occur twice come back to the rows: Spark broadcasts them while they are few, else a digest with very many rows is split.
    """
    twice = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")).where("copies > 1").select("digest", "least")
    return rows.join(twice, "digest", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))).drop("least")


def text_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc_id, part, fails`` of every row: a bit for each of the five text filters that it fails.

    A: under 50 words; B: under 65 % of the words distinct; C: over 5 % of the signs A-Z; D: any of ``#$%&*|``; E: the text of
    a smaller id. Words are runs without ASCII blanks, as they are written. Null texts and parts are empty; an empty text
    fails A alone, or E too; rows without an id are no copies and nothing is a copy of theirs; rows of one id and text are
    judged alike. Whole texts are read once; what is written is a few numbers and a digest for each.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split("t", _BLANKS), lambda w: w != "")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("t"))
    rows = rows.withColumn("words", words).withColumns({"n": F.size("words").cast("long"), "distinct": F.size(F.array_distinct("words")).cast("long")})
    capitals = F.length(F.regexp_replace("t", "[^A-Z]+", "")).cast("long")
    rules = (F.col("n") < LEAST_WORDS, 100 * F.col("distinct") < DISTINCT_PCT * F.col("n"), 100 * capitals > CAPITALS_PCT * F.length("t"), F.col("t").rlike("[#$%&*|]"))
    fails = sum((F.when(rule, 1 << k).otherwise(0) for k, rule in enumerate(rules)), F.lit(0))
    marked = staged(rows.select("doc_id", "part", fails.alias("fails"), F.unhex(F.sha2("t", 256)).alias("digest")))
    return first_of_text(marked).select("doc_id", "part", (F.col("fails") + F.when(F.col("copy"), 1 << len(rules)).otherwise(0)).alias("fails"))


def with_labels(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with ``good`` (some label of the id has quality 1) and ``toxic`` (some has toxic 1); rows without an id have neither."""
    found = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for n, c in (("good", "quality"), ("toxic", "toxic"))))
    # rows without an id are dealt by what they hold, so that they don't meet in one task
    key = F.coalesce("doc_id", F.xxhash64(*rows.columns))
    found = found.withColumnRenamed("doc_id", "label_id")
    joined = rows.join(found, (key == F.col("label_id")) & F.col("doc_id").isNotNull(), "left")
    return joined.select(*rows.columns, *(F.coalesce(n, F.lit(False)).alias(n) for n in ("good", "toxic")))


def audit_filters(rows: DataFrame, n_filters: int, lost: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """What each filter removes in each order, by part: ``part, filter_order, step, kept, removed, redundant, unique_fails, <name>_lost..., shapley``.

    ``rows`` has ``part`` (string), ``fails`` (a bit for each filter failed) and a boolean column for each name of ``lost``.
    Rows are counted by part and failures, at most 2 ** n_filters times the values of ``lost`` for each part. The counts are
    dealt to the lattice's steps (from a set of applied filters to one more), each of which is summed once; every order reads its
    steps from these sums, and the Shapley sum of a filter weights them with the number of orders that take them.

    ``redundant`` counts rows that fail the step's filter but were removed before, ``unique_fails`` those that fail no other;
    ``shapley`` is the sum over all orders of what the filter removes. Null parts are empty; repeated rows count each; other columns are left
    out; an empty table gives an empty result, a part without failures zeros.
    """
    if not 1 <= n_filters <= MOST_FILTERS:
        raise ValueError(f"from 1 to {MOST_FILTERS} filters")
    marks = rows.select(F.coalesce("part", F.lit("")).alias("part"), F.col("fails").cast("int").alias("fails"), *lost)
    counts = marks.groupBy("part", "fails").agg(F.count("*").alias("n"), *(F.count_if(c).alias(c) for c in lost))
    steps = F.array(*(F.struct(F.lit(e.state).alias("state"), F.lit(1 << e.bit).alias("own"), F.lit(e.paths).cast("long").alias("paths")) for e in lattice(n_filters)))
    dealt = counts.select("*", F.explode(steps).alias("e")).select("part", "fails", "n", *lost, "e.*")
    before, own = F.col("fails").bitwiseAND(F.col("state")) != 0, F.col("fails").bitwiseAND(F.col("own")) != 0

    def total(where: Column, what: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(what))), F.lit(0)).cast("long")

    sums = dealt.groupBy("part", "state", "own", "paths").agg(
        total(~before & ~own).alias("kept"),
        total(~before & own).alias("removed"),
        total(before & own).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"),
        *(total(~before & own, c).alias(f"{c}_lost") for c in lost),
    )
    values = [c for c in sums.columns if c not in ("part", "state", "own", "paths")]
    by_filter = sums.groupBy("part", "own").agg(F.sum(F.col("paths") * F.col("removed")).alias("shapley"), F.collect_list(F.struct("state", *values)).alias("steps"))
    taken = by_filter.select("part", "own", "shapley", F.explode("steps").alias("s")).select("part", "own", "shapley", "s.*")
    return taken.join(F.broadcast(_orders(rows, n_filters)), ["state", "own"]).select("part", "filter_order", "step", *values, "shapley")


def _orders(rows: DataFrame, n: int) -> DataFrame:
    """``state, own, filter_order, step`` of every step of every order; its rows are n! times n, whatever the input."""
    orders = ["".join(p) for p in permutations(string.ascii_uppercase[:n])]
    steps = [(sum(1 << ord(c) - ord("A") for c in order[:k]), 1 << ord(order[k]) - ord("A"), order, k + 1) for order in orders for k in range(n)]
    assert len(steps) == prod(range(1, n + 1)) * n
    return rows.sparkSession.createDataFrame(steps, "state int, own int, filter_order string, step int")
