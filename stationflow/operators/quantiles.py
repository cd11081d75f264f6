"""Exact quantiles: of groups of any size by narrowing histograms, of small ones by a sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Cells for each factor e of a value's size: neighbouring values share a cell if they differ by less than 0.1 %.
CELLS_PER_E = 1000
Quantiles = dict[str, tuple[Column | str, float]]


def cell_of(value: Column) -> Column:
    """A coarse step function of a double that never falls where the value rises; NaN lies over all."""
    return F.rint(F.signum(value) * F.log1p(F.abs(value)) * CELLS_PER_E)


def exact_quantiles(df: DataFrame, group: str, wanted: Quantiles) -> DataFrame:
    """``group`` and a column for each name of ``wanted`` (``name: (column, share)``), as ``percentile`` gives it: linear between ranks.

    Equal values are counted first, by group and value. The counts' histogram by cell, at most some
    ten thousand cells a group, tells which cell holds each wanted rank and how many values lie below; only the values of
    that cell are then ranked. So no group's values meet in one buffer or one task, and no estimate is involved; the cells only decide how
    much is left to rank. Nulls are left out; a group without a value has no row, or a null beside others.
    """
    names = list(wanted)
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("q"), F.col(c).cast("double").alias("v") if isinstance(c, str) else c.cast("double").alias("v")) for k, (c, _) in enumerate(wanted.values()))))
    rows = df.select(F.col(group).alias("g"), each.alias("e")).select("g", "e.q", "e.v").where("v is not null")
    counts = rows.groupBy("g", "q", "v").agg(F.count("*").alias("n")).withColumn("cell", cell_of(F.col("v")))
    cells = counts.groupBy("g", "q", "cell").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("g", "q")
    cells = cells.withColumns({"upto": F.sum("n").over(whole.orderBy("cell")), "total": F.sum("n").over(whole)})
    share = F.element_at(F.array(*(F.lit(float(p)) for _, p in wanted.values())), F.col("q") + 1)
    place = share * (F.col("total") - 1)
    ranks = cells.withColumn("place", place).withColumns({"low": F.floor("place"), "high": F.ceil("place")})
    held = lambda rank: (F.col(rank) < F.col("upto")) & (F.col(rank) >= F.col("upto") - F.col("n"))
    hit = ranks.where(held("low") | held("high")).select("g", "q", "cell", "place", "low", "high", (F.col("upto") - F.col("n")).alias("below"))
    near = counts.join(hit, ["g", "q", "cell"])
    near = near.withColumn("upto", F.col("below") + F.sum("n").over(Window.partitionBy("g", "q", "cell").orderBy("v")))
    ends = near.groupBy("g", "q").agg(F.max("place").alias("place"), F.max(F.when(held("low"), F.col("v"))).alias("low"), F.max(F.when(held("high"), F.col("v"))).alias("high"))
    found = ends.select("g", "q", _between(F.col("place"), F.col("low"), F.col("high")).alias("value"))
    return found.groupBy("g").agg(*(F.max(F.when(F.col("q") == k, F.col("value"))).alias(name) for k, name in enumerate(names))).withColumnRenamed("g", group)


def aggregate(df: DataFrame, keys: list[Column | str], measures: list[Column], wanted: Quantiles) -> DataFrame:
    """``df`` grouped by ``keys`` with ``measures`` and exact quantiles; null keys are keys like others. ``df`` is read twice."""
    keyed = df.withColumn("__group", F.struct(*keys) if keys else F.struct(F.lit(0).alias("__all")))
    plain = keyed.groupBy("__group").agg(*measures) if keys else keyed.agg(*measures).withColumn("__group", F.struct(F.lit(0).alias("__all")))
    found = plain.join(exact_quantiles(keyed, "__group", wanted), "__group", "left")
    return found.select(*(["__group.*"] if keys else []), *(c for c in plain.columns if c != "__group"), *wanted)


def aggregate_small(df: DataFrame, keys: list[str], measures: list[Column], wanted: Quantiles) -> DataFrame:
    """What ``aggregate`` gives, for groups that are small beside a task's rows (a station's hour): ``df`` is read once.

    Rows are ranked by their values in a sort that spills, so a group needs no buffer either; but it
    meets in one task. Rows that are dealt by ``keys`` already aren't dealt again.
    """
    whole, picks = Window.partitionBy(*keys), []
    for k, (name, (c, share)) in enumerate(wanted.items()):
        value, nth, n = f"__v{k}", f"__nth{k}", f"__n{k}"
        df = df.withColumn(value, (F.col(c) if isinstance(c, str) else c).cast("double"))
        df = df.withColumn(nth, F.row_number().over(whole.orderBy(F.asc_nulls_last(value)))).withColumn(n, F.count(value).over(whole))
        place = share * (F.col(n) - 1)
        held = lambda rank, nth=nth, value=value: F.max(F.when(F.col(nth) - 1 == rank, F.col(value)))
        picks.append((name, F.max(place).alias(f"__place{k}"), held(F.floor(place)).alias(f"__low{k}"), held(F.ceil(place)).alias(f"__high{k}")))
    found = df.groupBy(*keys).agg(*measures, *(c for _, *cols in picks for c in cols))
    values = {}
    for k, (name, *_) in enumerate(picks):
        place, low, high = (F.col(f"__{part}{k}") for part in ("place", "low", "high"))
        values[name] = _between(place, low, high)
    return found.withColumns(values).drop(*(f"__{part}{k}" for part in ("place", "low", "high") for k in range(len(picks))))


def _between(place: Column, low: Column, high: Column) -> Column:
    """The value at ``place`` between the ranks beside it."""
    between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
    return F.when((F.ceil(place) == F.floor(place)) | (low == high), low).otherwise(between)
