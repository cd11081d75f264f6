"""Changing rows: newest versions, corrections, erasures, histories, repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_version(df: DataFrame, keys: list[str], version: str = "updated_at", tie: str | None = None, follow: tuple[str, ...] = (), near: tuple[str, ...] = ()) -> DataFrame:
    """The newest row of each key; of equal versions the larger ``tie``, else the first in column order.

    Columns named by ``follow`` are decided by the others, so they can't break a tie and needn't be computed for it.
    Ranking to one row lets Spark drop older versions before the shuffle. That takes one more sort, which only many versions of a
    key are worth: with ``near``, columns that follow from the keys, rows are dealt by these first and sorted once, and stay
    dealt so for what comes after.
    """
    if near:
        df, keys, follow = df.repartition(*near), [*near, *(k for k in keys if k not in near)], (*follow, *near)
    order = [F.desc_nulls_last(version)] + ([F.desc_nulls_last(tie)] if tie else [])
    rest = [F.asc_nulls_last(c) for c, kind in df.dtypes if c not in {*keys, *follow, version, tie} and not kind.startswith(("map", "variant"))]
    return df.withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))).where("__nth = 1").drop("__nth")


def live_rows(df: DataFrame) -> DataFrame:
    """Rows not marked as deleted; to be taken after ``latest_version``."""
    return df.where(~F.coalesce(F.col("is_deleted"), F.lit(False)))


def apply_corrections(base: DataFrame, changes: DataFrame, keys: list[str], version: str = "updated_at") -> DataFrame:
    """The newest version of every row of both; a correction wins a tie."""
    both = base.withColumn("__load", F.lit(0)).unionByName(changes.withColumn("__load", F.lit(1)), allowMissingColumns=True)
    return latest_version(both, keys, version, "__load").drop("__load")


def merge_json(base: Column, patch: Column) -> Column:
    """Two flat JSON objects as one; the patch wins. Null counts as an empty object.

    Values keep their JSON type; the keys come out sorted, and escaped as JSON text.
    """

    def read(c: Column) -> Column:
        return F.coalesce(F.from_json(c, "map<string,variant>"), F.create_map().cast("map<string,variant>"))

    keys = F.array_sort(F.array_union(F.map_keys(read(base)), F.map_keys(read(patch))))
    value = lambda k: F.coalesce(F.element_at(read(patch), k), F.element_at(read(base), k))
    return F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: F.concat(F.to_json(k.cast("variant")), F.lit(":"), F.to_json(value(k)))), ","), F.lit("}"))


def apply_tombstones(df: DataFrame, erased: DataFrame, key: str) -> DataFrame:
    """Rows of erased keys are marked as deleted; the rest keep their mark."""
    gone = erased.select(F.col(key).alias("__key")).where("__key is not null").distinct().withColumn("__gone", F.lit(True))
    joined = df.join(gone, df[key] == gone["__key"], "left")
    return joined.withColumn("is_deleted", F.coalesce("__gone", "is_deleted", F.lit(False))).select(*df.columns)


def purge(df: DataFrame, erased: DataFrame, key: str) -> DataFrame:
    """Rows of erased keys are dropped."""
    return df.join(erased.select(key).distinct(), key, "left_anti")


def scd2_history(changes: DataFrame, keys: list[str], since: str) -> DataFrame:
    """A change log as validity intervals: each row ends where the key's next begins."""
    following = F.lead(since).over(Window.partitionBy(*keys).orderBy(since))
    return changes.withColumns({"effective_to": following, "is_current": following.isNull()})


def scd2_apply(history: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Close each changed key's current row at the change and add the new current row.

    ``history`` has ``effective_from, effective_to, is_current``; ``changes`` has the
    same attributes with ``effective_from``, one row for each key.
    """
    news = changes.select(*keys, F.col("effective_from").alias("__from"))
    closing = F.col("is_current") & F.col("__from").isNotNull()
    closed = history.join(news, keys, "left").withColumns({"effective_to": F.when(closing, F.col("__from")).otherwise(F.col("effective_to")), "is_current": F.col("is_current") & ~closing}).drop("__from")
    kind = dict(history.dtypes)["effective_to"]
    return closed.select(*history.columns).unionByName(changes.withColumns({"effective_to": F.lit(None).cast(kind), "is_current": F.lit(True)}).select(*history.columns))


def find_duplicates(df: DataFrame, business_key: list[str], row_id: str) -> DataFrame:
    """Rows whose business key occurred under a smaller id, with that first id."""
    group = Window.partitionBy(*business_key)
    return df.withColumns({"first_id": F.min(row_id).over(group), "nth": F.row_number().over(group.orderBy(row_id))}).where("nth > 1")


def changed_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Keys that were added, removed or changed in any attribute; a null differs from any value and equals a null."""
    cols = [c for c in new.columns if c != key]
    side = lambda df, name: df.select(F.col(key).alias(f"{name}_key"), F.struct(*cols).alias(name))
    both = side(new, "new").join(side(old, "old"), F.col("new_key") == F.col("old_key"), "full_outer")
    kind = F.when(F.col("old_key").isNull(), "added").when(F.col("new_key").isNull(), "removed").when(~F.col("new").eqNullSafe(F.col("old")), "changed")
    return both.select(F.coalesce("new_key", "old_key").alias(key), kind.alias("change")).where("change is not null")


def load_dim(new: DataFrame, old: DataFrame, key: str, as_of: Column) -> DataFrame:
    """The new dimension; rows that changed carry ``as_of`` as ``updated_at``, others keep theirs. A value that moves between a null and a filled column is a change."""
    cols = [c for c in new.columns if c not in {key, "updated_at"}]
    kept = old.select(F.col(key).alias("__key"), F.struct(*cols).alias("__old"), F.col("updated_at").alias("__at"))
    joined = new.drop("updated_at").join(kept, F.col(key) == F.col("__key"), "left")
    same = F.col("__key").isNotNull() & F.struct(*cols).eqNullSafe(F.col("__old"))
    return joined.withColumn("updated_at", F.when(same, F.col("__at")).otherwise(as_of)).drop("__key", "__old", "__at")
