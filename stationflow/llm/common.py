"""Helpers shared by the corpus operators: table access, staged tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.sources.scratch import staged  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table, read by Spark so that any Hadoop path works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that other columns of any name cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


#: Copies of one key that are more than one in so many rows are joined by broadcast.
HOT_SHARE = 2000


def join_copies(rows: DataFrame, classes: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``classes``, which has each ``key`` once with its number of ``copies`` among the ``total`` rows.

    Fewer than HOT_SHARE keys can have so many copies that they crowd a task; those are broadcast.
    """
    many = F.col("copies") > total / HOT_SHARE
    hot = F.broadcast(classes.where(many))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(classes.where(~many), key))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 mod 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def give_back() -> None:
    """Return what Arrow holds but doesn't use, as a worker goes on to other stages and keeps its memory."""
    pa.default_memory_pool().release_unused()


#: Bytes of text that become Python objects at once.
TEXT_BYTES = 4 << 20


def stretches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of stretches that begin within TEXT_BYTES of text; none of no rows."""
    sizes = pc.fill_null(pc.cast(pc.binary_length(texts), pa.int64()), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes) - sizes) // TEXT_BYTES
    cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else block
    yield from zip(cuts.tolist(), np.diff(np.append(cuts, len(block))).tolist(), strict=True)


def of_texts(fn: Callable[[list], list], returns: str, arrow: pa.DataType) -> Callable[[Column], Column]:
    """A column function that gives ``fn(texts) -> values`` for a string column, a stretch of texts at a time."""

    def run(texts: pa.Array) -> pa.Array:
        parts = [pa.array(fn(texts.slice(at, n).to_pylist()), arrow) for at, n in stretches(texts)]
        give_back()
        return pa.concat_arrays(parts) if parts else pa.array([], arrow)

    return F.arrow_udf(run, returns)


def per_row(df: DataFrame, fn: Callable[[list, list], tuple[list, ...]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Apply ``fn(ids, texts) -> columns`` to ``doc_id, text``, a stretch of rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in stretches(batch.column(1)):
                columns = fn(*(c.slice(at, n).to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
                del columns
            del batch
            give_back()

    return df.mapInArrow(run, schema)
