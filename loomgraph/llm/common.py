"""What the training-data operators share: reading, the shared folder, keys, batches and worker caches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import bounded, only, remove, replace, scratch, shared_dir, staged

__all__ = ["Bitmap", "bounded", "column", "fresh", "keyed", "map_batches", "only", "own_id", "remove", "replace", "scratch", "shared_dir", "staged", "table", "text_column", "worker_cache"]

#: Rows and bytes that a function gets at once. What Spark sends is bounded by its own settings (64 MB by default).
BATCH_ROWS = 256
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str, of: str | None = None) -> Column:
    """The column of this very name, dots and all; or that field of a struct."""
    name = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{name}" if of else name)


def text_column(name: str = "text", of: str | None = None) -> Column:
    """The column as a string, null as the empty text."""
    return F.coalesce(column(name, of).cast("string"), F.lit(""))


def fresh(name: str, taken: list[str]) -> str:
    """name with as many underscores after it as it takes to differ from those taken, as Spark compares names."""
    have = {t.lower() for t in taken}
    while name.lower() in have:
        name += "_"
    return name


def keyed(docs: DataFrame, id_col: str) -> DataFrame:
    """(k, row): row has all columns of docs, so none can clash with an operator's own. k is in the order of the id
    and differs from row to row: the id itself or, if some are equal or null, the id and an internal number, after
    docs has been staged so that numbers stay."""
    out = docs.select(column(id_col).alias("k"), F.struct(*(column(c) for c in docs.columns)).alias("row"))
    if out.groupBy("k").count().filter("k IS NULL OR count > 1").limit(1).count():
        out = staged(out.withColumn("n", F.monotonically_increasing_id()), "numbered")
        return out.select(F.struct(F.col("k").alias("id"), F.col("n").alias("row")).alias("k"), "row")
    return out


def own_id(rows: DataFrame, docs: DataFrame, id_col: str) -> Column:
    """The id in the key k of keyed rows."""
    return F.col("k") if rows.schema["k"].dataType == docs.schema[id_col].dataType else F.col("k.id")


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, min(BATCH_ROWS, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str) -> DataFrame:
    """fn on the rows of df, in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if (out := fn(part)) is not None:
                    yield out

    return df.mapInArrow(run, schema)


class Bitmap:
    """A set of 64-bit hashes (a long column), with others by chance, in a bitmap of 2 ** bits bits by their lowest bits;
    fixed in size, so it may go to every task."""

    def __init__(self, hashes: DataFrame, column_: str, bits: int = 23):
        self.mask = np.uint64((1 << bits) - 1)
        at = F.col(column_).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)))
        rows = hashes.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
        words = np.zeros(1 << (bits - 6), np.int64)
        words[rows["at"].to_numpy()] = rows["bits"].to_numpy()
        self.data = words.view(np.uint8)

    def has(self, g: np.ndarray) -> np.ndarray:
        at = (g & self.mask).astype(np.int64)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def worker_cache(key: str, make: Callable):
    """make() once a Python worker, for what is costly to build and read-only."""
    held = sys.__dict__.setdefault("_loomgraph_worker_cache", {})
    if key not in held:
        held[key] = make()
    return held[key]
