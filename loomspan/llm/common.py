"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.storage import discard, file_system, scratch, shared_folder  # noqa: F401  (the operators take them from here)

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts are handed to NumPy in slices of about this many bytes.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the cluster's shared checkpoint folder; a folder of our own serves only where none is set, as in tests."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives the memory that this process no longer uses back to the system: what Arrow's pool and the allocator keep else adds up over the workers of an executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows that hold about `size` bytes, one made at a time; null texts are empty. After each batch free memory is given back."""
    texts = batch.column(batch.schema.get_field_index(column))
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = upto[first - 1] if first else 0
        stop = int(min(len(texts), np.searchsorted(upto, before + size) + 1))
        yield first, [t or "" for t in texts.slice(first, stop - first).to_pylist()]
        first = stop
    release()


def in_total_order(df: DataFrame, order: list[str | Column], name: str = "_rank") -> DataFrame:
    """df with each row's place, from 0, in an order that should be total (a row number at the end makes it so).

    Rows are dealt by ranges of the whole order, so no leading value, however frequent, has to stay in one task; within a range rows are numbered as they come,
    and what goes before a range is a sum over counts of ranges, of which there are as many as shuffle partitions. df is read twice: cut it first if that is dear.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())).withColumn("_range", F.expr("shiftright(_at, 33)"))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    firsts = counts.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_first"))
    return placed.join(F.broadcast(firsts), "_range").withColumn(name, F.col("_first") + F.expr("_at & 8589934591")).drop("_range", "_at", "_first")


#: Bytes that a run of ids is to hold at most, unless there would then be more runs than MOST_RUNS: tasks stream their run, so it may grow with the input.
RUN_BYTES = 64 << 20

#: Runs at most, or few more; what the driver and the tasks know of runs, some 8 cells of sums for each, is bounded by it.
MOST_RUNS = 15_000


class Runs:
    """Runs of rows in the order of an integer id (nulls last), then of a hash h: at least as many as shuffle partitions, of about equal weight.

    sizes has id, h and n (a row's weight) and is read a few times. Exact sums over cells of equal width give the cuts, refined where a cell holds much, and over ranges of h where a
    single id (or null) does; so reruns agree, and the driver gets some rows for each run, whose number is bounded whatever the input.
    """

    def __init__(self, sizes: DataFrame, most: int = RUN_BYTES, runs: int = MOST_RUNS):
        parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        low, high, total, none = sizes.agg(F.min("id"), F.max("id"), F.sum("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")))).first()
        low, high, total, none = low or 0, high or 0, total or 0, none or 0
        self.null_id = high + 1 if high < (1 << 63) - 1 else high
        most = max(1, min(most, -(-total // parts)), -(-total // runs))
        fine, width = max(1, most // 4), max(1, -(-(high - low + 1) // (8 * max(parts, -(-total // most), 128))))
        cells: dict[tuple[int, int], int] = {}
        hot: list[int] = []
        known = sizes.where("id is not null")
        while True:
            cell = F.expr(f"cast(floor((cast(id as decimal(20,0)) - {low}) / {width}) as bigint)").alias("cell")
            found = known.groupBy(cell).agg(F.sum("n").alias("n")).collect()
            heavy = [r["cell"] for r in found if r["n"] > fine and width > 1]
            hot += [low + r["cell"] for r in found if r["n"] > most and width == 1]
            cells |= {(low + r["cell"] * width, -1 << 63): r["n"] for r in found if not (r["n"] > fine and width > 1)}
            if not heavy:
                break
            known = known.where(F.expr(f"cast(floor((cast(id as decimal(20,0)) - {low}) / {width}) as bigint)").isin(heavy))
            width = max(1, width // 64)
            # Cells of the next width start at multiples of it, so a cell may begin before the heavy one that it lies in.
        if none:
            cells[self.null_id, -1 << 63] = none
        if hot or none > most:
            bits = min(40, (4 * max([none, *(cells[i, -1 << 63] for i in hot)]) // most).bit_length())
            same = sizes.where(F.col("id").isin(hot) | (F.col("id").isNull() if none > most else F.lit(False)))
            for i in [*hot, *([self.null_id] if none > most else [])]:
                del cells[i, -1 << 63]
            for r in same.groupBy("id", F.expr(f"shiftright(h, {64 - bits})").alias("range")).agg(F.sum("n").alias("n")).collect():
                cells[self.null_id if r["id"] is None else r["id"], r["range"] << (64 - bits)] = r["n"]
        self.starts, held = [], 0
        for start, n in sorted(cells.items()):
            if held and held + n / 2 > most:
                self.starts.append(start)
                held = 0
            held += n
        self.count = len(self.starts) + 1

    def of(self, id_: Column, h: Column) -> Column:
        """Number of the run that a row is in."""
        ids, hashes = (np.array([s[k] for s in self.starts], np.int64) for k in (0, 1))

        @F.pandas_udf("int")
        def place(i: pd.Series, h: pd.Series) -> pd.Series:
            i, h = i.to_numpy(np.int64), h.to_numpy(np.int64)
            first, last = np.searchsorted(ids, i, side="left"), np.searchsorted(ids, i, side="right")
            out = first.copy()
            for k in np.unique(first[last > first]).tolist():  # ids at which runs begin
                own = (first == k) & (last > first)
                out[own] = k + np.searchsorted(hashes[k : last[own][0]], h[own], side="right")
            return pd.Series(out.astype(np.int32))

        return place(F.coalesce(id_.cast("long"), F.lit(self.null_id).cast("long")), h)


def columns_but(df: DataFrame, *names: str) -> list[Column]:
    """df's columns other than these, whatever their names."""
    return [df[f"`{c}`"] for c in df.columns if c not in names]


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, quality of all labelled documents."""
    return labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))


def label_sample(labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, quality of at most `sample` labelled documents, those with the least hash of the id."""
    return known_labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
