"""Hard negatives by a vector-approximation file.

Components become integers. Rows are dealt into blocks, and each block is an approximation file of its own: every dimension is cut into cells of equal count, and a row keeps the numbers of
its cells, a byte a dimension, with the least and greatest value of each cell beside them. For an anchor, a table of products with these two values gives a lower and an upper bound of each
row's score by lookups alone; only rows whose bounds leave a place for them are scored exactly:

* For the positives, rows of the anchor's label whose upper bound reaches the fifth greatest lower bound.
* For the negatives of a positive, rows of other labels whose bounds meet the window that its score opens, and whose upper bound reaches the third greatest lower bound of the rows that
  surely lie in it.

Anchors meet every block once: they are copied to each block's task, which holds its block and lets the anchors pass in batches. There are as few blocks as fit a worker's memory, and
never fewer than give the cluster's tasks some thousand rows each. What a block finds, at most five or three rows for each anchor and window, is ranked by anchor.

Defined results: rows with a null label, a null vector, or a component that is null, NaN or infinite take no part; shorter vectors count as filled up with zeros; equal rows are rows of their
own, so an anchor's copy is one of its positives; a null id can't be an anchor and comes after all others of equal score; of equal scores and ids any comes first, reruns agree; anchors
without positives, and positives without rows in their window, give no rows; an empty table gives an empty one; other columns are not read. Scores are exact 64-bit integers; components so large that
a score might not fit are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

#: Cells of a dimension, at most 256.
CELLS = 64

#: Rows of a block at most, and what a block should have at least.
BLOCK_ROWS, LEAST_ROWS = 1 << 18, 1 << 12

#: Bounds that are worked out at a time.
AT_ONCE = 1 << 18


def quantised(rows: DataFrame, scale: int = 256) -> DataFrame:
    """row (a number), vec_id, label, q (integer components) of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    label = F.col("label").cast("long")
    label = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    known = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~odd)
    q = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    return known.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), q.alias("q"))


class Block:
    """Rows in the order of their labels, with their approximations."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, none: np.ndarray, label: np.ndarray, q: np.ndarray, cells: int = CELLS):
        """none tells where an id is null, whatever stands for it in vec_id."""
        order = np.lexsort((row, label))
        self.row, self.vec_id, self.none, self.label, self.q = row[order], vec_id[order], none[order], label[order], np.ascontiguousarray(q[order])
        n, dims = q.shape
        self.codes = np.zeros((dims, n), np.uint8)
        self.low, self.high = np.zeros((dims, cells), q.dtype), np.zeros((dims, cells), q.dtype)
        for d in range(dims):
            values = np.sort(self.q[:, d])
            edges = np.unique(values[np.arange(1, cells) * n // cells])
            self.codes[d] = np.searchsorted(edges, self.q[:, d], side="right")
            first = np.searchsorted(values, edges)  # a cell begins with its edge
            begins, ends = np.concatenate([[0], first]), np.concatenate([first, [n]])
            full = ends > begins
            at = np.flatnonzero(full)
            self.low[d, at], self.high[d, at] = values[begins[full]], values[ends[full] - 1]

    def slice_of(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.label, label, side="left")), int(np.searchsorted(self.label, label, side="right"))

    def bounds(self, anchors: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the scores of rows first to last with each anchor, an array row for an anchor."""
        lower, upper = np.zeros((2, last - first, len(anchors)), self.q.dtype)
        part = np.empty_like(lower)
        for d in range(self.q.shape[1]):
            a, b = self.low[d][:, None] * anchors[:, d], self.high[d][:, None] * anchors[:, d]
            codes = self.codes[d, first:last].astype(np.intp)
            lower += np.take(np.minimum(a, b), codes, axis=0, out=part, mode="clip")
            upper += np.take(np.maximum(a, b), codes, axis=0, out=part, mode="clip")
        return np.ascontiguousarray(lower.T), np.ascontiguousarray(upper.T)

    def best(self, at: np.ndarray, scores: np.ndarray, most: int) -> list[tuple[int, int]]:
        """(place, score) of the first `most`: higher scores first, then smaller ids, null ids last."""
        order = np.lexsort((self.row[at], self.vec_id[at], self.none[at], -scores))[:most]
        return list(zip(at[order].tolist(), scores[order].tolist(), strict=True))

    def positives(self, row: np.ndarray, label: np.ndarray, q: np.ndarray, most: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(number of the anchor, its best rows of the same label)."""
        for x in np.unique(label).tolist():
            first, last = self.slice_of(x)
            if first == last:
                continue
            own = np.flatnonzero(label == x)
            step = max(1, AT_ONCE // (last - first))
            for part in (own[i : i + step] for i in range(0, len(own), step)):
                lower, upper = self.bounds(q[part], first, last)
                for k, i in enumerate(part.tolist()):
                    other = self.row[first:last] != row[i]
                    low = lower[k][other]
                    least = np.partition(low, len(low) - most)[len(low) - most] if len(low) > most else None
                    at = first + np.flatnonzero(other if least is None else other & (upper[k] >= least))
                    if len(at):
                        yield i, self.best(at, self.q[at] @ q[i], most)

    def negatives(self, label: np.ndarray, q: np.ndarray, windows: list[list[tuple[int, int]]], most: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """(number of the anchor, number of the window, its best rows of other labels). A window has its least and greatest score."""
        step = max(1, AT_ONCE // len(self.row))
        for begin in range(0, len(q), step):
            lower, upper = self.bounds(q[begin : begin + step], 0, len(self.row))
            for k, i in enumerate(range(begin, min(begin + step, len(q)))):
                open_ = [(w, a, b) for w, (a, b) in enumerate(windows[i]) if a <= b]
                if not open_:
                    continue
                near = (upper[k] >= min(a for _, a, _ in open_)) & (lower[k] <= max(b for _, _, b in open_))
                first, last = self.slice_of(int(label[i]))
                near[first:last] = False
                at = np.flatnonzero(near)
                low, high = lower[k][at], upper[k][at]
                may = np.zeros(len(at), bool)
                for _, a, b in open_:
                    sure = low[(low >= a) & (high <= b)]
                    least = int(np.partition(sure, len(sure) - most)[len(sure) - most]) if len(sure) >= most else a
                    may |= (high >= max(a, least)) & (low <= b)
                at = at[may]
                scores = self.q[at] @ q[i]
                for w, a, b in open_:
                    inside = (scores >= a) & (scores <= b)
                    if inside.any():
                        yield i, w, self.best(at[inside], scores[inside], most)


def _matrix(column: pa.Array, dims: int, dtype: type) -> np.ndarray:
    """Lists of integers as rows, the shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), dtype)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _search(placed: DataFrame, dims: int, dtype: type, find, schema: str) -> DataFrame:
    """What `find(block, batch of anchors, their vectors)` gives, for each block and all anchors, which follow their block's rows."""

    def run(batches):
        held: list[tuple] = []
        block = None
        for batch in batches:
            kind = batch.column(0).to_numpy()
            rows, anchors = batch.filter(pa.array(kind == 0)), batch.filter(pa.array(kind == 1))
            if rows.num_rows:
                ids = rows.column(2)
                held.append((rows.column(1).to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), rows.column(3).to_numpy(), _matrix(rows.column(4), dims, dtype)))
            if anchors.num_rows and held:
                block = Block(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            if anchors.num_rows and block is not None:
                out = list(find(block, anchors, _matrix(anchors.column(4), dims, dtype)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    names = [x.split()[0] for x in schema.split(", ")]
    return placed.mapInArrow(run, schema)


def hard_negatives(rows: DataFrame, n_positives: int = 5, n_negatives: int = 3, every: int = 50, window: tuple[int, int] = (50, 95), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the ids divisible by `every`. window: the least and greatest score of a negative, in hundredths of the positive's.
    """
    spark = rows.sparkSession
    known = cut(quantised(rows))
    total, dims, most = known.agg(F.count(F.lit(1)), F.max(F.size("q")), F.max(F.array_max(F.transform("q", lambda v: F.greatest(v, F.bitwise_not(v)))))).first()
    dims, most = max(dims or 0, 1), (most or 0) + 1
    if dims * most * most >= 1 << 62:
        raise ValueError("components are too large: a score might not fit 64 bits")
    dtype = np.int32 if dims * most * most < 1 << 31 else np.int64
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-total // block_rows), min(parts, -(-total // LEAST_ROWS)))
    columns = ["row", "vec_id", "label", "q"]
    dealt = known.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), *columns)
    anchors = known.where(F.col("vec_id") % every == 0)

    def placed(asked: DataFrame) -> DataFrame:
        """Rows and anchors of each block, one partition a block, rows first."""
        asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), *asked.columns)
        both = dealt.unionByName(asked, allowMissingColumns=True)
        return both.repartitionById(blocks, F.col("block")).sortWithinPartitions("kind").drop("block")

    def named(block: Block, at: int) -> tuple[int | None, int]:
        return None if block.none[at] else int(block.vec_id[at]), int(block.row[at])

    def find_positives(block: Block, batch, q):
        row, ids, label = (batch.column(c).to_numpy() for c in (1, 2, 3))
        for i, found in block.positives(row, label, q, n_positives):
            for at, score in found:
                yield int(row[i]), int(ids[i]), *named(block, at), score

    found = _search(placed(anchors), dims, dtype, find_positives, "anchor long, anchor_id long, positive_id long, other_row long, positive_score long")
    order = W.partitionBy("anchor").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "other_row")
    best = cut(found.withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= n_positives).drop("other_row"))
    opened = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("w"))
    asked = anchors.join(opened, anchors["row"] == opened["anchor"]).select(*columns, F.col("w.place").alias("places"), F.col("w.positive_score").alias("scores"))

    def find_negatives(block: Block, batch, q):
        row, label = batch.column(1).to_numpy(), batch.column(3).to_numpy()
        places, scores = batch.column(5).to_pylist(), batch.column(6).to_pylist()
        windows = [[(-(-window[0] * s // 100), window[1] * s // 100) for s in own] for own in scores]
        for i, w, found in block.negatives(label, q, windows, n_negatives):
            for at, score in found:
                yield int(row[i]), places[i][w], *named(block, at), score

    found = _search(placed(asked), dims, dtype, find_negatives, "anchor long, place long, negative_id long, other_row long, negative_score long")
    order = W.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "other_row")
    last = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return last.join(best, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
