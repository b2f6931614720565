"""Best-fit packing of token sequences by linear grouping.

Lengths are integers up to the capacity, so the whole corpus is described by a histogram of at most `capacity` rows, whatever its size. The plan is made on
that histogram:

1. Lengths over a share of the capacity are *large*. They are split into groups of equal cardinality, and each is rounded up to its group's longest.
2. Configurations of the few rounded sizes are optimised by column generation on the cutting-stock linear program (a knapsack prices new configurations).
3. Whole multiples of each configuration become sequences; actual lengths, longest first, take the places of the rounded ones.
4. The large pieces left over by rounding down the solution, then the small ones, go longest first into the fullest sequence that still holds them.

Equal lengths are interchangeable, so every step moves runs of equal sequences, and the plan has a few thousand rows. Pieces get their rank among those of their
length by counts over buckets, of which a length has as many as its count in the histogram asks for, and a rank's place is found in the plan, whose size depends on the
capacity alone. So a length shared by a third of all rows meets in no task.

Defined results: a null text is empty and gives one piece that holds the end id alone; only documents longer than the capacity are cut, from the end, so the
first piece may be shorter; repeated rows are packed each; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fst_tokenizer
from .common import cut, slices

#: Buckets of a length at least, and pieces that one is to hold beyond that.
BUCKETS, BUCKET_ROWS = 64, 100_000


def pieces(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece."""

    def encode(batches):
        tokenizer = fst_tokenizer.load(path)
        for batch in batches:
            for first, texts in slices(batch):
                ids, sizes = tokenizer.encode(texts)
                rows: list[tuple] = []
                kept: list[np.ndarray] = []
                at = 0
                for i, n in enumerate(sizes.tolist()):
                    own = np.append(ids[at : at + n], end_id).astype("<u4")
                    at += n
                    head = len(own) % capacity or capacity
                    start = 0
                    for k, stop in enumerate(range(head, len(own) + 1, capacity)):
                        part = own[start:stop]
                        rows.append((first + i, k, start, stop - start, zlib.crc32(part)))
                        kept.append(part)
                        start = stop
                which, *numbers = zip(*rows, strict=True)
                arrays = [batch.column(0).take(pa.array(which)), pa.array(numbers[0], pa.int32())]
                arrays += [pa.array(x, pa.int64()) for x in numbers[1:]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.tolist() for x in kept], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    return docs.select("doc_id", "text").mapInArrow(encode, T.StructType(fields))


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """(number of each size, times used) of configurations: the cutting-stock linear program by column generation, rounded down."""
    n = len(sizes)
    order = np.argsort(sizes)
    ascending = np.array(sizes)[order]
    demand = np.array(counts, float)
    columns = np.zeros((n, n))
    for i, s in enumerate(sizes):
        columns[i, i] = capacity // s
    for _ in range(20 * n + 50):
        inverse = np.linalg.inv(columns)
        prices = inverse.sum(axis=0)  # each configuration costs one sequence
        best = np.zeros(capacity + 1)
        choice = np.full(capacity + 1, -1)
        for room in range(1, capacity + 1):
            best[room] = best[room - 1]
            if m := int(np.searchsorted(ascending, room, side="right")):
                value = best[room - ascending[:m]] + prices[order[:m]]
                i = int(value.argmax())
                if value[i] > best[room] + 1e-12:
                    best[room], choice[room] = value[i], order[i]
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(n), capacity
        while room > 0:
            if (i := choice[room]) < 0:
                room -= 1
            else:
                column[i] += 1
                room -= sizes[i]
        change, now = inverse @ column, inverse @ demand
        ratios = np.where(change > 1e-9, now / np.where(change > 1e-9, change, 1), np.inf)
        columns[:, int(np.argmin(ratios))] = column
    times = np.floor(np.maximum(np.linalg.solve(columns, demand), 0) + 1e-9).astype(np.int64)
    return [(columns[:, k].astype(np.int64), int(t)) for k, t in enumerate(times) if t > 0]


def pack_histogram(histogram: dict[int, int], capacity: int = 1024, n_groups: int = 40, shares: tuple[int, ...] = (2, 3, 8)) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences): a plan for histogram's pieces, whose cardinalities it uses up exactly.

    The length from which pieces count as large is itself optimised, over capacity / share.
    """
    return min((grouped_plan(histogram, capacity, n_groups, x) for x in shares), key=lambda plan: sum(n for _, n in plan))


def grouped_plan(histogram: dict[int, int], capacity: int, n_groups: int, large_share: int) -> list[tuple[tuple[int, ...], int]]:
    left = {s: c for s, c in histogram.items() if c > 0}
    plan: list[tuple[tuple[int, ...], int]] = []
    if full := left.pop(capacity, 0):
        plan.append(((capacity,), full))
    open_runs: list[list] = []  # lengths, room, number
    large = sorted((s for s in left if s * large_share > capacity), reverse=True)
    if large:
        groups: list[list[int]] = [[]]
        share, held = max(1, -(-sum(left[s] for s in large) // n_groups)), 0
        for s in large:
            if groups[-1] and held + left[s] > share:
                groups.append([])
                held = 0
            groups[-1].append(s)
            held += left[s]
        rounded = [g[0] for g in groups]
        for column, times in configurations(rounded, [sum(left[s] for s in g) for g in groups], capacity):
            # Runs of equal sequences: each place takes its group's longest lengths that are left.
            runs: list[tuple[tuple[int, ...], int]] = [((), times)]
            for g, places in enumerate(column.tolist()):
                for _ in range(places):
                    filled: list[tuple[tuple[int, ...], int]] = []
                    for lengths, n in runs:
                        while n and (s := next((s for s in groups[g] if left.get(s)), None)) is not None:
                            k = min(n, left[s])
                            filled.append((lengths + (s,), k))
                            left[s] -= k
                            n -= k
                        if n:
                            filled.append((lengths, n))
                    runs = filled
            merged: dict[tuple[int, ...], int] = defaultdict(int)
            for lengths, n in runs:
                merged[lengths] += n
            open_runs += [[lengths, capacity - sum(lengths), n] for lengths, n in merged.items() if lengths]
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for lengths, room, n in open_runs:
        by_room[room][lengths] += n
    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            room = next((r for r in range(s, capacity + 1) if by_room.get(r)), None)
            if room is None:  # new sequences of this length alone
                k = capacity // s
                if n // k:
                    by_room[capacity - k * s][(s,) * k] += n // k
                if n % k:
                    by_room[capacity - n % k * s][(s,) * (n % k)] += 1
                break
            lengths, m = next(iter(by_room[room].items()))
            k = room // s
            whole = min(m, n // k)
            if whole:
                by_room[room][lengths] -= whole
                by_room[room - k * s][lengths + (s,) * k] += whole
                n -= whole * k
            else:
                by_room[room][lengths] -= 1
                by_room[room - n * s][lengths + (s,) * n] += 1
                n = 0
            if not by_room[room][lengths]:
                del by_room[room][lengths]
    return plan + [(lengths, n) for room in sorted(by_room) for lengths, n in sorted(by_room[room].items()) if n]


def places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the places of its ranks: first rank, first sequence, offset, number of sequences, number a sequence."""
    out: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, n in plan:
        offset, i = 0, 0
        while i < len(lengths):
            s, k = lengths[i], 1
            while i + k < len(lengths) and lengths[i + k] == s:
                k += 1
            out[s].append((ranks[s], sequence, offset, n, k))
            ranks[s] += n * k
            offset += k * s
            i += k
        sequence += n
    return {s: np.array(x, np.int64) for s, x in out.items()}


def ranked(pieces: DataFrame, histogram: dict[int, int], order: list[str]) -> DataFrame:
    """Adds rank: the number, from 0, of each piece among those of its length. Counts over buckets go before ranks within a bucket; a length has as many buckets as its count asks for."""
    salts = F.array(*[F.lit(BUCKETS + histogram.get(s, 0) // BUCKET_ROWS) for s in range(max(histogram, default=0) + 1)])
    pieces = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.get(salts, F.col("length").cast("int"))))
    sizes = pieces.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("length", "_salt", (F.sum("_n").over(W.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    inner = F.row_number().over(W.partitionBy("length", "_salt").orderBy(*order)) - 1
    return pieces.withColumn("_inner", inner).join(before, ["length", "_salt"]).withColumn("rank", F.col("_before") + F.col("_inner")).drop("_salt", "_inner", "_before")


def pack(cut_pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to pieces (any table with doc_id, piece and a length of at most capacity). The pieces are read three times: cut them from their lineage first."""
    spark = cut_pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    plan = spark.sparkContext.broadcast(places(pack_histogram(histogram, capacity)))
    ties = [c for c in ("ids_crc32",) if c in cut_pieces.columns]
    keyed = ranked(cut_pieces.withColumn("_row", F.monotonically_increasing_id()), histogram, ["doc_id", "piece", *ties, "_row"]).drop("_row")
    i, j = keyed.columns.index("length"), keyed.columns.index("rank")

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths, ranks = (np.asarray(batch.column(x)).astype(np.int64) for x in (i, j))
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for s in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == s)
                runs = plan.value[s]
                run = runs[np.searchsorted(runs[:, 0], ranks[own], side="right") - 1]
                d = ranks[own] - run[:, 0]
                sequence[own] = run[:, 1] + d // run[:, 4]
                offset[own] = run[:, 2] + d % run[:, 4] * s
            columns = [batch.column(x) for x in range(batch.num_columns) if x != j]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names)

    fields = [f for f in keyed.schema.fields if f.name != "rank"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    names = [f.name for f in fields]
    return keyed.mapInArrow(assign, T.StructType(fields))


def packed(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """Pieces of the documents with their sequences; with_ids keeps the ids themselves."""
    return pack(cut(pieces(docs, path, end_id, capacity, with_ids)), capacity)
