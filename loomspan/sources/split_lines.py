"""Lines of documents of any size, read by many tasks at once.

Whether a line is in a fence depends on all lines before it. A split of a file doesn't know in which fence it begins, but it can say where it would end for each: without an open fence it
runs as ever, and with one it does so from the first line that would close it. As those lines are few, a split's work is a small map from the state at its entry to that at its exit. One row
for each split goes to a scan that composes the maps in the order of the splits; each split then fills in its lines from its true entry state and its first line's number.

A document is a file, or a folder of parts whose names give their order, as Spark's writers leave them. Line ends count as elsewhere: carriage returns become line feeds, the rarer Unicode ends stay in
their lines. Splits are those of Spark's file source (spark.sql.files.maxPartitionBytes), so a document needs no task that holds it; a single line must fit one, and a file without any line
feed is a single line before its carriage returns are looked at. An empty document has no lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators.lines import FENCE, NAME
from loomspan.storage import keeper

RARE = r"\x0B\x0C\x1C-\x1E\x85\u2028\u2029"
#: What the lines of a fence look like to the search for them, in either dialect.
MAYBE = {False: "^`{3}", True: "^ {0,3}(`{3}|~{3})"}

#: Splits whose entry states may be broadcast: some 20 MB.
MOST_BROADCAST = 200_000

#: One split: exit without an open fence at the entry, and for runs of a character and of a length between two the exit if such a fence is open at the entry.
MAP = "idle string, closes array<struct<mark:string,least:int,most:int,exit:string>>"


def event(line: str, tilde: bool) -> tuple[str, bool, bool] | None:
    """(run, may open a fence, may close one) of a line that begins or ends fences."""
    m = FENCE[tilde].match(line)
    if m is None:
        return None
    run, rest = m.groups()
    opens = tilde or bool(NAME.fullmatch(rest))
    closes = not rest.strip(" \t") if tilde else not rest
    return (run, opens, closes) if opens or closes else None


def closes(run: str, fence: str, tilde: bool) -> bool:
    return run[0] == fence[0] and len(run) >= len(fence) if tilde else run == fence


def split_map(events: list[tuple[str, bool, bool]], tilde: bool) -> tuple[str, list[tuple[str, int, int, str]]]:
    """(exit of a split that begins outside fences; exits of one that begins inside), in one walk back over its events."""
    n = len(events)
    idle = [""] * (n + 1)  # the exit from outside fences before each event
    first: dict[str, list[tuple[int, int]]] = {"`": [], "~": []}  # runs that close, with their events, from the nearest: longer and longer ones, or all of them in the plain dialect

    def closing(fence: str) -> int | None:
        """The next event that closes a fence."""
        if tilde:
            return next((at for length, at in reversed(first[fence[0]]) if length >= len(fence)), None)
        return next((at for length, at in reversed(first[fence[0]]) if length == len(fence)), None)

    for i in range(n - 1, -1, -1):
        run, opens, ends = events[i]
        if opens:
            at = closing(run)
            idle[i] = run if at is None else idle[at + 1]
        else:
            idle[i] = idle[i + 1]
        if ends:
            stack = first[run[0]]
            if tilde:
                while stack and stack[-1][0] <= len(run):
                    stack.pop()
                stack.append((len(run), i))
            else:
                stack[:] = [x for x in stack if x[0] != len(run)] + [(len(run), i)]
    out = []
    for mark, stack in first.items():
        below = 0
        for length, at in reversed(stack):
            out.append((mark, below + 1 if tilde else length, length, idle[at + 1]))
            below = length
    return idle[0], out


def after(state: str, idle: str, exits: list) -> str:
    """The state at a split's exit."""
    if not state:
        return idle
    return next((x["exit"] for x in exits if x["mark"] == state[0] and x["least"] <= len(state) <= x["most"]), state)


def raw_lines(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """doc_id, file, block (where the split begins), line, and last (whether it ends a row of the file), in the order of the file within each block."""
    rows = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    doc = F.regexp_replace(F.input_file_name(), "/[^/]*$", "") if parts else F.input_file_name()
    pieces = F.split(F.regexp_replace("value", "\r$", ""), f"(?<=[{RARE}])|\r")
    return rows.select(doc.alias("doc_id"), "file", "block", F.octet_length("value").alias("bytes"), F.endswith("value", F.lit("\r")).alias("returns"), F.posexplode(pieces).alias("k", "line"))


def _runs(batches: Iterator[pa.RecordBatch], keys: int = 3) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(doc_id, file, block) and the rows of each stretch of a batch that lies in one block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in range(keys):
            column = batch.column(c)
            change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(change).tolist()
        for a, b in zip(begins, [*begins[1:], batch.num_rows], strict=True):
            yield tuple(batch.column(c)[a].as_py() for c in range(keys)), batch.slice(a, b - a)


def _events(lines: pa.Array, tilde: bool) -> Iterator[tuple[int, tuple[str, bool, bool]]]:
    at = np.flatnonzero(pc.match_substring_regex(lines, MAYBE[tilde]).to_numpy(zero_copy_only=False))
    for i, line in zip(at.tolist(), lines.take(pa.array(at)).to_pylist(), strict=True):
        if (found := event(line, tilde)) is not None:
            yield i, found


def split_maps(rows: DataFrame, tilde: bool) -> DataFrame:
    """A row for each split: its lines, its bytes, whether it ends with a carriage return, and its map."""

    def scan(batches):
        held: dict[tuple, list] = {}
        for key, part in _runs(batches):
            own = held.setdefault(key, [0, 0, False, []])
            own[0] += part.num_rows
            starts = pc.equal(part.column(5), 0)  # a row of the file is counted at its first line
            own[1] += (pc.sum(pc.add(pc.cast(part.column(3).filter(starts), pa.int64()), 1)).as_py() or 0)
            own[2] = part.column(4)[-1].as_py()
            own[3] += [e for _, e in _events(part.column(6), tilde)]
            if len(held) > 1:  # a block's rows follow each other: those before are complete
                for k in [k for k in held if k != key]:
                    yield _map_row(k, held.pop(k))
        for k in list(held):
            yield _map_row(k, held.pop(k))

    def _map_row(key: tuple, own: list) -> pa.RecordBatch:
        idle, exits = split_map(own[3], tilde)
        exits = [dict(zip(("mark", "least", "most", "exit"), x, strict=True)) for x in exits]
        kind = pa.list_(pa.struct([("mark", pa.string()), ("least", pa.int32()), ("most", pa.int32()), ("exit", pa.string())]))
        arrays = [pa.array([x]) for x in key] + [pa.array([own[0]], pa.int64()), pa.array([own[1]], pa.int64()), pa.array([own[2]], pa.bool_()), pa.array([idle]), pa.array([exits], kind)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "file", "block", "n_lines", "bytes", "returns", "idle", "closes"])

    return rows.select("doc_id", "file", "block", "bytes", "returns", "k", "line").mapInArrow(scan, f"doc_id string, file string, block long, n_lines long, bytes long, returns boolean, {MAP}")


def entries(maps: DataFrame, sizes: DataFrame, strict: bool) -> tuple[DataFrame, DataFrame]:
    """(a row for each split with its entry state and first line's number; a row for each document with its lines, whether its text ends with a line end, and the fence left open)."""

    def compose(splits: pd.DataFrame) -> pd.DataFrame:
        splits = splits.sort_values(["file", "block"])
        state, line, states, lines = "", 0, [], []
        for row in splits.itertuples():
            states.append(state)
            lines.append(line)
            state, line = after(state, row.idle, row.closes), line + row.n_lines
        if strict and state:
            raise ValueError("unterminated fence")
        return splits.assign(entry=states, first_line=lines, open=state, total=line)[["doc_id", "file", "block", "entry", "first_line", "open", "total", "returns", "bytes"]]

    composed = maps.groupBy("doc_id").applyInPandas(compose, "doc_id string, file string, block long, entry string, first_line long, open string, total long, returns boolean, bytes long")
    files = composed.groupBy("doc_id", "file").agg(F.sum("bytes").alias("bytes"), F.max(F.struct("block", "returns")).alias("last"), F.max("open").alias("open"), F.max("total").alias("total"))
    # Only the last file's end is the document's: each row of a file counts a line feed, which its last one may lack.
    ends = files.join(sizes, "file").groupBy("doc_id").agg(F.max(F.struct("file", ((F.col("bytes") == F.col("size")) | F.col("last.returns")).alias("ended"))).alias("f"), F.max("open").alias("open"), F.max("total").alias("total"))
    return composed.select("doc_id", "file", "block", "entry", "first_line"), ends.select("doc_id", "open", "total", F.col("f.ended").alias("ended"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """file, size of each file, by its metadata."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    return rows.groupBy("file").agg(F.max("size").alias("size"))


def visible_lines(rows: DataFrame, starts: DataFrame, tilde: bool) -> DataFrame:
    """doc_id, line_no, line, visible of the rows of all splits."""

    def fill(batches):
        known: tuple | None = None
        state, number = "", 0
        for key, part in _runs(batches):
            if key != known:
                known, state, number = key, part.column(3)[0].as_py(), part.column(4)[0].as_py()
            lines = part.column(6)
            seen = np.empty(len(lines), bool)
            at = 0
            for i, (run, opens, ends) in _events(lines, tilde):
                if not (ends and closes(run, state, tilde) if state else opens):
                    continue
                seen[at:i], seen[i] = not state, False
                at, state = i + 1, "" if state else run
            seen[at:] = not state
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.arange(number, number + len(lines))), lines, pa.array(seen)], ["doc_id", "line_no", "line", "visible"])
            number += len(lines)

    few = starts.count() <= MOST_BROADCAST
    placed = rows.withColumn("seq", F.monotonically_increasing_id()).join(F.broadcast(starts) if few else starts, ["doc_id", "file", "block"])
    # A split's rows are in one task, in their order.
    placed = (placed if few else placed.repartition("file", "block")).sortWithinPartitions("file", "block", "seq").select("doc_id", "file", "block", "entry", "first_line", "seq", "line")
    return placed.mapInArrow(fill, "doc_id string, line_no long, line string, visible boolean")


def split_lines(spark: SparkSession, path: str, parts: bool = False, tilde: bool = False, strict: bool = True) -> DataFrame:
    """doc_id, line_no from 0, line, visible: what lines of whole texts give, without a task that holds one. strict: a fence left open is an error.

    The maps of the splits are worked out at once and kept in the shared folder; the lines themselves are read when the result is.
    """
    keep = keeper(spark)
    rows = raw_lines(spark, path, parts)
    starts, ends = entries(keep("split_maps", split_maps(rows, tilde)), file_sizes(spark, path), strict)
    starts = keep("entries", starts)
    last = ends.where("ended").select("doc_id", F.col("total").alias("line_no"), F.lit("").alias("line"), (F.col("open") == "").alias("visible"))
    return visible_lines(rows, starts, tilde).unionByName(last)
