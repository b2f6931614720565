"""Evidence documents and other texts: a committed single-file sink and a whole-file source."""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from loomspan.operators.render import in_order
from loomspan.storage import discard, file_system, scratch


#: A fragment that is an item's marker and nothing else. Bodies quote such lines in fences, within other fragments.
MARK = re.compile(rb"<!-- ITEM_(START|END) (issue|pull_request) (.*) -->")
INDEX = pa.schema([("kind", pa.string()), ("id", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


@dataclass
class Part(WriterCommitMessage):
    number: int
    name: str
    size: int


class DocumentWriter(DataSourceArrowWriter):
    """Each task writes its rows' texts to a part of its own, under a name that no other attempt has. The commit joins the parts that tasks have reported, by their partitions' order, to
    a new file beside the target, whose place it takes last; an abort removes what was written. Parts that lost or repeated tasks left go with their folder.

    Beside each part a task notes the items' markers and their places in it; the commit makes the document's index of them, which names the bytes of each item.
    """

    def __init__(self, path: str, parts: str):
        self.path, self.parts = path, parts

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, root = file_system(self.parts)
        fs.create_dir(root, recursive=True)
        number, size = TaskContext.get().partitionId(), 0
        name = f"part-{number:06d}-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out, fs.open_output_stream(f"{root}/{name}.marks", compression=None) as marks:
            for batch in iterator:
                places = size + np.concatenate([[0], np.cumsum(np.add(*(pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) for c in (0, 1))))])
                for i in np.flatnonzero(pc.starts_with(batch.column(1), "<!-- ITEM_").to_numpy(zero_copy_only=False)).tolist():
                    text = batch.column(1)[i].as_buffer().to_pybytes()
                    if (m := MARK.fullmatch(text)) is not None:
                        which, kind, id_ = (x.decode() for x in m.groups())
                        end = int(places[i + 1])
                        marks.write(json.dumps([kind, id_, end - len(text) if which == "START" else None, None if which == "START" else end + 1]).encode() + b"\n")
                for text in pc.binary_join_element_wise(batch.column(0), batch.column(1), ""):
                    size += out.write(text.as_buffer())
        return Part(number, name, size)

    def commit(self, messages: list[Part | None]) -> None:
        fs, root = file_system(self.parts)
        target = Path(self.path)
        target.parent.mkdir(parents=True, exist_ok=True)
        partial = target.with_name(f".{target.name}.{uuid.uuid4().hex}.partial")
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        try:
            with partial.open("wb", buffering=0) as out:
                for part in parts:
                    _append(out, fs, f"{root}/{part.name}", part.size)
            _write_index(fs, root, parts, partial, target)
            os.replace(partial, target)
        finally:
            partial.unlink(missing_ok=True)
            discard(self.parts)

    def abort(self, messages: list[Part | None]) -> None:
        discard(self.parts)


def index_path(path: str | Path) -> Path:
    return Path(path).with_name(f".{Path(path).name}.items")


def _write_index(fs: pafs.FileSystem, root: str, parts: list[Part], partial: Path, target: Path) -> None:
    """kind, id, start, end of each item whose markers the parts have, in the document's order; a start waits for its end, so few are held at a time."""
    stat = partial.stat()
    schema = INDEX.with_metadata({"size": str(stat.st_size), "mtime": str(stat.st_mtime_ns)})
    new, at, waiting, rows = index_path(target).with_suffix(".items-partial"), 0, {}, []
    with pq.ParquetWriter(new, schema) as out:
        for part in parts:
            with fs.open_input_stream(f"{root}/{part.name}.marks", compression=None) as marks:
                for line in marks.read().splitlines():
                    kind, id_, start, end = json.loads(line)
                    if start is not None:
                        waiting[kind, id_] = at + start
                    elif (kind, id_) in waiting:
                        rows.append({"kind": kind, "id": id_, "start": waiting.pop((kind, id_)), "end": at + end})
                    if len(rows) >= 10_000:
                        out.write_table(pa.Table.from_pylist(rows, schema))
                        rows = []
            at += part.size
        out.write_table(pa.Table.from_pylist(rows, schema))
    os.replace(new, index_path(target))


def indexed_item(spark: SparkSession, path: str | Path, kind: str, item_id: str) -> DataFrame | None:
    """doc_id and text of one item's block alone, read by its place in the index; None where there is no index of the document as it is, or no single such item in it. Views of the block are those of the document."""
    index, document = index_path(path), Path(path)
    if not index.exists():
        return None
    known, stat = pq.read_schema(index).metadata, document.stat()
    if (known[b"size"], known[b"mtime"]) != (str(stat.st_size).encode(), str(stat.st_mtime_ns).encode()):
        return None
    rows = pq.read_table(index, filters=[("kind", "=", kind), ("id", "=", item_id)]).to_pylist()
    if len(rows) != 1:
        return None
    with document.open("rb") as f:
        f.seek(rows[0]["start"])
        text = f.read(rows[0]["end"] - rows[0]["start"]).decode()
    return spark.createDataFrame([(document.resolve().as_uri(), re.sub("\r\n?", "\n", text))], "doc_id string, text string")


def _append(out, fs: pafs.FileSystem, path: str, size: int) -> None:
    """The file system copies a local part itself; others come in blocks."""
    if isinstance(fs, pafs.LocalFileSystem):
        with open(path, "rb") as part:
            left = size
            while left:
                left -= (done := os.copy_file_range(part.fileno(), out.fileno(), left))
                if not done:
                    raise OSError(f"{path} is shorter than its task has reported")
        return
    with fs.open_input_stream(path, compression=None) as part:
        shutil.copyfileobj(part, out, 8 << 20)


class TextDocument(DataSource):
    """Format text_document, for writing: two text columns, whose values are joined row by row in the order of the partitions; options path and parts, a folder that all executors share."""

    @classmethod
    def name(cls) -> str:
        return "text_document"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options["path"], self.options["parts"])


def write_document(rows: DataFrame, path: str | Path) -> int:
    """Ordered fragments as one UTF-8 file, and its bytes. Tasks write the parts of a range sort; no text passes through the driver's rows, and the file appears whole or not at all."""
    spark = rows.sparkSession
    spark.dataSource.register(TextDocument)
    in_order(rows).write.format("text_document").options(path=os.path.abspath(path), parts=scratch(spark, "document")).mode("append").save()
    return Path(path).stat().st_size


def read_texts(spark: SparkSession, path: str | Path) -> DataFrame:
    """doc_id (the file's address) and text, line ends made line feeds."""
    return spark.read.text(str(path), wholetext=True).select(F.input_file_name().alias("doc_id"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))
