"""A service's answers from a recording: what a search and child lists would give, from Parquet that Spark wrote.

A recording has found/ (kind, updated_at, number, raw; by kind and month) and lists/ (path, ordinal, updated_at, raw, fails_at, item; by bucket of the item whose list it is, in order of item, path
and ordinal, in small row groups). The address of a service that is answered so begins with the recording's folder; transport: loomspan.sources.recorded:answer.

A process that answers holds the row groups of few items: who asks for items by bucket and in order of item_name reads each row group about once.
"""

from __future__ import annotations

import json
import urllib.parse
import zlib
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.sources.rest import Answer
from loomspan.storage import file_system

BUCKETS = 64
GROUP_ROWS = 20_000
TRANSPORT = "loomspan.sources.recorded:answer"


def record(folder: str, found: DataFrame | None = None, lists: DataFrame | None = None) -> None:
    """Adds to a recording; updated_at is an ISO time to the second, in UTC."""
    if found is not None:
        found.withColumn("month", F.substring("updated_at", 1, 7)).repartition("kind", "month").write.mode("append").partitionBy("kind", "month").parquet(f"{folder}/found")
    if lists is not None:
        part = F.split("path", "/")
        rows = lists.withColumn("item", item_name(F.get(part, 2), F.get(part, 3), F.get(part, 5)))
        rows = rows.withColumn("bucket", bucket_of(F.col("item"))).repartitionById(BUCKETS, F.col("bucket")).sortWithinPartitions("bucket", "item", "path", "ordinal")
        rows.write.option("parquet.block.row.count.limit", GROUP_ROWS).partitionBy("bucket").parquet(f"{folder}/lists")


def item_name(*parts: Column) -> Column:
    """owner/name/number: the item that a list belongs to, so that its lists lie together."""
    return F.concat_ws("/", *parts)


def bucket_of(item: Column) -> Column:
    return (F.crc32(item) % BUCKETS).cast("int")


def _table(folder: str) -> ds.Dataset:
    fs, root = file_system(folder)
    return ds.dataset(root, filesystem=fs, partitioning="hive")


def _found(folder: str, kind: str, first: str, last: str) -> list[str]:
    """Items of the days or times, the latest first, as the recording now is."""
    table = _table(f"{folder}/found")
    return _found_in(table, tuple(table.files), kind, first, last)


@lru_cache(2)
def _found_in(table: ds.Dataset, files: tuple[str, ...], kind: str, first: str, last: str) -> list[str]:
    kept = (ds.field("kind") == kind) & (ds.field("month") >= first[:7]) & (ds.field("month") <= last[:7])
    rows = table.to_table(["updated_at", "number", "raw"], filter=kept).to_pylist()
    rows = [r for r in rows if first <= r["updated_at"] and r["updated_at"][: len(last)] <= last]
    return [r["raw"] for r in sorted(rows, key=lambda r: (r["updated_at"], r["number"]), reverse=True)]


@lru_cache(BUCKETS)
def _groups(folder: str, bucket: int) -> list[tuple[str, int, str, str]]:
    """(file, row group, its least and greatest item) of a bucket."""
    fs, root = file_system(f"{folder}/lists/bucket={bucket}")
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet")]
    out = []
    for file in sorted(files):
        footer = pq.read_metadata(file, filesystem=fs)
        at = footer.schema.names.index("item")
        stats = [footer.row_group(k).column(at).statistics for k in range(footer.num_row_groups)]
        out += [(file, k, s.min, s.max) for k, s in enumerate(stats)]
    return out


@lru_cache(2)
def _group(folder: str, file: str, number: int) -> pa.Table:
    fs, _ = file_system(folder)
    return pq.ParquetFile(file, filesystem=fs).read_row_group(number, ["path", "ordinal", "updated_at", "raw", "fails_at"])


@lru_cache(4)
def _list(folder: str, path: str) -> pa.Table | None:
    """A list's rows by ordinal. It is held as Arrow, whole, as is the list of the client that asks for it."""
    parts = path.split("/")
    item = "/".join(parts[2:4] + parts[5:6])
    found = [_group(folder, file, k) for file, k, least, most in _groups(folder, zlib.crc32(item.encode()) % BUCKETS) if least <= item <= most]
    return pa.concat_tables(t.filter(pc.equal(t["path"], path)) for t in found).sort_by("ordinal") if found else None


def answer(url: str, headers: dict[str, str], timeout: float) -> Answer:
    """A page of what was recorded. A list whose rows say fails_at fails at that page."""
    place, _, query = url.partition("?")
    asked = dict(urllib.parse.parse_qsl(query))
    page, size = int(asked.get("page", 1)), int(asked.get("per_page", 100))
    if place.endswith("/search/issues"):
        words = dict(w.split(":", 1) for w in asked["q"].split())
        first, _, last = words["updated"].partition("..")
        rows = _found(place.removesuffix("/search/issues"), words["is"], first, last)
        items = [json.loads(r) for r in rows[(page - 1) * size : page * size]]
        return Answer(200, {}, json.dumps({"total_count": len(rows), "incomplete_results": False, "items": items}))
    folder, _, path = place.partition("/repos/")
    path = "/repos/" + path
    rows = _list(folder, path)
    if rows is None:
        return Answer(200, {}, "[]")
    if "since" in asked:
        rows = rows.filter(pc.greater_equal(rows["updated_at"], asked["since"]))
    if pc.any(pc.equal(rows["fails_at"], page)).as_py():
        return Answer(404, {}, '{"message": "gone"}')
    link = {"link": '<next>; rel="next"'} if len(rows) > page * size else {}
    return Answer(200, link, "[" + ", ".join(rows["raw"].slice((page - 1) * size, size).to_pylist()) + "]")
