"""Deterministic sharded WARC writer and its reader.

Records are range-sorted by id (equal ids by digest): exact sums of sizes give ranges of equal bytes and of bounded number, each task writes its range in order and rolls to a new file once the compressed
size passes a limit. Each record is a gzip member of its own with a fixed time stamp; record ids, lengths and digests are made anew from the payload, so that the same
rows give the same bytes. Files are written under temporary names. The tasks return manifest rows; the driver renames the files that they list and last puts
the manifest in place, by a rename too. Files of lost or repeated tasks are listed nowhere, and readers go by the manifest.

Of records with equal payloads (by SHA-1 and length) that with the smallest id is the response and the others revisit it. Those duplicates are found on
digests alone; they travel to the writer in the same shuffle as the pages, each just before its page.

Defined results: ids are integers; a null payload is empty and a payload like others; rows that share the smallest id of a payload are all responses; a null id is written
without one and takes part in no order; null addresses are left out, line ends and blanks in addresses are percent-encoded; an empty table gives an empty manifest and
no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MOST_RUNS, Runs, cut, file_system as _at

HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(data: bytes) -> bytes:
    """One gzip member without name or time."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha1:{_sha1(block)}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _address(url: str) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url)


def page_record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> tuple[str, bytes]:
    """(record type, bytes)."""
    digest = _sha1(payload)
    kind = "response" if refers_to is None else "revisit"
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{i}:{digest}')}>"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _address(url)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        headers += [("WARC-Refers-To", name(refers_to)), ("X-Refers-To-Page-ID", str(refers_to)), ("WARC-Profile", PROFILE)]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    head = HTTP.format(len(payload)).encode()
    return kind, _record(headers, head + (payload if refers_to is None else b""))


def write_warc(pages: DataFrame, out: str, roll_bytes: int = 1 << 30, date: str = "2024-01-01T00:00:00Z", least: int = 0, prefix: str = "pages") -> dict:
    """Archives of page_id, url, html under `out`, a folder that all executors and the driver share. Returns the manifest. least: payloads under that size are not deduplicated."""
    spark = pages.sparkSession
    fs, root = _at(out)
    fs.create_dir(f"{root}/tmp", recursive=True)
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha1("payload"))
    narrow = cut(rows.select("page_id", "digest", F.octet_length("payload").alias("n")))
    h = (F.conv(F.substring("digest", 1, 15), 16, 10).cast("long") - (1 << 59)) * 16  # in the order of digests; equal digests stay together, others spread evenly
    runs = Runs(narrow.select(F.col("page_id").alias("id"), h.alias("h"), (F.col("n") + 512).cast("long").alias("n")))
    known = narrow.where(F.col("page_id").isNotNull() & (F.col("n") >= least))
    # The minima are written first: a skewed partition of a join of plain tables gets split, so a payload may be a third of all.
    firsts = cut(known.groupBy("digest", "n").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first <> last").drop("last"))
    repeats = known.join(firsts, ["digest", "n"]).where("page_id <> first").select("page_id", "digest", "first").distinct()
    none = F.lit(None)
    both = rows.select("page_id", "url", "payload", "digest", none.cast(pages.schema["page_id"].dataType).alias("first"), F.lit(1).alias("kind"))
    both = both.unionByName(repeats.select("page_id", none.cast("string").alias("url"), none.cast("binary").alias("payload"), "digest", "first", F.lit(0).alias("kind")))
    both = both.withColumn("run", runs.of(F.col("page_id"), h)).repartitionById(runs.count, F.col("run"))
    both = both.sortWithinPartitions("run", F.col("page_id").asc_nulls_last(), "digest", "kind", "url").select("run", "page_id", "url", "payload", "digest", "first", "kind")

    def write(batches):
        fs, root = _at(out)
        done: list[tuple] = []
        now: dict = {"run": None, "file": None}

        def shut() -> None:
            if now["file"] is not None:
                now["file"].close()
                done.append((now["name"], now["temp"], now["records"], now["bytes"], now["sum"].hexdigest()))
                now["file"] = None

        def put(data: bytes) -> None:
            now["file"].write(data)
            now["sum"].update(data)
            now["bytes"] += len(data)

        known: tuple = (None, None, None)
        for batch in batches:
            for run, page_id, url, payload, digest, first, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run != now["run"]:
                    shut()
                    now |= {"run": run, "roll": 0}
                if kind == 0:
                    known = (page_id, digest, first)
                    continue
                if now["file"] is None:
                    name = f"{prefix}-{run:05d}-{now['roll']:05d}.warc.gz"
                    temp = f"tmp/{name}.{uuid.uuid4().hex}"
                    now |= {"name": name, "temp": temp, "records": 0, "bytes": 0, "sum": hashlib.sha1(), "roll": now["roll"] + 1}
                    now["file"] = fs.open_output_stream(f"{root}/{temp}", compression=None)
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"), ("WARC-Date", date), ("WARC-Filename", name)]
                    put(_member(_record([*info, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
                refers = known[2] if known[:2] == (page_id, digest) else None
                put(_member(page_record(page_id, url, payload, refers, date)[1]))
                now["records"] += 1
                if now["bytes"] >= roll_bytes:
                    shut()
        shut()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["name", "temp", "records", "bytes", "sha1"])

    found = both.mapInArrow(write, "name string, temp string, records long, bytes long, sha1 string").collect()  # a row for each file
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda r: fs.move(f"{root}/{r['temp']}", f"{root}/{r['name']}"), found))
    manifest = {"files": sorted(({k: r[k] for k in ("name", "records", "bytes", "sha1")} for r in found), key=lambda x: x["name"])}
    with fs.open_output_stream(f"{root}/tmp/manifest.json") as f:
        f.write(json.dumps(manifest, indent=1).encode())
    fs.move(f"{root}/tmp/manifest.json", f"{root}/manifest.json")
    fs.delete_dir(f"{root}/tmp")
    return manifest


def records(data) -> tuple[dict[str, str], bytes]:
    """(headers, block) of each record of a stream of gzip members."""
    z, parts = zlib.decompressobj(31), []
    while True:
        chunk = z.unused_data or data.read(1 << 16)
        if z.eof:
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            n = int(headers["Content-Length"])
            if not head.startswith(b"WARC/1.") or rest[n:] != b"\r\n\r\n":
                raise ValueError("not a WARC record")
            yield headers, rest[:n]
            if not chunk:
                return
            z, parts = zlib.decompressobj(31), []
        elif not chunk:
            if any(parts):
                raise ValueError("a record breaks off")
            return
        parts.append(z.decompress(chunk))


def read_warc(spark: SparkSession, out: str) -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to of the records that the manifest lists; digests and lengths are checked."""
    fs, root = _at(out)
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        names = [x["name"] for x in json.loads(f.read())["files"]]
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if not names:
        return spark.createDataFrame([], schema)

    def read(batches):
        fs, root = _at(out)
        columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for name in batch.column(1).to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for h, block in records(f):
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        digest, n = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                        payload = block.partition(b"\r\n\r\n")[2] if h["WARC-Type"] == "response" else None
                        if payload is not None and (len(payload) != n or _sha1(payload) != digest):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        number = lambda k, h=h: int(h[k]) if k in h else None
                        rows.append((number("X-Page-ID"), h.get("WARC-Target-URI"), payload, n, digest, h["WARC-Type"], number("X-Refers-To-Page-ID")))
                        held += n
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], columns)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], columns)

    tasks = min(len(names), MOST_RUNS)
    files = spark.createDataFrame([(k % tasks, name) for k, name in enumerate(names)], "task int, name string").repartitionById(tasks, F.col("task"))
    return files.mapInArrow(read, schema)
