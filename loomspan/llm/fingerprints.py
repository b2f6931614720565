"""Fingerprints by one-permutation MinHash with optimal densification.

Each shingle is hashed once; the top bits choose its bin, and a bin keeps its least hash. An empty bin copies a bin that a 2-universal sequence of its own
leads to (the first that is not empty), so that equal sets give equal bins. The low-order bits of the bins are packed to the fingerprint; as unequal bins
agree on b bits by chance once in 2^b, the likeness of two fingerprints is (agreement - 2^-b) / (1 - 2^-b), at least 0.

Texts are dealt once, in runs of ascending ids (some 64 MB each, more where there would be over 15,000), so that each meets the next one; a run's last text meets a copy of the next run's first, and the last run's that of the first.

Defined results: ids are integers; a null text is empty; an empty text has an empty fingerprint, with likeness 1 to its equal and 0 to others; ties in the id go by a hash of
the text, null ids come last; a single document is its own next; repeated rows give a row each; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Runs, cut
from .shingles import mixed, shingle_hashes

BINS, BITS = 512, 4
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)


def _probes(bins: int, tries: int) -> np.ndarray:
    i = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(tries) + np.arange(tries, dtype=np.uint64)
    return (mixed(i + np.uint64(0x5851F42D4C957F2D)) % np.uint64(bins)).astype(np.int64)


_PROBES = _probes(BINS, 4096)


def bins_of(hashes: np.ndarray) -> np.ndarray:
    """The densified bins of a set of hashes that is not empty."""
    h = np.sort(hashes)
    at = (h >> _SHIFT).astype(np.int64)
    first = np.concatenate([[True], at[1:] != at[:-1]])
    out = np.zeros(BINS, np.uint64)
    out[at[first]] = h[first]
    full = np.zeros(BINS, bool)
    full[at[first]] = True
    empty = np.flatnonzero(~full)
    source, begin, step = out.copy(), 0, 16
    while len(empty) and begin < _PROBES.shape[1]:
        tried = _PROBES[empty, begin : begin + step]
        hit = full[tried]
        found = hit.any(axis=1)
        out[empty[found]] = source[tried[found, hit[found].argmax(axis=1)]]
        empty, begin, step = empty[~found], begin + step, step * 4
    if len(empty):  # the next full bin, round the circle
        places = np.flatnonzero(full)
        out[empty] = source[places[np.searchsorted(places, empty) % len(places)]]
    return out


def fingerprint(text: str | None) -> bytes:
    """Packed low-order bits; empty for a text without words."""
    h = shingle_hashes(text)
    if not len(h):
        return b""
    low = (bins_of(h) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return (low[::2] << 4 | low[1::2]).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Bias-corrected estimate of the Jaccard similarity."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    agree = float(np.count_nonzero(x & 15 == 0) + np.count_nonzero(x >> 4 == 0)) / BINS
    chance = 2.0**-BITS
    return max(0.0, (agree - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points gives way to the first as many of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next."""
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    sizes = cut(docs.select("id", "h", (F.octet_length("text") + 64).cast("long").alias("n")))
    runs = Runs(sizes)
    run = runs.of(F.col("id"), F.col("h"))
    none = F.col("id").isNull()
    # A row for each run: its first text, which is a guest of the run before. Runs are bounded in number, so these rows may be broadcast.
    firsts = sizes.select("id", "h", run.alias("run")).groupBy("run").agg(F.min(F.struct(none.alias("none"), "id", "h")).alias("first"))
    firsts = firsts.select(F.col("run").alias("of"), F.col("first.id").alias("first_id"), F.col("first.h").alias("first_h"))
    first = (F.col("run") == F.col("of")) & F.col("id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h"))
    rows = docs.withColumn("run", run).join(F.broadcast(firsts), first, "left")
    place = lambda r, guest: F.struct(r.cast("int").alias("run"), F.lit(guest).alias("guest"))
    host = F.pmod(F.col("run") - 1, F.lit(runs.count))
    places = F.when(F.col("of").isNull(), F.array(place(F.col("run"), 0))).otherwise(F.array(place(F.col("run"), 0), place(host, 1)))
    rows = rows.select("id", "text", "h", F.explode(places).alias("place")).select("id", "text", "h", "place.*")
    placed = rows.repartitionById(runs.count, F.col("run")).sortWithinPartitions("run", "guest", F.col("id").asc_nulls_last(), "h", "text")
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compute(batches):
        last: tuple | None = None  # the text that waits for its next one
        rows: list[tuple] = []

        def close(following: str, print_: bytes) -> None:
            i, text, own = last
            new = edited(text, following)
            other = own if new == text else fingerprint(new)
            rows.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), own.hex(), other.hex(), likeness(own, other), likeness(own, print_)))

        def take():
            columns = list(zip(*rows, strict=True))
            rows.clear()
            kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, text, guest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if guest and last is None:  # equal rows are guests together
                    continue
                own = fingerprint(text)
                if last is not None:
                    close(text, own)
                last = None if guest else (i, text, own)
                if len(rows) >= 2000:
                    yield take()
        if rows:
            yield take()

    fields = [T.StructField(id_col, docs.schema["id"].dataType), T.StructField("n_chars", T.LongType())]
    fields += [T.StructField(n, T.StringType()) for n in names[2:5]] + [T.StructField(n, T.DoubleType()) for n in names[5:]]
    return placed.select("id", "text", "guest").mapInArrow(compute, T.StructType(fields))
