"""Removal of repeated passages by overlapping windows of three lines, in DataFrame functions alone.

Lines are hashed; each run of `width` consecutive lines of a text (split at line feeds) is a window with a 128-bit key. Of the windows with equal keys, the
one with the smallest (doc_id, position) is the first occurrence and stays; each later one covers its lines. Covered positions are merged to intervals and
their lines removed. Line hashes alone are shuffled, once by key (partial aggregation merges frequent windows before the shuffle), and texts once by doc_id and hash;
documents without later windows take no part in anything but the last join.

Defined results: a null text stays null and has 0 lines; texts of fewer than `width` lines, and windows of blank lines alone, are left as they are; a text whose
lines are all covered becomes empty; rows that share a doc_id count as one document's copies: windows at the same place of equal ids are one occurrence, so
exact repeats of a row stay alike; where different texts share an id, each loses the lines that its own windows cover; null ids come last, in the order of their
texts' hashes, and equal texts with null ids are copies likewise; an empty table gives an empty one; extra columns are kept, but for those named n_lines and n_removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_but, cut


def _windows(text: Column, width: int) -> Column:
    """Array of (a, b): the keys of the windows; null where a window is blank."""
    lines = F.split(text, "\n")
    hashes = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.trim(x) != "").alias("own")))
    n = F.greatest(F.size(lines) - (width - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice(hashes, F.lit(i + 1), n).alias(f"l{i}") for i in range(width)])

    def key(w: Column) -> Column:
        parts = [w[f"l{i}"] for i in range(width)]
        own = parts[0]["own"]
        for p in parts[1:]:
            own = own | p["own"]
        return F.when(own, F.struct(F.xxhash64(*[p["a"] for p in parts]).alias("a"), F.xxhash64(F.lit(1), *[p["b"] for p in parts]).alias("b")))

    return F.transform(zipped, key)


def repeated_spans(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, h (hash of the text), spans: the merged intervals (first, last line, from 0) that later windows cover; a row for each text of a document that has any."""
    windows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.posexplode(_windows(F.col("text"), width)).alias("pos", "key")).where("key is not null")
    windows = cut(windows.select("doc_id", "h", "pos", F.col("key.a").alias("a"), F.col("key.b").alias("b")))
    none = F.col("doc_id").isNull()
    place = F.struct(none.alias("none"), F.col("doc_id"), F.when(none, F.col("h")).alias("h"), F.col("pos"))
    firsts = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("other")).where("first <> other")
    # Both sides of the join are plain tables, so that a passage on very many documents is a skewed partition that gets split; beside an aggregate it would not be.
    later = windows.join(cut(firsts.select("a", "b", "first")), ["a", "b"]).where(place != F.col("first"))
    places = later.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    # A span begins where no covered window reaches the line before it, and ends likewise.
    begins = F.filter("at", lambda p, i: (i == 0) | (F.get("at", i - 1) + width < p))
    ends = F.filter("at", lambda p, i: (i == F.size("at") - 1) | (F.get("at", i + 1) > p + width))
    spans = F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("first"), (e + (width - 1)).alias("last")))
    return places.select("doc_id", "h", spans.alias("spans"))


def line_dedup(docs: DataFrame, width: int = 3) -> DataFrame:
    """docs with the repeated lines removed from `text`, then n_lines and n_removed (which take the place of columns of docs of these names)."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    out = deduped(docs, width)
    return out.select(*[F.col("text") if c == "text" else F.col("own")[c].alias(c) for c in names], "n_lines", "n_removed")


def deduped(docs: DataFrame, width: int = 3) -> DataFrame:
    """own (a struct of docs' columns but text), text without the repeated lines, n_lines, n_removed."""
    spans = repeated_spans(docs.select("doc_id", "text"), width).withColumnRenamed("doc_id", "i")
    rows = docs.select(F.struct(*columns_but(docs, "text")).alias("own"), "text")
    joined = rows.join(spans, F.col("own.doc_id").eqNullSafe(F.col("i")) & (F.xxhash64("text") == F.col("h")), "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.exists("spans", lambda s: (i >= s["first"]) & (i <= s["last"])))
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + (s["last"] - s["first"] + 1))
    return joined.select(
        "own",
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
    )
