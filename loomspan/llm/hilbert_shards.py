"""Shards along a Hilbert curve, in DataFrame functions alone.

Several metadata dimensions are quantised to 2^bits levels each: a size by its logarithm, names by their CRC. The curve's index over the cells keeps near
cells near, so runs of it hold narrow ranges of every dimension, and a reader can skip shards by the ranges that `manifest` states. Documents are ordered by
curve index, CRC of the text and id, and the order is cut into runs.

The law is `rows`: shard = floor(rank * shards / rows), so counts are at most one apart whatever the sizes. The global rank needs no single task: rows without their texts are
dealt by ranges of the whole order, down to a row number, so a cell, and a group of equal texts, may hold a third of all rows.

Defined results: a null text has size 1 and CRC 0; null names are a level of their own; ties go by id, then null ids last, and equal rows are put side by
side in any order; an empty table gives an empty one; fewer rows than shards leave shards empty; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_total_order


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Index of a cell on the Hilbert curve through 2^bits cells a dimension (Skilling 2004)."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | (v ^ t) >> b & 1
    return out


@lru_cache
def curve(dimensions: int, bits: int) -> str:
    """The curve's index at each cell, as text that Spark folds to one literal."""
    cells = range(1 << dimensions * bits)
    mask = (1 << bits) - 1
    return ",".join(str(hilbert_index(tuple(c >> bits * (dimensions - 1 - d) & mask for d in range(dimensions)), bits)) for c in cells)


def log_level(value: Column, bits: int) -> Column:
    """Level of a positive number: its logarithm to the base 2, at most 2^bits - 1."""
    return F.least(F.floor(F.log2(F.greatest(value, F.lit(1)).cast("double"))), F.lit((1 << bits) - 1)).cast("int")


def name_level(value: Column, bits: int) -> Column:
    """Level of a name; level 0 for null."""
    return F.coalesce(F.pmod(F.crc32(F.encode(value, "UTF-8")), F.lit(1 << bits)), F.lit(0)).cast("int")


def hilbert_shards(docs: DataFrame, shards: int = 8, bits: int = 4) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row, with the levels of its dimensions and its curve index."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    rows = docs.select("doc_id", size.alias("size"), F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"), name_level(F.col("source"), bits).alias("source_level"), name_level(F.col("lang"), bits).alias("lang_level"))
    rows = rows.withColumn("size_level", log_level(F.col("size"), bits))
    cell = (F.col("source_level") * (1 << bits) + F.col("lang_level")) * (1 << bits) + F.col("size_level")
    table = F.split(F.lit(curve(3, bits)), ",").cast("array<int>")
    rows = cut(rows.withColumn("curve", F.get(table, cell)).withColumn("_row", F.monotonically_increasing_id()))
    total = max(1, rows.count())
    out = in_total_order(rows, ["curve", "text_crc32", F.col("doc_id").asc_nulls_last(), "_row"])
    shard = F.expr(f"cast(_rank * {shards} div {total} as int)")
    # A shard's first rank is the least r with floor(r * shards / total) = shard.
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return out.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve", "source_level", "lang_level", "size_level"
    )


def manifest(placed: DataFrame) -> DataFrame:
    """Rows, bytes and the range of each dimension in each shard, by which a reader skips files."""
    ranges = [f(c).alias(f"{name}_{c}") for c in ("curve", "source_level", "lang_level", "size_level") for name, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ranges)


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Documents as Parquet under shard=N, in slot order within a file. docs must have unique ids."""
    spark = docs.sparkSession
    at = placed.select(F.col("doc_id").alias("_id"), "shard", "slot")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = docs.join(at, docs["doc_id"].eqNullSafe(at["_id"])).drop("_id")
    out.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
