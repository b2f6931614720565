"""Benchmark decontamination by a broadcast hash set of test n-grams, in DataFrame functions alone.

Words are runs of digits, a-z (A-Z in lower case) and characters beyond ASCII. Each run of `width` words of a benchmark item is a window; an item of fewer words, but not none, is one
window. Windows become 64-bit hashes, which are put together from hashes of half their length (pairs, fours, eights), so that a text of n words costs about log2(width) * n hashes.
The benchmark's windows go to all executors in blocks of about `block_bytes`, by the sum of their sizes; a document's windows meet a block in the scan: first a table of bits,
so that only likely hits leave the document's array, then the hash set itself, and what is found is verified by its words there and then. So no text is shuffled: a row for each
document and each verified hit remains, combined by document before the shuffle. A benchmark of several blocks costs a scan for each.

Defined results: null texts have no words; an item without words has no window; a null item id hits words but is not listed or counted; items that share an id count once; rows that share a
doc_id are told apart by their texts, equal rows give a row each; an empty benchmark leaves every document clean; an empty table gives an empty one; other columns are not read by
`contamination`, and kept as they are by `decontaminated`.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_but, cut

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z are put in lower case: a word and what follows it up to the next, or what goes before the first.
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*|^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Bytes of a block of windows.
BLOCK_BYTES = 64 << 20

#: Bits, as a power of two, of the table that a window's hash has to pass before it is looked up: 64 for each window, 2^22 (512 kB, which every row takes along) at most. It steers cost, never results.
MOST_BITS = 22

#: Copies of a row that are made at a time.
TIMES = 4096


def words(text: Column) -> Column:
    """The words of a text; a null text has none. Texts of ASCII alone take the faster of two functions that agree on them."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _hashed(df: DataFrame, lengths: list[int]) -> DataFrame:
    """df (with words and n, their number) and for each length k the array w{k} of the hashes of its windows, from each word that begins one."""
    own = list(df.columns)
    pair = lambda x, y: F.xxhash64(x, y)
    df = df.withColumn("p1", F.transform("words", lambda x: F.xxhash64(x)))
    size = 1
    while size * 2 <= max(lengths):
        df = df.withColumn(f"p{size * 2}", F.zip_with(f"p{size}", F.slice(f"p{size}", size + 1, F.col("n")), pair))
        size *= 2
    for k in lengths:
        bits = [1 << b for b in reversed(range(k.bit_length())) if k >> b & 1]
        whole, at = F.col(f"p{bits[0]}"), bits[0]
        for b in bits[1:]:
            whole, at = F.zip_with(whole, F.slice(f"p{b}", at + 1, F.col("n")), pair), at + b
        df = df.withColumn(f"w{k}", F.slice(whole, 1, F.greatest(F.col("n") - (k - 1), F.lit(0))))
    return df.select(*own, *[f"w{k}" for k in lengths])


def benchmark_windows(benchmark: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, list[int]]:
    """(hash, found: the windows of that hash with their words joined by blanks and their items; lengths of windows, at most `width` numbers)."""
    items = benchmark.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("words")).withColumn("n", F.size("words")).where("n > 0")
    items = cut(items.withColumn("k", F.least("n", F.lit(width))))
    lengths = sorted((r["k"] for r in items.select("k").distinct().collect()), reverse=True)
    parts = []
    for k in lengths:
        each = _hashed(items.where(F.col("k") == k), [k]).select("item", "words", F.posexplode(f"w{k}").alias("at", "hash"))
        parts.append(each.select("item", "hash", F.array_join(F.slice("words", F.col("at") + 1, k), " ").alias("window")))
    if not parts:
        return items.select(F.lit(0).cast("long").alias("hash"), F.lit(None).cast(f"array<struct<window:string,items:array<{benchmark.schema[id_col].dataType.simpleString()}>>>").alias("found")), []
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    known = every.groupBy("hash", "window").agg(F.collect_set("item").alias("items"))
    return cut(known.groupBy("hash").agg(F.collect_list(F.struct("window", "items")).alias("found"))), lengths


def _slot(hash_: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hash_, 64 - bits)


def bitmap(windows: DataFrame, bits: int) -> DataFrame:
    """One row with an array of 2^bits / 64 longs that has the bits of the windows' hashes set."""
    slot = _slot(F.col("hash"), bits)
    set_ = windows.groupBy(F.shiftright(slot, 6).alias("id")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 as int))")).alias("own"))
    every = windows.sparkSession.range(1 << bits - 6).join(set_, "id", "left").agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("own", F.lit(0).cast("long")).alias("own")))).alias("all"))
    return every.select(F.col("all.own").alias("bits"))


def found_windows(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, h (hash of the text), n_words, times (rows that are equal), at (places of words that are hit, from 0), items (ids, sorted as strings): a row for each text of an id."""
    windows, lengths = benchmark_windows(benchmark, width)
    weigh = F.aggregate("found", F.lit(64).cast("long"), lambda n, w: n + F.octet_length(w["window"]) + 8 * F.size(w["items"]))
    count, weight = windows.agg(F.count(F.lit(1)), F.sum(weigh)).first()
    blocks = max(1, -(-(weight or 0) // block_bytes))
    bits = min(MOST_BITS, max(12, (64 * count // blocks).bit_length()))
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), words(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    scanned = (_hashed(texts, lengths) if lengths else texts).withColumn("every", F.concat(*[F.col(f"w{k}") for k in lengths]) if lengths else F.array().cast("array<bigint>"))

    def place(p: Column) -> Column:
        """start, k of a window: those of one length stand after those of the one before."""
        first, out = F.lit(0), None
        for k in lengths:
            own = F.struct((p - first).alias("start"), F.lit(k).alias("k"))
            first = first + F.greatest(F.col("n") - (k - 1), F.lit(0))
            out = F.when(p < first, own) if out is None else out.when(p < first, own)
        return F.struct(p.alias("start"), F.lit(1).alias("k")) if out is None else out

    def met(block: DataFrame, first: bool) -> DataFrame:
        """Verified hits of a block's windows; at first also a row for each document."""
        with_bits = scanned.withColumn("bits", bitmap(block, bits).scalar())
        may = lambda x: F.getbit(F.get("bits", F.shiftright(_slot(x, bits), 6).cast("int")), _slot(x, bits).bitwiseAND(F.lit(63))) == 1
        near = F.array_compact(F.transform("every", lambda x, p: F.when(may(x), F.struct(x.alias("hash"), place(p).alias("place")))))
        near = F.transform(near, lambda s: F.struct(s["hash"].alias("hash"), s["place"].alias("place"), F.array_join(F.slice("words", s["place"]["start"] + 1, s["place"]["k"]), " ").alias("window")))
        each = with_bits.select("doc_id", "h", "n", (F.posexplode_outer(near) if first else F.posexplode(near)).alias("i", "near")).select("doc_id", "h", "n", "i", "near.*")
        leads = F.coalesce(F.col("i"), F.lit(0)) == 0 if first else F.lit(False)
        same = F.filter("found", lambda w: w["window"] == F.col("window"))
        out = each.join(F.broadcast(block), "hash", "left" if first else "inner").withColumn("hit", F.get(F.when(F.col("found").isNotNull(), same), F.lit(0)))
        return out.where(leads | F.col("hit").isNotNull()).select("doc_id", "h", "n", leads.cast("long").alias("lead"), "place.start", "place.k", "hit")

    hits = met(windows.where(F.pmod("hash", F.lit(blocks)) == 0), True)
    for b in range(1, blocks):
        hits = hits.unionByName(met(windows.where(F.pmod("hash", F.lit(blocks)) == b), False))
    span = F.when(F.col("hit").isNotNull(), F.struct("start", "k"))
    grouped = hits.groupBy("doc_id", "h").agg(F.max("n").alias("n"), F.sum("lead").alias("times"), F.collect_set(span).alias("spans"), F.collect_set(F.col("hit.items")).alias("lists"))
    at = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["k"] - 1))))
    names = F.array_sort(F.transform(F.array_distinct(F.flatten("lists")), lambda i: i.cast("string")))
    return grouped.select("doc_id", "h", F.col("n").cast("long").alias("n_words"), "times", at.alias("at"), names.alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row."""
    rows = found_windows(docs, benchmark, width, block_bytes)
    hit = F.size("at").cast("long")
    out = rows.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), "times")
    # Rows that are equal come back one by one, a bounded number at a time.
    out = out.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / TIMES).cast("long"))))
    copies = F.least(F.col("times") - F.col("_part") * TIMES, F.lit(TIMES).cast("long")).cast("int")
    return out.select(*[c for c in out.columns if c not in ("times", "_part")], F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the words that benchmark windows hit, nor what follows them up to the next word ("spans"), or without the documents that have any ("documents")."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove must be spans or documents")
    leaks = cut(found_windows(docs, benchmark, width, block_bytes).where(F.size("at") > 0).select(F.col("doc_id").alias("i"), "h", "at"))
    rows = docs.select(F.struct(*columns_but(docs, "text")).alias("own"), "text")
    same = F.col("own.doc_id").eqNullSafe(F.col("i")) & (F.xxhash64("text") == F.col("h"))
    if remove == "documents":
        out, text = rows.join(leaks, same, "left_anti"), F.col("text")
    else:
        out = rows.join(leaks, same, "left").withColumn("pieces", F.when(F.col("i").isNotNull() | F.col("at").isNotNull(), F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))))
        # The place of the first word: 1 after a piece that holds none.
        lead = F.when(F.rlike(F.get("pieces", F.lit(0)), F.lit(r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")), 1).otherwise(0)
        out = out.withColumn("lead", lead)
        left = F.array_except(F.sequence(F.lit(0), F.size("pieces") - 1), F.transform("at", lambda i: i + F.col("lead")))
        text = F.when(F.col("at").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("pieces", i)), ""))
    return out.select(*[text.alias("text") if c == "text" else F.col("own")[c].alias(c) for c in docs.columns])
