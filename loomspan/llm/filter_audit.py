"""Interaction of quality filters: what each removes in every order of application, what it would remove alone, and its share over all orders.

Each document's failures become a mask of five bits. Four of them depend on its text alone; the fifth says whether a smaller id holds the same text. For that, texts are routed by their xxhash
fingerprint: before the shuffle each task keeps chains of texts by fingerprint with the least id so far (in bounded memory; texts that repeat are kept longest), so that a text sends
about one row from each task however many copies it has, and those that are not least go on without their text. Routed rows are sorted by fingerprint and id; within a fingerprint a collision chain
holds the full texts with their least id, and every id above it fails. Then `combineByKey` merges, for each part of the table, count vectors of the 32 masks (documents,
good ones, toxic ones), and every order's steps are read off the 32 counts.

Defined results: a null text is empty, and empty texts are equal; a null part is the empty string; a null id has no smaller id and is smaller than none, so it never counts as a copy; rows
that share an id and a text are copies of none of each other; a document is good (toxic) if any of its label rows says so, null labels say nothing; an empty table has no parts and no rows;
other columns are not read. Texts are compared whole, so equal fingerprints of different texts do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, slices

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MASKS = 1 << len(FILTERS)

#: Bytes of texts that a task keeps to combine copies before the shuffle.
HELD_BYTES = 16 << 20

#: Files of the vectors.
FILES = 16

_UPPER = bytes(range(65, 91))
_SIGNS = b"#$%&*|"


def failures(text: str) -> int:
    """The filters A to D that a text fails, as bits: under 100 words; under 80 % distinct words; over 10 % of A-Z; any of the signs."""
    data = text.encode()
    words = data.split()
    n, holds = len(words), lambda chars: len(data) - len(data.translate(None, chars))
    return (n < 100) | (100 * len(set(words)) < 80 * n) << 1 | (100 * holds(_UPPER) > 10 * len(text)) << 2 | (holds(_SIGNS) > 0) << 3


def fingerprint(data: str) -> int:
    """Signed, as a long."""
    h = xxhash.xxh3_64_intdigest(data)
    return h - (1 << 64) if h >> 63 else h


class Chains:
    """Texts by fingerprint with their least id: what a task knows of copies. Rows are (fingerprint, id, part, mask, number of equal rows, text or None)."""

    def __init__(self, most: int, hashed: Callable[[str], int] = fingerprint):
        self.most, self.hashed, self.held = most, hashed, 0
        self.chains: dict[int, dict[str, list]] = {}

    def add(self, id_, part: str, text: str) -> Iterator[tuple]:
        h = self.hashed(text)
        chain = self.chains.setdefault(h, {})
        known = chain.get(text)
        if known is None:
            chain[text] = [id_, failures(text), {part: 1}, False]
            self.held += len(text) + 200
            if self.held > self.most:
                yield from self.flush(self.most // 2)
            return
        least, mask, parts, _ = known
        known[3] = True
        if id_ > least:
            yield (fingerprint(str(id_)), id_, part, mask | COPY, 1, None)
        elif id_ == least:
            parts[part] = parts.get(part, 0) + 1
        else:
            for p, n in parts.items():
                yield (fingerprint(str(least)), least, p, mask | COPY, n, None)
            known[0], known[2] = id_, {part: 1}

    def flush(self, keep: int = 0) -> Iterator[tuple]:
        """Rows of the least ids. Of the texts that were repeated, up to `keep` characters stay known, so that later copies go on without their text."""
        left: dict[int, dict[str, list]] = {}
        self.held = 0
        for h, chain in self.chains.items():
            for text, (least, mask, parts, repeated) in chain.items():
                for p, n in parts.items():
                    yield (h, least, p, mask, n, text)
                if repeated and self.held + len(text) < keep:
                    left.setdefault(h, {})[text] = [least, mask, {}, False]
                    self.held += len(text) + 200
        self.chains = left


def masks(docs: DataFrame, part: str = "lang", held_bytes: int = HELD_BYTES, hashed: Callable[[str], int] = fingerprint) -> DataFrame:
    """doc_id, part, mask, n: how many rows of an id fail just these filters."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType
    fields = [T.StructField("h", T.LongType()), T.StructField("doc_id", id_type), T.StructField("part", T.StringType()), T.StructField("mask", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("text", T.StringType())]

    def assess(batches):
        chains = Chains(held_bytes, hashed)
        kinds: list = []

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.name for f in fields])

        for batch in batches:
            kinds = [pa.int64(), batch.schema.field(0).type, pa.string(), pa.int32(), pa.int64(), pa.string()]
            for first, texts in slices(batch):
                ids, parts = (batch.column(i).slice(first, len(texts)).to_pylist() for i in (0, 1))
                rows: list[tuple] = []
                for i, p, text in zip(ids, parts, texts, strict=True):
                    if i is None:
                        rows.append((fingerprint(text), None, p, failures(text), 1, None))
                    else:
                        rows += chains.add(i, p, text)
                if rows:
                    yield packed(rows)
        rows, size = [], 0
        for row in chains.flush():
            rows.append(row)
            size += len(row[5])
            if size > 1 << 20:
                yield packed(rows)
                rows, size = [], 0
        if rows:
            yield packed(rows)

    def resolve(batches):
        h, chain = None, {}
        for batch in batches:  # in the order of fingerprints, then ids
            marks, masks = batch.column(0).to_numpy(), batch.column(3).to_numpy().copy()
            for first, texts in slices(batch):
                ids, given = batch.column(1).slice(first, len(texts)).to_pylist(), batch.column(5).slice(first, len(texts)).is_valid().to_pylist()
                for k, (i, text, there) in enumerate(zip(ids, texts, given, strict=True), first):
                    if not there:
                        continue
                    if marks[k] != h:
                        h, chain = marks[k], {}
                    if chain.setdefault(text, i) < i:
                        masks[k] |= COPY
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(masks), batch.column(4)], [f.name for f in fields[1:5]])

    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text").mapInArrow(assess, T.StructType(fields))
    routed = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "h").sortWithinPartitions("h", "doc_id")
    return routed.mapInArrow(resolve, T.StructType(fields[1:5]))


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang"):
    """RDD of (part, array of 3 x 32 counts): documents, good and toxic ones of each mask."""
    # Rows of an id are added up before the join, so that an id of very many rows is no hot key.
    rows = masks(docs, part).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    says = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(says("quality"), says("toxic"))
    flagged = rows.join(known, "doc_id", "left").select("part", "mask", "n", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))

    def count(batches):
        vectors: dict[str, np.ndarray] = {}
        for batch in batches:
            mask, n, good, toxic = (batch.column(c).to_numpy().astype(np.int64) for c in range(1, 5))
            parts = batch.column(0).dictionary_encode()
            own = parts.indices.to_numpy()
            for k, name in enumerate(parts.dictionary.to_pylist()):
                at = own == k
                vector = vectors.setdefault(name, np.zeros((3, MASKS), np.int64))
                for row, times in enumerate((1, good[at], toxic[at])):
                    np.add.at(vector[row], mask[at], n[at] * times)
        for name, vector in vectors.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([vector.reshape(-1).tolist()], pa.list_(pa.int64()))], ["part", "counts"])

    # A vector for each task and part, gathered in few files, so that what follows doesn't read the texts anew.
    vectors = cut(flagged.mapInArrow(count, "part string, counts array<long>").repartition(FILES))
    pairs = vectors.rdd.map(lambda r: (r.part, np.array(r.counts, np.int64).reshape(3, MASKS)))
    return pairs.combineByKey(lambda v: v, lambda a, b: a + b, lambda a, b: a + b, FILES)


def steps(counts: np.ndarray) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order's steps, from a part's 3 x 32 counts."""
    mask = np.arange(MASKS)
    out: list[tuple] = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            fails, earlier = mask & bit != 0, mask & before != 0
            removed, good, toxic = counts[:, fails & ~earlier].sum(axis=1).tolist()
            kept = int(counts[0, ~fails & ~earlier].sum())
            out.append(("".join(order), step, name, kept, removed, int(counts[0, fails & earlier].sum()), int(counts[0, bit]), good, toxic))
            before |= bit
    shares = {name: sum(x[4] for x in out if x[2] == name) for name in FILTERS}
    return [(*x[:2], *x[3:], shares[x[2]]) for x in out]


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: a row for each part, order and step."""
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    rows = mask_counts(docs, labels, part).flatMap(lambda x: [(x[0], *row) for row in steps(x[1])])
    return docs.sparkSession.createDataFrame(rows, schema, verifySchema=False)
