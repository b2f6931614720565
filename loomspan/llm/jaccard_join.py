"""Exact self-join of documents by the Jaccard similarity of their word shingles, with a token-group matrix.

Documents with equal shingle sets (by a 128-bit hash) are one class. A class is named by the first 64 bits of its hash; the few classes that share these go by the others, and all names are
checked to be distinct. Links between classes are found so that none is lost:

1. *Order.* Any fixed order of shingles allows prefix filtering: two sets that link share one of the first n - ceil(0.75 n) + 1 of each. Rare ones come first, by
   counts over all documents in a table of 2^20 hashed cells (4 MB whatever the input), so common passages stay out of prefixes unless a text is little else.
2. *Tokens.* Prefix tokens are dealt to parts as packed arrays and sorted there. A token that 2 to 8 classes hold gives their pairs, with counts. A token of more
   classes is a large one: it gives each class a candidate leader.
3. *Groups.* Classes that link with a leader, verified on their sets, form its group: similar documents, connected through the leader. The other classes of large
   tokens form loose groups by the leader that they share most tokens with and by size.
4. *Matrix.* Large tokens then name groups, not documents. For a class and each group the number of its prefix tokens that the group's members hold bounds the overlap
   with any member; where that bound, with the group's range of sizes, is below what a link takes, the group stays closed. Members of a connected group need no comparison.
5. *Opening.* Qualifying groups are cut to blocks of bounded number of members and of tokens. A block's union of tokens bounds the query's overlap once more; only then is the
   query compared with its members, with one link for each of the block's known components. Queries stream past blocks, so no task holds an unbounded group.

Components of classes come from the links and the leaders' links by distributed label passing; each is named by the least id of its rows at the end.

Defined results: ids are of any type that has an order; a null text or one without words has an empty set, 0 shingles, no link, and is its own component; repeated rows (and rows that share an id) give a
row each; rows that share an id are in the components of their own texts, as an id is no link; rows with null ids link like others but have no id to give, so a
component of null ids alone is named null; ties need no rule, as sets are unordered; an empty table gives an empty one; other columns are not read; texts are read whole.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, slices
from .components import components
from .shingles import shingle_set

CELL_BITS = 20
BLOCK_CELLS = 4096
#: A token of more classes than this names groups instead of pairs.
SMALL = 8
#: Prefix tokens that a part is sized for, members of a block, queries of a chunk.
PART_TOKENS, BLOCK, CHUNK = 1 << 21, 256, 512
#: Tokens of a block's members (16 MB; a single larger set is a block too).
BLOCK_TOKENS = 1 << 21


def least_overlap(n: int, share: int) -> int:
    """Overlap that any link of a set of n takes."""
    return -(-share * n // 100)


def _keys(tokens: np.ndarray, key_bits: int) -> tuple[int, int]:
    h = xxhash.xxh3_128_digest(tokens.tobytes())
    a, b = np.frombuffer(h, np.int64).tolist()
    return a >> (64 - key_bits), b


@dataclass(frozen=True)
class Names:
    """How a class is named: by a, unless several classes have it."""

    key_bits: int
    twins: frozenset[int]
    seed: int

    def of(self, tokens: np.ndarray) -> int:
        a, b = _keys(tokens, self.key_bits)
        return b ^ self.seed if a in self.twins else a


def _named(classes: DataFrame, key_bits: int) -> tuple[DataFrame, Names]:
    """classes with id, and the rule behind it.

    Of N classes N^2 / 2^65 pairs share 64 bits: two among 10^10, so the twins that reach the driver are a handful.
    """
    twins = frozenset(r["a"] for r in classes.groupBy("a").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("a").collect())
    if not twins:
        return classes.withColumn("id", F.col("a")), Names(key_bits, twins, 0)
    for seed in range(1, 100):
        named = classes.withColumn("id", F.when(F.col("a").isin(list(twins)), F.col("b").bitwiseXOR(F.lit(seed).cast("long"))).otherwise(F.col("a")))
        if named.groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").isEmpty():
            return cut(named), Names(key_bits, twins, seed)
    raise ValueError("no seed tells all classes apart")


def _classes(docs: DataFrame, key_bits: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, r, n, a, b of each row; counts of cells)."""

    def scan(batches):
        counts = np.zeros(1 << CELL_BITS, np.int64)
        seen: set[int] = set()
        names = ["kind", "doc_id", "r", "n", "a", "b", "data"]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for first, texts in slices(batch):
                sizes, a, b, new = [], [], [], []
                for text in texts:
                    tokens = shingle_set(text)
                    x, y = _keys(tokens, key_bits)
                    sizes.append(len(tokens))
                    a.append(x)
                    b.append(y)
                    if x not in seen:
                        seen.add(x)
                        new.append(tokens)
                if new:
                    counts += np.bincount((np.concatenate(new) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(counts))
                k = len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int32)), batch.column(0).slice(first, k), batch.column(2).slice(first, k), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(k, pa.binary())], names)
        if counts.any():
            blocks = counts.reshape(-1, BLOCK_CELLS)
            k = len(blocks)
            zero = pa.array(np.zeros(k, np.int64))
            data = pa.array([zlib.compress(x.tobytes(), 1) for x in blocks], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), pa.nulls(k, id_type), zero, pa.array(np.arange(k)), zero, zero, data], names)

    fields = [T.StructField("kind", T.IntegerType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in ("r", "n", "a", "b")), T.StructField("data", T.BinaryType())]
    both = cut(docs.mapInArrow(scan, T.StructType(fields)))
    total = _summed(both.where("kind = 1").select(F.col("n").cast("int").alias("block"), "data"), np.add)
    return both.where("kind = 0").select("doc_id", "r", "n", "a", "b"), _whole(total, 1 << CELL_BITS, BLOCK_CELLS, np.int64)


def _summed(blocks: DataFrame, join: np.ufunc) -> DataFrame:
    """One row for each block, its rows joined as they stream by."""

    def run(batches):
        held: dict = {"block": None, "sum": None}
        names = ["block", "data"]
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(data), np.int64)
                if block != held["block"]:
                    if held["block"] is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([held["block"]], pa.int32()), pa.array([zlib.compress(held["sum"].tobytes(), 1)], pa.binary())], names)
                    held = {"block": block, "sum": own.copy()}
                else:
                    held["sum"] = join(held["sum"], own)
        if held["block"] is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held["block"]], pa.int32()), pa.array([zlib.compress(held["sum"].tobytes(), 1)], pa.binary())], names)

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block int, data binary")


def _whole(blocks: DataFrame, size: int, step: int, kind) -> np.ndarray:
    """An array of fixed size on the driver."""
    out = np.zeros(size, kind)
    for r in blocks.collect():
        out[r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(zlib.decompress(r["data"]), kind)
    return out


def _in_order(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return tokens[np.lexsort((tokens, counts[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)]))]


def _prefixes(docs: DataFrame, counts: np.ndarray, names: Names, share: int, parts: int) -> DataFrame:
    """part, data: packed (token, class, set size) of prefix tokens, each class once a task."""
    shared = docs.sparkSession.sparkContext.broadcast((counts.astype(np.int32) if counts.max(initial=0) < 1 << 31 else counts, names))

    def scan(batches):
        counts, names = shared.value
        seen: set[int] = set()
        tokens: list[np.ndarray] = []
        keys: list[int] = []
        sizes: list[int] = []
        held = 0

        def flush():
            t, lengths = np.concatenate(tokens), [len(x) for x in tokens]
            k, n = np.repeat(np.array(keys, np.int64), lengths), np.repeat(np.array(sizes, np.uint32), lengths)
            part = (t % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            which = np.flatnonzero(np.diff(edges))
            cuts = [order[edges[p] : edges[p + 1]] for p in which]
            return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), *(pa.array([x[c].tobytes() for c in cuts], pa.binary()) for x in (t, k, n))], ["part", "t", "k", "n"])

        for batch in batches:
            for _, texts in slices(batch):
                for text in texts:
                    own = shingle_set(text)
                    if not len(own):
                        continue
                    key = names.of(own)
                    if key in seen:
                        continue
                    seen.add(key)
                    tokens.append(_in_order(own, counts)[: len(own) - least_overlap(len(own), share) + 1])
                    keys.append(key)
                    sizes.append(len(own))
                    held += len(tokens[-1])
                    if held >= 1 << 20:
                        yield flush()
                        tokens, keys, sizes, held = [], [], [], 0
        if held:
            yield flush()

    return docs.mapInArrow(scan, "part int, t binary, k binary, n binary")


def _fits(n: np.ndarray, m: np.ndarray, share: int) -> np.ndarray:
    """Whether sets of these sizes can link at all."""
    return 100 * np.minimum(n, m).astype(np.int64) >= share * np.maximum(n, m).astype(np.int64)


def _tokens(prefixes: DataFrame, parts: int, share: int) -> DataFrame:
    """kind 0: (x, y) pairs of classes with sizes n, m and count c of small tokens. kind 1: the same of a class and the leader of large tokens. kind 2: (token x, class y, size n) of large tokens."""

    def run(batches):
        names = ["kind", "x", "y", "n", "m", "c"]
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        hot: dict[int, tuple[int, int]] = {}  # large tokens given out before their part ended, with their leaders
        now, amount = None, 0

        def rows(kind, x, y, n, m, c):
            for i in range(0, len(x), 1 << 16):
                s = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x[s]), kind, np.int32)), *(pa.array(v[s].astype(np.int64)) for v in (x, y, n, m, c))], names)

        def counted(kind, x, y, n, m):
            order = np.lexsort((y, x))
            x, y, n, m = x[order], y[order], n[order], m[order]
            first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])) if len(x) else np.zeros(0, np.int64)
            yield from rows(kind, x[first], y[first], n[first], m[first], np.diff(np.append(first, len(x))))

        def give(last: bool):
            nonlocal held, amount
            t, k, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((k, t))
            t, k, n = t[order], k[order], n[order]
            own = np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])])
            t, k, n = t[own], k[own], n[own]
            start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            size = np.diff(np.append(start, len(t)))
            run_of = np.repeat(np.arange(len(start)), size)
            large = size > (SMALL if last else 1000)
            if hot:
                large |= np.isin(t[start], np.array(list(hot), np.uint64))
            lead_k, lead_n = k[start].copy(), n[start].copy()
            for i in np.flatnonzero(large).tolist() if hot or not last else ():
                lead_k[i], lead_n[i] = hot.setdefault(int(t[start[i]]), (int(lead_k[i]), int(lead_n[i])))
            big = large[run_of]
            if big.any():
                yield from rows(2, t[big].view(np.int64), k[big], n[big], n[big], np.ones(int(big.sum())))
                lk, ln = lead_k[run_of][big], lead_n[run_of][big]
                ok = lk != k[big]
                yield from counted(1, k[big][ok], lk[ok], n[big][ok], ln[ok])
            if not last:
                keep = ~big
                held, amount = [(t[keep], k[keep], n[keep])], int(keep.sum())
                return
            found: list[tuple] = []
            small = np.where(large, 0, size)[run_of]
            for d in range(1, SMALL):
                i = np.flatnonzero((small[d:] > d) & (run_of[d:] == run_of[:-d]))
                i = i[_fits(n[i], n[i + d], share)]
                found.append((k[i], k[i + d], n[i], n[i + d]))
            yield from counted(0, *(np.concatenate(x) for x in zip(*found, strict=True)))
            held, amount = [], 0

        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column(0)[i].as_py()
                if part != now:
                    if held:
                        yield from give(True)
                    now = part
                    hot.clear()
                data = [batch.column(j)[i].as_buffer() for j in (1, 2, 3)]
                held.append((np.frombuffer(data[0], np.uint64), np.frombuffer(data[1], np.int64), np.frombuffer(data[2], np.uint32)))
                amount += len(held[-1][0])
                if amount > 4 * PART_TOKENS:
                    yield from give(False)
        if held:
            yield from give(True)

    return prefixes.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, "kind int, x long, y long, n long, m long, c long")


def _needed(n: str, low: str, high: str, share: int) -> Column:
    """Shared prefix tokens that a link of a set of n with one of low to high tokens takes at least (see the overlap bound below).

    A link of sizes n and m takes an overlap of share / (100 + share) * (n + m); past the shorter of the two prefixes' reach at most ceil(share * max(n, m) / 100) - 1 tokens are
    common. The difference is least at either end of the range of m.
    """
    lo, hi = f"greatest({low}, cast(ceil({share} * {n} / 100) as bigint))", f"least({high}, cast(floor(100 * {n} / {share}) as bigint))"
    at = lambda m: f"(({share} * ({n} + {m}) + {99 + share}) div {100 + share} - ({share} * greatest({n}, {m}) + 99) div 100 + 1)"
    # Where the range is empty, nothing can link. Rounding may lift the ends by one above what lies between them.
    return F.expr(f"case when {lo} > {hi} then 9223372036854775807 else least({at(lo)}, {at(hi)}) - if({lo} < {hi}, 1, 0) end")


def _sets(docs: DataFrame, wanted: DataFrame, names: Names) -> DataFrame:
    """id, tokens of the classes of rows whose r is wanted (and a few more), once a task. A bit table of fixed size tells the scan which, so texts aren't shuffled."""
    bits, words = 1 << 26, 1 << 13
    mask = np.uint64(bits - 1)

    def places(ids: np.ndarray) -> list[np.ndarray]:
        h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        return [(h * np.uint64(m) >> np.uint64(11)) & mask for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]

    def mark(batches):
        table = np.zeros(bits // 64, np.uint64)
        any_ = False
        for batch in batches:
            for p in places(np.asarray(batch.column(0))) if batch.num_rows else ():
                any_ = True
                np.bitwise_or.at(table, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
        if any_:
            blocks = table.reshape(-1, words)
            full = np.flatnonzero(blocks.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([zlib.compress(blocks[i].tobytes(), 1) for i in full], pa.binary())], ["block", "data"])

    marked = _summed(wanted.select("r").mapInArrow(mark, "block int, data binary"), np.bitwise_or)
    shared = docs.sparkSession.sparkContext.broadcast((_whole(marked, bits // 64, words, np.int64).view(np.uint64), names))

    def scan(batches):
        table, names = shared.value
        seen: set[int] = set()
        for batch in batches:
            ids = np.asarray(batch.column(0)) if batch.num_rows else np.zeros(0, np.int64)
            hit = np.ones(len(ids), bool)
            for p in places(ids):
                hit &= (table[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
            at = np.flatnonzero(hit)
            own = ids[at].tolist()
            at = at[[not (x in seen or seen.add(x)) for x in own]] if own else at
            for _, texts in slices(pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(at, pa.int64()))], ["text"])):
                sets = [shingle_set(t) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array([names.of(t) for t in sets], pa.int64()), pa.array([t.tobytes() for t in sets], pa.binary())], ["id", "tokens"])

    return docs.select("r", "text").mapInArrow(scan, "id long, tokens binary")


def _linked(docs: DataFrame, classes: DataFrame, names: Names, pairs: DataFrame, members: DataFrame, share: int) -> DataFrame:
    """(u, v): links of q with members of g, for each pair (q, g), one for each component of a block that is known so far. members: g, id, n (its size), loose (whether links do not connect them yet)."""
    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens")).withColumn("blocks", F.expr(f"cast(greatest((size + {BLOCK - 1}) div {BLOCK}, tokens div {BLOCK_TOKENS} + 1) as int)"))
    loads = pairs.groupBy("g").agg(F.count(F.lit(1)).alias("queries")).withColumn("chunks", F.expr(f"cast((queries + {CHUNK - 1}) div {CHUNK} as int)"))
    # Written first, as all aggregates here that are joined on their key: a skewed partition of a join of plain tables gets split, so a group may hold, or be asked by, very many.
    shape = cut(sizes.join(loads, "g").select("g", "blocks", "chunks"))
    one = members.join(shape, "g").withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)")).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    many = pairs.join(shape, "g").withColumn("chunk", F.expr("cast(pmod(xxhash64(q), chunks) as int)")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = one.select("g", "block", "chunk", F.when(F.col("loose"), 1).otherwise(0).alias("kind"), "id").unionByName(many.select("g", "block", "chunk", F.lit(2).alias("kind"), F.col("q").alias("id")))
    rows = cut(rows)
    wanted = classes.join(rows.select("id").distinct(), "id", "left_semi").select("r")
    rows = rows.join(_sets(docs, wanted, names), "id").select("g", "block", "chunk", "kind", "id", "tokens")

    def run(batches):
        key = last = None
        ids: list[int] = []
        held: list[np.ndarray] = []
        root: list[int] = []
        union = None
        u: list[int] = []
        v: list[int] = []
        for batch in batches:
            g, block, chunk, kind, own = (batch.column(i).to_pylist() for i in range(5))
            for i in range(batch.num_rows):
                if (g[i], block[i], chunk[i]) != key:
                    key, ids, held, root, union = (g[i], block[i], chunk[i]), [], [], [], None
                    last = None
                if (kind[i], own[i]) == last:  # a copy of the row in another task
                    continue
                last = (kind[i], own[i])
                tokens = np.frombuffer(batch.column(5)[i].as_buffer(), np.uint64)
                if kind[i] < 2:
                    root.append(len(ids) if kind[i] else 0)
                    ids.append(own[i])
                    held.append(tokens.copy())
                    continue
                if not held or not len(tokens):
                    continue
                if union is None:
                    union = np.unique(np.concatenate(held))
                if _common(tokens, union) < least_overlap(len(tokens), share):
                    continue
                met: set[int] = set()
                for k, (other, x) in enumerate(zip(ids, held, strict=True)):
                    if root[k] in met or other == own[i] or 100 * min(len(x), len(tokens)) < share * max(len(x), len(tokens)):
                        continue
                    both = _common(tokens, x)
                    if 100 * both >= share * (len(x) + len(tokens) - both):
                        u.append(own[i])
                        v.append(other)
                        met.add(root[k])
                if len(met) > 1:  # the query connects them
                    least = min(met)
                    root = [least if r in met else r for r in root]
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
                u, v = [], []

    return rows.repartition("g", "block", "chunk").sortWithinPartitions("g", "block", "chunk", "kind", "id").mapInArrow(run, "u long, v long")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Tokens that two sorted sets share."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def jaccard_components(docs: DataFrame, share: int = 75, key_bits: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of doc_id, text. Two documents link where 100 * common >= share * united shingles."""
    kind = docs.schema["doc_id"].dataType
    out = labelled_rows(docs, share, key_bits)
    return out.select(F.col("doc_id").cast(kind), F.col("n").alias("n_shingles"), F.col("component").cast(kind).alias("component_id"))


def row_key() -> Column:
    """Key of a row of doc_id, text; equal for copies."""
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), "text")


def labelled_rows(docs: DataFrame, share: int = 75, key_bits: int = 64) -> DataFrame:
    """doc_id, r (row_key), n, root (a key of the component, null for an empty set), component (its least id) of each row. key_bits: of a hash's first half (for tests)."""
    docs = docs.select("doc_id", "text", row_key().alias("r"))
    narrow, counts = _classes(docs, key_bits)
    links, classes = _links(docs, narrow, counts, share, key_bits)
    labels = components(links)
    rooted = cut(classes.join(labels.withColumnRenamed("v", "id"), "id", "left").select("a", "b", "least", F.coalesce("component", "id").alias("root")))
    names = cut(rooted.groupBy("root").agg(F.min("least").alias("component")))
    labelled = rooted.join(names, "root").select("a", "b", "root", "component")
    alone = narrow.where("n = 0").select("doc_id", "r", "n", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component"))
    return narrow.where("n > 0").join(labelled, ["a", "b"], "left").select("doc_id", "r", "n", "root", "component").unionByName(alone)


def _links(docs: DataFrame, narrow: DataFrame, counts: np.ndarray, share: int, key_bits: int) -> tuple[DataFrame, DataFrame]:
    """((u, v) links between classes that connect whatever links connect; a, b, n, id, r (key of one row), least (doc_id) of classes)."""
    spark = docs.sparkSession
    key = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), F.col("r"))), F.min("r"))  # rows with null ids may have very many copies
    classes, names = _named(cut(narrow.where("n > 0").groupBy("a", "b").agg(F.min("n").alias("n"), key.alias("r"), F.min("doc_id").alias("least"))), key_bits)
    total = classes.agg(F.sum(F.expr(f"n - ({share} * n + 99) div 100 + 1"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_TOKENS))
    tokens = cut(_tokens(_prefixes(docs, counts, names, share, parts), parts, share))

    def summed(k: int) -> DataFrame:
        return tokens.where(F.col("kind") == k).groupBy("x", "y").agg(F.min("n").alias("n"), F.min("m").alias("m"), F.sum("c").alias("c"))

    # Leaders: the count is of some shared tokens only, so half of what a link takes is asked for; whatever is missed here the matrix finds.
    led = cut(summed(1).where("x <> y").select(F.col("x").alias("q"), F.col("y").alias("o"), "m", "c", (2 * F.col("c") >= _needed("n", "m", "m", share)).alias("near")))
    near = led.where("near").select("q", F.col("o").alias("g"), F.col("m").alias("n"))
    leads = cut(_linked(docs, classes, names, near.select("q", "g"), near.groupBy("g").agg(F.min("n").alias("n")).select("g", F.col("g").alias("id"), "n", F.lit(False).alias("loose")), share))
    small = cut(summed(0).where("x <> y").select(F.col("x").alias("q"), F.col("y").alias("o"), "c"))
    large = cut(tokens.where("kind = 2").select(F.col("x").alias("token"), F.col("y").alias("id"), "n").distinct())

    # Groups: of a leader; loose, by favourite leader and size; a class that is in neither, alone.
    sizes = classes.select("id", "n")
    wanted = small.select(F.explode(F.array("q", "o")).alias("id")).unionByName(large.select("id")).distinct()
    group = leads.select(F.col("u").alias("id"), F.col("v").alias("leader")).unionByName(leads.select(F.col("v").alias("id"), F.col("v").alias("leader"))).groupBy("id").agg(F.min("leader").alias("leader"))
    favourite = led.groupBy(F.col("q").alias("id")).agg(F.max(F.struct("c", "o"))["o"].alias("favourite"))
    member = sizes.join(wanted, "id", "left_semi").join(group, "id", "left").join(favourite, "id", "left").join(large.select("id").distinct().withColumn("in_large", F.lit(True)), "id", "left")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.2)))
    name = F.when(F.col("leader").isNotNull(), F.concat(F.lit("c"), "leader")).when(F.col("in_large"), F.concat(F.lit("l"), F.coalesce("favourite", "id"), F.lit("/"), band)).otherwise(F.concat(F.lit("c"), "id"))
    member = cut(member.select("id", "n", name.alias("g"), (F.col("leader").isNull() & F.col("in_large").isNotNull()).alias("loose")))
    span = cut(member.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("low"), F.max("n").alias("high")))
    of = cut(member.join(span, "g").select("id", "n", "g", "loose", "size", "low", "high"))

    def other(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])

    # Of two groups the smaller one's members are the queries; a loose group's members also ask their own.
    asks = f"(q_g = o_g and o_loose or q_g <> o_g and (q_size < o_size or q_size = o_size and q_g > o_g)) and 100 * o_high >= {share} * q_n and 100 * q_n >= {share} * o_low"
    pairs = small.unionByName(small.select(F.col("o").alias("q"), F.col("q").alias("o"), "c"))
    pairs = pairs.join(other(of, "q").withColumnRenamed("q_id", "q"), "q").join(other(of, "o").withColumnRenamed("o_id", "o"), "o").where(asks)
    columns = ["q", "q_n", "o_g", "o_low", "o_high", "c"]
    held = large.select("token", "id").join(of, "id")
    groups = held.groupBy("token", "g").agg(F.count(F.lit(1)).alias("k"), F.first("loose").alias("loose"), F.first("size").alias("size"), F.first("low").alias("low"), F.first("high").alias("high"))
    several = groups.groupBy("token").agg(F.min("g").alias("first"), F.max("g").alias("last"), F.max(F.col("loose") & (F.col("k") > 1)).alias("open")).where("first <> last or open").select("token")
    # A holder meets a group in the octave of its own size alone, if any of the group's sizes can link with it.
    octave = lambda n: F.floor(F.log2(n.cast("double"))).cast("int")
    reach = F.sequence(octave(F.expr(f"greatest(1, low * {share} div 100)")), octave(F.expr(f"high * 100 div {share} + 1")))
    groups = cut(groups.join(several, "token", "left_semi").withColumn("octave", F.explode(reach)))
    matrix = other(held.withColumn("octave", octave(F.col("n"))), "q").join(other(groups, "o"), (F.col("q_token") == F.col("o_token")) & (F.col("q_octave") == F.col("o_octave"))).where(asks)
    matrix = matrix.select(F.col("q_id").alias("q"), "q_n", "o_g", "o_low", "o_high", F.lit(1).cast("long").alias("c"))
    asked = pairs.select(*columns).unionByName(matrix.select(*columns)).groupBy("q", "o_g").agg(F.min("q_n").alias("q_n"), F.min("o_low").alias("o_low"), F.max("o_high").alias("o_high"), F.sum("c").alias("c"))
    asked = cut(asked.where(F.col("c") >= _needed("q_n", "o_low", "o_high", share)).select("q", F.col("o_g").alias("g")))
    opened = _linked(docs, classes, names, asked, member.select("g", "id", "n", "loose").join(asked.select("g").distinct(), "g", "left_semi"), share)
    return leads.unionByName(opened), classes
