"""The contract queries against brute force, exact round trips or held-out accuracy, and every operator on awkward rows."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute

import corpus_pipeline
from loomspan.llm import fst_tokenizer, jaccard_join, mixing, packing, text_stats, warc
from loomspan.llm.common import Runs, in_total_order
from loomspan.llm.components import components
from loomspan.llm.fingerprints import fingerprints, likeness
from loomspan.llm.gam import PairwiseGam, quality_scores
from loomspan.llm.hilbert_shards import curve, hilbert_index, hilbert_shards, manifest, write_shards
from loomspan.llm.isolation_forest import IsolationForest, calibrate, fit_rules, learnable, quality_rules
from loomspan.llm.jaccard_join import jaccard_components
from loomspan.llm.line_dedup import line_dedup
from loomspan.llm.queries import ORACLE_SQL, QUERIES
from loomspan.llm.token_counts import token_counts

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
LONG = "\n".join(f"line {i} of a very long text that goes on {i * i}" for i in range(3000))
AWKWARD = [
    (1, None, "en", None, 0), (2, "", None, "a", 0), (3, "One two", "en", "a", 7), (4, "One two", "en", "b", 7), (4, "One two", "en", "b", 7), (5, LONG, "en", "a", len(LONG)),
    (6, LONG + "\nx", "en", "b", len(LONG) + 2), (7, " \n\t\n ", "de", "", 5), (8, "a b c d e f\ng h i\nj k l\nm", "fr", None, 25), (9, "A b c d e f\ng h i\nj k l\nn", "fr", "c", 25), (10, "<|endoftext|> 中文🚀 don't", "zh", "c", 22),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


CLASHES = ["size", "rank", "n", "g", "run", "row", "own", "spans", "r", "a", "b", "h", "i", "key", "quality", "n_lines", "n_removed", "_id", "_spans", "_times", "_row", "_rank", "_at", "place", "taken", "a.b"]


def clashing(df):
    """df with columns whose names operators might use themselves."""
    for k, name in enumerate(CLASHES):
        df = df.withColumn(name, F.lit(f"clash{k}") if k % 2 else F.lit(k))
    return df


@pytest.fixture(scope="module")
def awkward(spark):
    return clashing(spark.createDataFrame(AWKWARD, SCHEMA))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "labels"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    rel = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in rel.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(rel.fetchall())


def test_mix_flow_is_least_cost():
    rnd = random.Random(3)
    for _ in range(60):
        n, m = rnd.randint(1, 3), rnd.randint(1, 3)
        capacity = [rnd.randint(0, 3) for _ in range(n)]
        members = [sorted(rnd.sample(range(m), rnd.randint(1, m))) for _ in range(n)]
        quota = [rnd.randint(0, 5) for _ in range(m)]
        flow = mixing.route(capacity, members, quota, 2)
        used = [sum(x.get(s, 0) for own in flow for x in own) for s in range(m)]
        assert all(u <= q for u, q in zip(used, quota, strict=True))
        assert all(sum(x.values()) <= c and set(x) <= set(members[p]) for p, c in enumerate(capacity) for x in flow[p])

        def most(levels, capacity=capacity, members=members, quota=quota, m=m):
            # Max flow by the cut formula over subsets of sources.
            return min(sum(quota[s] for s in range(m) if not k >> s & 1) + sum(levels * c for c, own in zip(capacity, members, strict=True) if any(k >> s & 1 for s in own)) for k in range(1 << m))

        first = sum(sum(own[0].values()) for own in flow)
        assert sum(used) == most(2) and first == most(1)


def test_mix_targets_and_overlap(spark, awkward, empty):
    assert mixing.water_fill([10, 10, 0], [5, 1, 1], Fraction(3, 2), 2) == [20.0, 10.0, 0.0]
    out = mixing.mix(awkward).collect()
    assert len(out) == len(AWKWARD) and all(r.taken <= 2 * r["size"] for r in out)
    both = spark.createDataFrame([(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(40)], "doc_id long, text string, of array<string>")
    assert all(r.taken in (0, 10, 20) for r in mixing.mix(both, members="of").collect())
    assert mixing.mix(empty).count() == 0


def test_mix_of_very_many_sources(spark):
    rnd = random.Random(7)
    made = [(i, "w " * rnd.choice([0, 1, 2, 3, 5, 8, 40]), f"site{rnd.random()}" if i else None) for i in range(20_500)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string")
    order = sorted(made, key=lambda r: (r[2] is None, r[2] or ""))
    sizes = [len(r[1]) // 2 for r in order]
    targets = mixing.water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(order))], Fraction(3, 2), 2)
    want = {r[0]: (n, n, t, n * (int(t) // n) if n else 0) for r, n, t in zip(order, sizes, targets, strict=True)}  # one document a source: all of it or none
    assert {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(docs).collect()} == want
    # A few sources, one of each share: all full, none full, and the flow on the driver agrees once there is an overlap.
    few = docs.where("doc_id < 40").withColumn("source", F.concat(F.lit("s"), (F.col("doc_id") % 7).cast("string")))
    for share, most in ((Fraction(3), 2), (Fraction(1, 9), 1), (Fraction(7, 3), 3)):
        own = few.withColumn("of", F.array("source")).unionByName(spark.createDataFrame([(99, "", ["y", "z"])], "doc_id long, text string, of array<string>"), allowMissingColumns=True)
        read = lambda df: {r.doc_id: tuple(r) for r in df.collect() if r.doc_id != 99}
        assert read(mixing.mix(few, share=share, max_repeats=most)) == read(mixing.mix(own, share=share, max_repeats=most, members="of"))


def test_mix_of_very_many_overlapping_sources(spark):
    """50,000 patterns in small components, each of which has the flow that the whole would give it; one component beyond the bound."""
    rnd = random.Random(8)
    made = []
    for k in range(25_000):
        a, b = f"a{k:05d}", f"b{k:05d}"
        made += [(4 * k, "w " * rnd.choice([0, 1, 3, 9]), [a]), (4 * k + 1, "w " * rnd.choice([2, 5]), [b, a])] + ([(4 * k + 2, "w " * 4, [b])] if k % 3 == 0 else [])
    docs = spark.createDataFrame([*made, (-1, "w w", []), (-2, "w", [None])], "doc_id long, text string, of array<string>")
    got = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(docs, members="of").collect()}
    names = sorted({s for _, _, own in made for s in own} | {"~"}, key=lambda s: (s == "~", s))
    at = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for _, text, own in [*made, (-2, "w", ["~"])]:
        for s in own:
            sizes[at[s]] += len(text.split())
    targets = mixing.water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], Fraction(3, 2), 2)
    assert got[-1] == (2, 0, 0.0, 0) and len(got) == len(made) + 2
    assert all(got[i][:3] == (len(t.split()), sizes[at[min(own)]], targets[at[min(own)]]) for i, t, own in made)
    for k in range(0, 25_000, 250):
        rows = [r for r in made if r[0] // 4 == k]
        patterns = sorted({tuple(sorted(own)) for _, _, own in rows})
        local = sorted({s for own in patterns for s in own})
        capacity = [sum(len(t.split()) for _, t, own in rows if tuple(sorted(own)) == p) for p in patterns]
        flow = mixing.route(capacity, [[local.index(s) for s in p] for p in patterns], [int(targets[at[s]]) for s in local], 2)
        for p, n, own in zip(patterns, capacity, flow, strict=True):  # one document a pattern: all of it at a level, or none
            i = next(r[0] for r in rows if tuple(sorted(r[2])) == p)
            assert got[i][3] == n * sum(sum(x.values()) >= n > 0 for x in own)
    chain = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("w").alias("text"), F.array(F.col("id").cast("string"), (F.col("id") + 1).cast("string")).alias("of"))
    assert mixing.mix(chain, members="of", max_patterns=40).count() == 40
    with pytest.raises(Exception, match="more than 39"):
        mixing.mix(chain, members="of", max_patterns=39).collect()


def test_tokens_equal_the_library(spark, awkward, empty, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    rnd = random.Random(1)
    alphabet = [*"  \n\t''''srtvelmdd aZ09.,!?-é中🚀  ́\x1c\x85ßñ½٣<|>　", "'re", "'ll", "<|endoftext|>", "ing", " The", "\r\n"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(3000)] + [t for _, t in rows] + ["", "a" * 5000, " " * 300, "".join(rnd.choice("abcdefghij") for _ in range(30_000))]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    few = fst_tokenizer.FstTokenizer(BPE, max_states=500)  # forgets its states over and over
    for own in (fst_tokenizer.load(BPE), few):
        assert own.counts(texts).tolist() == [len(x) for x in want]
        ids, sizes = own.encode(texts)
        assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    own = fst_tokenizer.load(BPE)
    piece = own._pieces
    own._pieces = lambda text, most=50: piece(text, most)  # long texts run in slices
    try:
        assert own.counts(texts).tolist() == [len(x) for x in want]
    finally:
        del own._pieces
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(awkward, BPE).collect()}
    assert got == {r[0]: (len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in AWKWARD}
    assert token_counts(empty, BPE).count() == 0


def test_line_dedup(awkward, empty):
    once = {r[0]: r[1] for r in AWKWARD}
    want = brute.line_dedup(list(once.items()))
    got = line_dedup(awkward).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == want and len(got) == len(AWKWARD)
    assert line_dedup(empty).count() == 0


def test_line_dedup_null_and_shared_ids(spark):
    made = [(None, "a\nb\nc\nd"), (None, "a\nb\nc\ne"), (None, "x\ny\nz\nw"), (None, "x\ny\nz\nw"), (1, "x\ny\nz"), (2, "u\nv\nw"), (4, "u\nv\nw\nown"), (4, "other\nlines\nstay\nhere"), (5, "k\nl\nm\nn"), (5, "k\nl\nm\no"), (None, None)]
    got = Counter((r.doc_id, r.text, r.n_removed) for r in line_dedup(spark.createDataFrame(made, "doc_id long, text string")).collect())
    want = Counter([(None, "w", 3), (None, "w", 3), (1, "x\ny\nz", 0), (2, "u\nv\nw", 0), (4, "own", 3), (4, "other\nlines\nstay\nhere", 0), (5, "k\nl\nm\nn", 0), (5, "k\nl\nm\no", 0), (None, None, 0)])
    one, two = Counter([(None, "a\nb\nc\nd", 0), (None, "e", 3)]), Counter([(None, "a\nb\nc\ne", 0), (None, "d", 3)])
    assert got in (want + one, want + two)  # which comes first goes by hash


def test_hilbert(spark, awkward, empty, docs, tmp_path):
    path = sorted(range(512), key=lambda c: hilbert_index((c >> 6, c >> 3 & 7, c & 7), 3))
    step = lambda a, b: sum(abs((a >> k & 7) - (b >> k & 7)) for k in (0, 3, 6))
    assert all(step(a, b) == 1 for a, b in zip(path, path[1:], strict=False)) and len(set(curve(3, 3).split(","))) == 512
    for df in (awkward, docs, empty):
        out = hilbert_shards(df).collect()
        n = len(out)
        assert n == df.count()
        of = defaultdict(list)
        for r in out:
            of[r.shard].append(r)
        assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in of.values())
        if n >= 8:
            assert max(map(len, of.values())) - min(map(len, of.values())) <= 1
        order = [r.curve for k in sorted(of) for r in sorted(of[k], key=lambda r: r.slot)]
        assert order == sorted(order)
    text = {r[0]: r[1] or "" for r in AWKWARD}
    assert all((r["size"], r.text_crc32) == (len(text[r.doc_id].encode()) + 1, zlib.crc32(text[r.doc_id].encode())) for r in hilbert_shards(awkward).collect())
    placed = hilbert_shards(docs)
    assert manifest(placed).agg(F.sum("rows")).first()[0] == docs.count()
    write_shards(docs, placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


def test_quality_model(spark, awkward, empty, labels):
    sf = "/root/testdata/sf0.01"
    docs, known = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_scores(docs, known).join(known, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out and r.predicted == (r.score >= 0.3) for r in out)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    # Labels of held-out rows change nothing.
    other = known.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality_scores(docs, other).collect()} == {r.doc_id: r.score for r in quality_scores(docs, known).collect()}
    assert quality_scores(awkward, labels).count() == len(AWKWARD) and quality_scores(empty, labels).count() == 0
    assert {r.score for r in quality_scores(awkward, labels.limit(0)).collect()} == {0.5}


def test_quality_model_equals_a_plain_one(docs, labels):
    known = docs.select("doc_id", "text").join(labels.where("quality is not null"), "doc_id").orderBy("doc_id").limit(90).collect()
    x = text_stats.ratios(np.array([text_stats.stats_of(r.text) for r in known], np.int64))[:, [0, 1, 3, 9]]
    y = np.array([r.quality for r in known])
    y[::7] = 1 - y[::7]  # labels that no table fits, so that trees and pairs have work to do
    for options in (dict(bins=12, rounds=12, rate=0.15, pairs=3, coarse=4, ridge=2.0), dict(bins=200, rounds=6, rate=0.3, pairs=6, coarse=3, ridge=0.5)):
        model = PairwiseGam(**options).fit(x[:70], y[:70])
        assert model.pairs and any(g.any() for g in model.grids)
        assert np.allclose(model.score(x), brute.gam_scores(x.tolist(), x[:70].tolist(), y[:70].tolist(), **options), atol=1e-9)


def test_forest_equals_a_plain_one(docs):
    x = text_stats.ratios(np.array([text_stats.stats_of(r.text) for r in docs.orderBy("doc_id").limit(120).collect()], np.int64))
    for rows, trees, sample, widen in ((x[:100], 8, 64, 1.0), (x[:100], 5, 256, 0.3), (x[:1], 2, 256, 1.0), (np.repeat(x[:2], 20, axis=0), 4, 16, 0.0)):
        forest = IsolationForest(trees, sample, seed=5).fit(rows, widen)
        if len(rows) > 1:
            assert np.allclose(forest.score(x), brute.isolation_scores(x.tolist(), rows.tolist(), 5, trees, sample, widen), atol=1e-12)
    # The threshold: of all cuts, the greatest recall of bad ones less caution times the loss of good ones.
    rnd = random.Random(2)
    for _ in range(50):
        scores, good = np.array([rnd.randint(0, 6) / 6 for _ in range(12)]), np.array([rnd.random() < 0.6 for _ in range(12)])
        worth = lambda at: np.mean(scores[~good] >= at) - 2 * np.mean(scores[good] >= at) if good.any() and not good.all() else 0
        if good.any() and not good.all():
            assert abs(max(0, *(worth(s) for s in scores)) - worth(calibrate(scores, good, 2.0))) < 1e-12


def test_packing(spark, awkward, empty, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    for df in (awkward, docs, empty):
        out = packing.packed(df, BPE, with_ids=True).collect()
        by, by_doc = defaultdict(list), defaultdict(list)
        for r in out:
            assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
            by[r.sequence_id].append((r.offset, r.length))
            by_doc[r.doc_id].append(r)
        for own in by.values():
            at = 0
            for offset, n in sorted(own):
                assert offset == at
                at += n
            assert at <= 1024
        texts = {r.doc_id: r.text or "" for r in df.collect()}
        assert set(by_doc) == set(texts)
        for i, own in by_doc.items():
            ids = [*library.encode(texts[i], add_special_tokens=False).ids, 2]
            assert all(ids[r.start : r.start + r.length] == r.ids and (r.piece == 0 or r.length == 1024) for r in own)
        if df is docs:
            assert len(by) <= 1.02 * -(-sum(r.length for r in out) // 1024) + 1


def test_packing_plan():
    rnd = np.random.default_rng(1)
    for x in (rnd.integers(1, 1025, 5000), rnd.integers(200, 500, 3000), np.full(1000, 400), np.array([5]), np.array([], int)):
        sizes, n = np.unique(x, return_counts=True)
        histogram = dict(zip(sizes.tolist(), n.tolist(), strict=True))
        used: Counter = Counter()
        plan = packing.pack_histogram(histogram)
        for lengths, k in plan:
            assert sum(lengths) <= 1024
            for s in lengths:
                used[s] += k
        assert used == Counter(histogram)


def test_rules(awkward, empty, labels, docs, rows):
    text = dict(rows)
    for r in quality_rules(docs, labels).collect():
        assert brute.rule_stats(text[r.doc_id]) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert not (r.base_failed and r.kept)
    own = {r[0]: r[1] for r in AWKWARD}
    got = quality_rules(awkward, labels.limit(0)).collect()
    assert all(brute.rule_stats(own[r.doc_id])[-1] == r.base_failed and r.kept != r.base_failed for r in got) and len(got) == len(AWKWARD)
    assert quality_rules(empty, labels).count() == 0


def test_rules_follow_labels(spark):
    """On labels that neither grew the forest nor set its threshold."""
    sf = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{sf}/labels.parquet")
    other = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    out = quality_rules(spark.read.parquet(f"{sf}/documents.parquet"), known.where(~other)).join(known.where(other), "doc_id").where("not base_failed").collect()
    bad, good = [r.kept for r in out if r.quality == 0], [r.kept for r in out if r.quality == 1]
    assert len(bad) and np.mean(bad) <= 0.2 and np.mean(good) > 0.97


def test_rules_learn_from_all_labels(spark):
    """More labelled rows than any sample had: each is in the order that trees draw from, in the spread and in the counts that set the threshold."""
    ids = spark.range(24_000).selectExpr("id as doc_id", "cast(id % 7 > 0 as int) as quality")
    words = F.expr("concat_ws(' ', transform(sequence(1, 12 + cast(pmod(hash(doc_id), 9) as int)), x -> concat(if(quality = 0 and doc_id % 5 > 0, '##', 'w'), pmod(hash(doc_id, x), 1000))))")
    stats = text_stats.text_stats(ids.withColumn("text", words))
    rows = learnable(stats, ids).orderBy("doc_id").toPandas()
    x, good = rows[text_stats.FEATURES].to_numpy(), rows["good"].to_numpy()
    forest, at = fit_rules(stats, ids)
    assert len(rows) == 24_000 and at == calibrate(forest.score(x), good, 10.0)
    rnd = np.random.default_rng([forest.seed, 1])
    own = [x[good][rnd.choice(int(good.sum()), 256, replace=False)] for _ in range(forest.trees)]
    plain = IsolationForest().grow(int(good.sum()), np.ptp(x[good], axis=0), lambda _, t: own[t])
    assert (plain.score(x) == forest.score(x)).all()


def test_fingerprints(spark, awkward, empty, docs):
    for df in (awkward, docs):
        source = sorted((r.doc_id, r.text or "") for r in df.collect())
        got = sorted(fingerprints(df).collect(), key=lambda r: (r.doc_id, r.n_chars))
        assert len(got) == len(source)
        prints = defaultdict(set)
        errors = []
        for k, ((i, text), r) in enumerate(zip(source, got, strict=True)):
            following = source[(k + 1) % len(source)][1]
            n = len(text) // 4
            new = text[: len(text) - n] + following[:n]
            assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(text), hashlib.sha256(new.encode()).hexdigest())
            prints[text].add(r.fingerprint)
            own, other, after = brute.fingerprint(text), brute.fingerprint(new), brute.fingerprint(following)
            assert (r.fingerprint, r.edited_fingerprint) == (own, other) and abs(r.near_edited - brute.likeness(own, other)) + abs(r.near_next - brute.likeness(own, after)) < 1e-9
            a, b = brute.shingles(text), brute.shingles(new)
            errors.append(abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1)))
        assert all(len(x) == 1 for x in prints.values()) and np.mean(errors) < 0.05
    assert fingerprints(empty).count() == 0 and likeness(b"", b"") == 1 and likeness(b"", b"a") == 0
    assert fingerprints(docs.limit(1)).first().near_next == 1.0


def test_runs_split_hot_ids(spark):
    rnd = random.Random(4)
    made = [(rnd.choice([None, 5, 5, rnd.randint(-100, 100), 1 << 60]), rnd.getrandbits(64) - (1 << 63), rnd.randint(1, 9)) for _ in range(5000)]
    df = spark.createDataFrame(made, "id long, h long, n long")
    for most in (200, 2000, 1 << 40):
        runs = Runs(df, most)
        got = df.select("id", "h", "n", runs.of(F.col("id"), F.col("h")).alias("run")).collect()
        order = [r.run for r in sorted(got, key=lambda r: (r.id is None, r.id or 0, r.h))]
        weight = Counter()
        for r in got:
            weight[r.run] += r.n
        total, bound = sum(r[2] for r in made), min(most, -(-sum(r[2] for r in made) // 8))
        assert order == sorted(order) and set(weight) == set(range(runs.count)) and runs.count >= total / bound / 1.3
        assert max(weight.values()) <= 1.6 * bound + 9
    for df in (spark.createDataFrame([], "id long, h long, n long"), spark.createDataFrame([(None, 3, 1)], "id long, h long, n long")):
        assert [r.run for r in df.select(Runs(df).of(F.col("id"), F.col("h")).alias("run")).collect()] == [0] * df.count()


def test_runs_are_bounded_in_number(spark):
    """A million runs' worth of rows, by their sizes."""
    df = spark.range(1_000_000).select((F.col("id") * 3).alias("id"), F.xxhash64("id").alias("h"), F.lit(64 << 20).cast("long").alias("n"))
    runs = Runs(df)
    weight = [r.n for r in df.groupBy(runs.of(F.col("id"), F.col("h")).alias("run")).agg(F.sum("n").alias("n")).collect()]
    assert 10_000 < runs.count < 20_000 and len(weight) == runs.count and max(weight) < 3 * (sum(weight) / runs.count)
    hot = Runs(df.withColumn("id", F.lit(7)))
    assert hot.count < 20_000


def test_fingerprints_of_null_and_shared_ids(spark):
    rnd = random.Random(6)
    made = [(rnd.choice([None, 7, k]), f"{k} " + " ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 30)))) for k in range(300)] + [(None, "same text")] * 40 + [(None, None)] * 3
    df = spark.createDataFrame(made, "doc_id long, text string")
    order = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text"), "text").collect()
    want = Counter()
    for k, r in enumerate(order):
        n, following = len(r.text) // 4, order[(k + 1) % len(order)].text
        new = r.text[: len(r.text) - n] + following[:n]
        want[r.doc_id, len(r.text), hashlib.sha256(new.encode()).hexdigest(), brute.fingerprint(r.text)] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in fingerprints(df).collect()) == want


def test_total_order_splits_equal_rows(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("v")).withColumn("row", F.monotonically_increasing_id())
    got = in_total_order(df, ["k", "v", "row"]).orderBy("_rank").collect()
    assert [r._rank for r in got] == list(range(4000)) and [(r.v, r.row) for r in got] == sorted((r.v, r.row) for r in got)


def test_jaccard(spark, awkward, empty, docs, rows):
    read = lambda df, **k: Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, **k).collect())
    assert read(docs) == brute.jaccard_components(rows)
    assert read(awkward) == brute.jaccard_components([r[:2] for r in AWKWARD])
    assert jaccard_components(empty).count() == 0
    # Families about the threshold, a common passage, and many near copies, so that large tokens and loose groups take part.
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    passage, base = [word() for _ in range(60)], [word() for _ in range(80)]
    made = [(i, " ".join(passage + [word() for _ in range(rnd.randint(0, 25))])) for i in range(60)]
    for i in range(60, 160):
        own = list(base)
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(len(own))] = word()
        made.append((i, " ".join(own)))
    both = spark.createDataFrame(made, "doc_id long, text string")
    assert read(both) == read(both, key_bits=6) == brute.jaccard_components(made)  # six bits: nearly all classes share theirs


def test_jaccard_of_string_ids_and_very_long_texts(spark, monkeypatch):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(10**9)}" for _ in range(60_000)]
    made = [("long", " ".join(base)), ("long2", " ".join(base[2000:] + base[:10])), ("longer", " ".join(base * 2 + ["x"])), (None, " ".join(base[:50_000])), ("b", "one two three"), ("a", "One two three"), ("", None), ("c", "")]
    for k in range(40):
        own = list(base[:300])
        own[rnd.randrange(300)] = f"x{k}"
        made.append((f"s{k}", " ".join(own)))
    docs = spark.createDataFrame(made, "doc_id string, text string")
    want = brute.jaccard_components(made)
    read = lambda: Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect())
    assert read() == want
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 500)  # blocks of a few members
    assert read() == want
    kept = corpus_pipeline.one_of_each_group(spark, docs.withColumn("n_chars", F.lit(1)), SF).collect()
    assert {r.doc_id for r in kept} == {i for i, _, c in want if i == c and i is not None}


def test_jaccard_null_and_shared_ids(spark):
    run = lambda name, a, b: " ".join(f"{name}{i}" for i in range(a, b))
    # A chain through a null id, a null id beside 5, null ids alone, blank null ids, and 7 with a long and a short text of different families.
    made = [(1, run("a", 0, 100)), (None, run("a", 10, 110)), (9, run("a", 20, 120)), (5, run("b", 0, 50)), (None, run("b", 1, 50)), (None, run("c", 0, 40)), (None, run("c", 1, 40)), (None, run("c", 1, 40)), (None, None), (None, " ")]
    made += [(2, run("d", 0, 300)), (7, run("d", 1, 300)), (3, run("e", 0, 20)), (7, run("e", 1, 20)), (7, run("f", 0, 20)), *((20 + i, run("e", 0, 20) + f" x{i}") for i in range(12))]
    docs = spark.createDataFrame([(i, t, "en", None, k) for k, (i, t) in enumerate(made)], SCHEMA)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect())
    assert got == brute.jaccard_components(made)
    assert got[None, 96, 1] == got[9, 96, 1] == got[7, 15, 3] == got[7, 295, 2] == got[7, 16, 7] == 1
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect())
    alone = [x for x in kept if x[0] is None and (x[1] or "").startswith("c")]
    assert len(alone) == 1 and kept == Counter([(1, made[0][1]), (5, made[3][1]), (None, None), (None, " "), (2, run("d", 0, 300)), (3, run("e", 0, 20)), (7, run("f", 0, 20)), *alone])


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 200), (200, 150), (7, 7)]
    got = {r.v: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 200: 100, 150: 100}
    star = [(5000, i) for i in range(3000)] + [(None, 1), (2, None), (None, None)]
    got = components(spark.createDataFrame(star, "u long, v long")).collect()
    assert len(got) == 3001 and {r.component for r in got} == {0}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_warc(spark, tmp_path):
    pages = [(i, f"http://h/{i} x\n", f"<p>{i % 7}</p>" * (i % 5)) for i in range(60)] + [(100, None, None), (3, "u", "other"), (None, "u", "<p>1</p>"), (60, "u", "x" * 100_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("run", F.lit(1))
    made = [warc.write_warc(df, f"{tmp_path}/{k}", roll_bytes=1500) for k in range(2)]
    assert made[0] == made[1] and len(made[0]["files"]) > 8
    got = warc.read_warc(spark, f"{tmp_path}/0").collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute.warc([(i, h) for i, _, h in pages])
    assert all(r.payload is None or len(r.payload) == r.payload_bytes for r in got)
    least = {len(h or "") for _, _, h in pages if len(h or "") < 12}
    warc.write_warc(df, f"{tmp_path}/least", least=12)
    kinds = defaultdict(set)
    for r in warc.read_warc(spark, f"{tmp_path}/least").collect():
        kinds[r.payload_bytes].add(r.record_type)
    assert all(kinds[n] == {"response"} for n in least) and "revisit" in {k for x in kinds.values() for k in x}
    shared = df.select(F.when(F.col("page_id") > 5, F.col("page_id")).alias("page_id"), "url", "html").unionByName(df.limit(20).select(F.lit(3).cast("long").alias("page_id"), "url", "html"))
    warc.write_warc(shared, f"{tmp_path}/shared")
    want = brute.warc([(r.page_id, r.html) for r in shared.collect()])
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(spark, f"{tmp_path}/shared").collect()) == want
    warc.write_warc(df.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


def test_pipeline(spark, labels, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        old = {r.doc_id: r.text for r in before.collect()}
        seen.append(name)
        if k < 4:
            assert docs.columns == columns
            new = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "quality_rules":
            assert {i for i, _ in new} == {r.doc_id for r in quality_rules(before, labels).where("kept").collect()} and all(old[i] == t for i, t in new)
        elif name == "line_dedup":
            want = {i: t for i, (t, n, gone) in brute.line_dedup(list(old.items())).items() if not gone or gone < n}
            assert dict(new) == want
        elif name == "jaccard_join":
            assert {i for i, _ in new} == {i for i, _, c in brute.jaccard_components(list(old.items())) if i == c}
        elif name == "mixing":
            assert Counter(i for i, _ in new) == Counter({r.doc_id: r.taken // r["size"] for r in mixing.mix(before).collect() if r.taken})
    assert seen == [n for n, _ in corpus_pipeline.STAGES] and docs.count() >= len(old)


def test_pipeline_on_awkward_rows(spark, awkward, empty):
    more = [(None, "p q r s t u v w x y z", "en", "a", 21), (None, "p q r s t u v w x y z", "en", "a", 21), (None, LONG + "\nnull id", None, None, None), (None, None, None, None, None)]
    extra = clashing(spark.createDataFrame(more, SCHEMA))
    docs = spark.createDataFrame(awkward.unionByName(extra).collect(), awkward.schema)
    rows = lambda df: Counter((r.doc_id, r.text, r.n_chars, r["size"], r["n_lines"], r["a.b"]) for r in df.collect())
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, empty, SF)
        assert none.count() == 0
        out = stage(spark, docs, SF)
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
            continue
        assert none.columns == empty.columns and out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        before, after = rows(docs), rows(out)
        texts[name] = [x[:2] for x in after.elements()]
        if name == "quality_rules":
            kept = Counter((r.doc_id, r.n_words) for r in quality_rules(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("kept").collect())
            assert Counter((i, len(brute.words(t))) for i, t in texts[name]) == kept and after <= before
            after = before  # the other stages see all awkward rows
        elif name == "line_dedup":
            known = [x[:2] for x in before if x[0] is not None]
            want = {i: t for i, (t, n, gone) in brute.line_dedup(known).items() if not gone or gone < n}
            assert {i: t for i, t in texts[name] if i is not None} == want
            assert Counter(t for i, t in texts[name] if i is None) == Counter({"p q r s t u v w x y z": 2, "null id": 1, None: 1})
            assert all(x[2] == len(x[1]) for x in after if x[0] == 6) and after[3, "One two", 7, 0, CLASHES.index("n_lines"), "clash25"] == 0
        elif name == "jaccard_join":
            least = Counter(i for i, _, c in brute.jaccard_components([x[:2] for x in before.elements()]).elements() if i is not None and i == c)
            assert Counter(i for i, _ in texts[name] if i is not None) == least and after <= before
            assert Counter(t for i, t in texts[name] if i is None)["p q r s t u v w x y z"] == 1
        else:
            want = Counter()
            for r in mixing.mix(docs).where("taken > 0").collect():
                want[r.doc_id, r["size"]] += r.taken // r["size"]
            assert Counter((i, len(brute.words(t))) for i, t in texts[name]) == want and set(after) <= set(before)
        if name != "quality_rules":
            docs = spark.createDataFrame(out.collect(), out.schema)
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_mix_keeps_null_and_shared_ids(spark):
    made = [(None if i % 3 == 0 else i // 4, f"{i} " + "w " * (i % 7), "en" if i % 2 else None, None if i % 2 else "en", i) for i in range(60)] + [(None, "x y", "en", "a", 3)] * 5 + [(None, None, None, None, None)]
    docs = spark.createDataFrame(made, SCHEMA)
    got = corpus_pipeline.mix_sources(spark, docs, SF).collect()
    words = lambda rows: Counter((r[0], r.source, n) for r in rows if (n := len(r.text.split())))
    want = Counter()
    for r in mixing.mix(docs).where("taken > 0").collect():
        want[r.doc_id, r.sources[0], r["size"]] += r.taken // r["size"]
    assert words(got) == want and any(r.doc_id is None for r in got)
    assert {tuple(r) for r in got} <= set(made)
