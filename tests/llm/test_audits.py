"""Filter audit, hard negatives and decontamination against plain versions, on awkward rows and in small blocks."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.llm import filter_audit as audit
from loomspan.llm.decontaminate import contamination, decontaminated
from loomspan.llm.hard_negatives import Block, hard_negatives

SCHEMA = "doc_id long, text string, lang string"
CLASHES = ["h", "n", "words", "mask", "part", "at", "own", "i", "pieces", "lead", "times", "hit", "bits", "every", "row", "q", "kind", "block", "a.b"]


def clashing(df):
    for k, name in enumerate(CLASHES):
        df = df.withColumn(name, F.lit(f"clash{k}") if k % 2 else F.lit(k))
    return df


# Filter audit.


def failed(text: str | None) -> set[str]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    upper = len(re.findall("[A-Z]", text))
    tests = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * upper > 10 * len(text), "D": re.search(r"[#$%&*|]", text) is not None}
    return {k for k, v in tests.items() if v}


def plain_audit(docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    good, toxic = ({i for i, *own in labels if own[k] == 1 and i is not None} for k in (0, 1))
    rows = defaultdict(list)
    for i, text, part in docs:
        copy = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in docs)
        rows[part or ""].append((failed(text) | ({"E"} if copy else set()), i in good, i in toxic))
    out = set()
    for part, own in rows.items():
        made = []
        for order in permutations("ABCDE"):
            for k, name in enumerate(order):
                now = [x for x in own if not x[0] & set(order[:k])]
                gone = [x for x in now if name in x[0]]
                made.append((part, "".join(order), k + 1, len(now) - len(gone), len(gone), sum(name in x[0] for x in own) - len(gone), sum(x[0] == {name} for x in own), sum(x[1] for x in gone), sum(x[2] for x in gone)))
        for x in made:
            out.add((*x, sum(y[4] for y in made if y[1][y[2] - 1] == x[1][x[2] - 1])))
    return out


def awkward_docs() -> list[tuple]:
    rnd = random.Random(11)
    long = " ".join(f"word{k}" for k in range(4000))
    texts = [None, "", " \t\n", "A B C", "a # b", long, long + " X" * 3000, "x " * 150, " ".join(f"w{k}" for k in range(120)), "É" * 9 + "A", " ".join(f"w{k}" for k in range(100)) + " |"]
    docs = [(rnd.choice([None, k, k, 5, -k]), rnd.choice(texts), rnd.choice(["en", "de", "", None])) for k in range(300)]
    return docs + [(7, "same", "en")] * 5 + [(3, "same", "en"), (3, "same", "fr"), (None, "same", "en")]


@pytest.mark.parametrize(("held", "hashed"), [(1, audit.fingerprint), (3000, audit.fingerprint), (audit.HELD_BYTES, audit.fingerprint), (audit.HELD_BYTES, lambda text: 1)])
def test_copies_are_told_in_any_memory_and_by_their_texts(spark, held, hashed):
    docs = awkward_docs()
    want = Counter()
    for i, text, part in docs:
        bits = sum(1 << "ABCDE".index(x) for x in failed(text))
        copy = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in docs)
        want[i, part or "", bits | copy << 4] += 1
    got = Counter()
    for r in audit.masks(clashing(spark.createDataFrame(docs, SCHEMA)).repartition(5), held_bytes=held, hashed=hashed).collect():
        got[r.doc_id, r.part, r.mask] += r.n
    assert got == want


def test_audit(spark):
    docs = awkward_docs()
    labels = [(k, k % 3 % 2, int(k % 5 == 0)) for k in range(40)] + [(3, None, 1), (4, 1, None), (4, 0, 1), (None, 1, 1), (9, None, None)]
    frame, known = clashing(spark.createDataFrame(docs, SCHEMA)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = lambda df: [tuple(r) for r in df.collect()]
    got = rows(audit.filter_audit(frame, known))
    assert len(got) == len(set(got)) == 4 * 600 and set(got) == plain_audit(docs, labels)
    assert set(rows(audit.filter_audit(frame, known.limit(0)))) == plain_audit(docs, [])
    assert rows(audit.filter_audit(frame.limit(0), known)) == []


# Hard negatives.


def plain_negatives(rows: list[tuple]) -> Counter:
    known = []
    for n, (i, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        known.append((i, n, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    place = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out: Counter = Counter()
    for i, n, label, q in known:
        if i is None or i % 50:
            continue
        scored = [(dot(q, v), j, x) for j, m, x, v in known if m != n]
        for score, j, _ in sorted((r for r in scored if r[2] == label), key=place)[:5]:
            near = sorted((r for r in scored if r[2] != label and 50 * score <= 100 * r[0] <= 95 * score), key=place)
            for rank, (s, other, _) in enumerate(near[:3], 1):
                out[i, j, rank, other, score, s] += 1
    return out


@pytest.mark.parametrize("block_rows", [40, 1 << 18])
def test_hard_negatives(spark, block_rows):
    rnd = random.Random(12)
    vector = lambda n=6: [rnd.choice([-1, 1]) * rnd.random() for _ in range(n)]
    common = vector()
    rows = [(k, common if rnd.random() < 0.3 else [x + 0.3 * y for x, y in zip(common, vector(), strict=True)], 1 if rnd.random() < 0.4 else rnd.randint(0, 9)) for k in range(400)]
    rows += [(100, common, 1), (100, common, 1), (None, common, 2), (None, common, 3), (-50, vector(), 4), (450, vector(3), 5), (500, [], 6), (550, None, 1), (600, vector(), None), (650, [0.1, None, 0.2, 0.1, 0.1, 0.1], 1)]
    rows += [(700, [float("nan")] * 6, 2), (750, [float("inf")] * 6, 2), (800, [0.0] * 6, 7), (801, [0.0] * 6, 7), (802, [0.0] * 6, 8), (850, [3000.5, -2000.25, 0.0, 1.0, 1.0, 1.0], 9), (851, [3000.5, -2000.25, 0.0, 1.0, 1.0, 1.0], 9)]
    frame = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = Counter(tuple(r) for r in hard_negatives(frame, block_rows=block_rows).collect())
    assert got == plain_negatives(rows) and sum(got.values()) > 50
    assert hard_negatives(frame.limit(0)).count() == 0 and hard_negatives(frame.where("label is null")).count() == 0
    with pytest.raises(ValueError, match="too large"):
        hard_negatives(spark.createDataFrame([(0, [1e30], 1)], "vec_id long, embedding array<float>, label int"))


def test_bounds_hold_and_spare_scores():
    rng = np.random.default_rng(3)
    q = np.floor(256 * rng.normal(0, 0.125, (2000, 64))).astype(np.int32)
    q[:200] = q[0]
    block = Block(np.arange(2000), np.arange(2000), np.zeros(2000, bool), rng.integers(0, 4, 2000), q)
    anchors = np.floor(256 * rng.normal(0, 0.125, (20, 64))).astype(np.int32)
    lower, upper = block.bounds(anchors, 0, 2000)
    scores = (block.q.astype(np.int64) @ anchors.T.astype(np.int64)).T
    assert (lower <= scores).all() and (scores <= upper).all()
    fifth = np.sort(lower, axis=1)[:, -5]
    assert np.mean(upper >= fifth[:, None]) < 0.2  # rows that a search for five would score


# Decontamination.


def plain_words(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(docs: list[tuple], items: list[tuple], width: int) -> list[tuple[set, set]]:
    windows = defaultdict(set)
    for i, text in items:
        words = plain_words(text)
        for k in range(max(len(words) - width + 1, min(1, len(words)))):
            windows[tuple(words[k : k + width])].add(i)
    out = []
    for _, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if (own := windows.get(tuple(words[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((hit, found))
    return out


def leaky() -> tuple[list[tuple], list[tuple]]:
    rnd = random.Random(13)
    word = lambda: rnd.choice(["alpha", "Beta", "GAMMA", "été", "ÉTÉ", "x1", "2", "中文", "ß"])
    phrase = lambda n: "".join(word() + rnd.choice([" ", "-", ", ", "\n", "_", "` "]) for _ in range(n))
    items = [(k, phrase(rnd.choice([10, 12, 25]))) for k in range(30)] + [(100, "tiny item"), (101, "tiny ITEM."), (102, "solo"), (103, ""), (104, None), (105, "..."), (None, phrase(11)), (3, phrase(10)), (20, "twenty " * 14)]
    docs = [(0, None), (1, ""), (2, "?!"), (3, "SOLO"), (4, "a tiny-item b"), (5, "twenty " * 9), (6, "twenty " * 11)]
    for k in range(7, 120):
        text = phrase(rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 2)):
            text += str(items[rnd.randrange(len(items))][1]) + phrase(rnd.randint(0, 15))
        docs.append((rnd.choice([k, k, None, 9]), text))
    return docs + docs[-3:] * 3, items


@pytest.mark.parametrize(("width", "block"), [(10, 1 << 26), (10, 2000), (3, 1 << 26)])
def test_contamination(spark, width, block):
    docs, items = leaky()
    frame = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"))
    want: Counter = Counter()
    for (i, text), (hit, found) in zip(docs, plain_hits(docs, items, width), strict=True):
        names = sorted(str(x) for x in found if x is not None)
        want[i, len(plain_words(text)), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)] += 1
    assert Counter(tuple(r) for r in contamination(frame, bench, width, block).collect()) == want
    assert sum(n for x, n in want.items() if x[-1]) > 20
    assert not any(r.contaminated for r in contamination(frame, bench.limit(0), width).collect()) and contamination(frame, bench.limit(0)).count() == len(docs)
    assert contamination(frame.limit(0), bench).count() == 0


def test_decontaminated(spark):
    docs, items = leaky()
    frame, bench = clashing(spark.createDataFrame(docs, "doc_id long, text string")), spark.createDataFrame(items, "item_id long, text string")
    spans, whole = Counter(), Counter()
    for (i, text), (hit, _) in zip(docs, plain_hits(docs, items, 10), strict=True):
        if not hit:
            spans[i, text] += 1
            whole[i, text] += 1
            continue
        parts = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text)
        before = text[: len(text) - sum(map(len, parts))]
        spans[i, before + "".join(p for k, p in enumerate(parts) if k not in hit)] += 1
    for remove, want in (("spans", spans), ("documents", whole)):
        out = decontaminated(frame, bench, remove)
        assert out.columns == frame.columns
        assert Counter((r.doc_id, r.text) for r in out.collect()) == want
    with pytest.raises(ValueError, match="remove"):
        decontaminated(frame, bench, "words")


def test_decontamination_runs_no_python(spark):
    docs, items = leaky()
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plan = contamination(frame, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("BroadcastHashJoin") == 1
