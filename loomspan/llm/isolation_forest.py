"""Quality rules: two fixed base rules, then an isolation forest on rule statistics.

The forest (Liu, Ting and Zhou 2008) splits small samples at random; a document that few splits isolate is an anomaly. It is grown on labelled documents of
good quality, with split ranges widened beyond the sample's, so that what good documents never show ends in an empty leaf early. The threshold on the anomaly score
is calibrated on labelled documents of either kind: of all cuts, that with the greatest recall of bad ones less `caution` times the loss of good ones.

Learning takes in all labelled rows that pass the base rules, by Spark: each tree's rows are drawn from all good ones by their places in a total order, split ranges are widened by the spread of
all good ones, and the threshold is the best of all cuts between the scores of all. The driver gets the rows of the trees (256 each, as the method has it) and single figures.
Without labelled rows of both kinds the base rules decide alone.

Defined results: a null or empty text has no words and fails; ties and repeated rows get equal verdicts each; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, in_total_order, known_labels, slices
from .text_stats import FEATURES, STATS, ratios, stats_of, text_stats


def mean_path(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    def __init__(self, trees: int = 100, rows: int = 256, seed: int = 1):
        self.trees, self.rows, self.seed = trees, rows, seed

    def fit(self, x: np.ndarray, widen: float = 1.0) -> IsolationForest:
        """widen: share of a feature's spread over all rows by which a node's range is stretched."""
        return self.grow(len(x), x.max(axis=0) - x.min(axis=0), lambda rnd, tree: x[rnd.choice(len(x), min(self.rows, len(x)), replace=False)], widen)

    def grow(self, n_rows: int, spread: np.ndarray, drawn: Callable[[np.random.Generator, int], np.ndarray], widen: float = 1.0) -> IsolationForest:
        """From the rows drawn for each tree of n_rows in all, whose features have the given spread."""
        rnd = np.random.default_rng(self.seed)
        self.norm = float(mean_path(min(self.rows, n_rows))) or 1.0
        depth = math.ceil(math.log2(max(2, min(self.rows, n_rows))))
        spread = np.maximum(spread, 1e-3) * widen
        n = 2 ** (depth + 1) - 1
        self.feature = np.full((self.trees, n), -1)
        self.at = np.zeros((self.trees, n))
        self.length = np.zeros((self.trees, n))
        for t in range(self.trees):
            stack = [(0, drawn(rnd, t), 0)]
            while stack:
                node, own, d = stack.pop()
                if d == depth or len(own) <= 1:
                    self.length[t, node] = d + float(mean_path(len(own)))
                    continue
                f = int(rnd.integers(len(spread)))
                low, high = own[:, f].min() - spread[f] * rnd.random(), own[:, f].max() + spread[f] * rnd.random()
                cut_at = rnd.uniform(low, high)
                self.feature[t, node], self.at[t, node] = f, cut_at
                left = own[:, f] < cut_at
                stack += [(2 * node + 1, own[left], d + 1), (2 * node + 2, own[~left], d + 1)]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the higher, the fewer splits isolate a row."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            while True:
                f = self.feature[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= self.at[t, node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += self.length[t, node]
        return 2.0 ** (-total / self.trees / self.norm)


def calibrate(score: np.ndarray, good: np.ndarray, caution: float) -> float:
    """The least score that is rejected."""
    order = np.argsort(-score, kind="stable")
    bad_share = np.cumsum(~good[order]) / max(1, (~good).sum())
    good_share = np.cumsum(good[order]) / max(1, good.sum())
    s = score[order]
    last = np.append(s[1:] != s[:-1], True)
    gain = np.where(last, bad_share - caution * good_share, -np.inf)
    k = int(np.argmax(gain))
    return math.inf if gain[k] <= 0 else float(s[k] if k + 1 == len(s) else (s[k] + s[k + 1]) / 2)


#: Cells of scores, within each of which a running sum goes over its own scores alone.
CELLS = 4096


def calibrated(scored: DataFrame, n_good: int, n_bad: int, caution: float) -> float:
    """calibrate over a table of score and good: what goes before a cell of scores is a sum over cells, so no task has all rows."""
    n = cut(scored.groupBy("score").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"), F.floor(F.first("score") * CELLS).alias("cell")))
    higher = W.orderBy(F.desc("cell")).rowsBetween(W.unboundedPreceding, -1)  # over CELLS rows
    cells = n.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))
    before = cells.select("cell", *(F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"{c}_before") for c in "gb"))
    within = W.partitionBy("cell").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    share = lambda c, total: (F.sum(c).over(within) + F.col(f"{c}_before")) / F.lit(float(total))
    best = n.join(before, "cell").select("score", (share("b", n_bad) - F.lit(caution) * share("g", n_good)).alias("gain")).orderBy(F.desc("gain"), F.desc("score")).first()
    if best["gain"] <= 0:
        return math.inf
    lower = n.where(F.col("score") < best["score"]).agg(F.max("score")).first()[0]
    return best["score"] if lower is None else (best["score"] + lower) / 2


def learnable(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, good and FEATURES of all labelled rows that pass the base rules, from doc_id and STATS. Labels may be many, so none of the two sides is broadcast."""
    rows = stats.join(known_labels(labels).hint("merge"), "doc_id").select("doc_id", (F.col("quality") == 1).alias("good"), *STATS)
    out = T.StructType([rows.schema["doc_id"], rows.schema["good"], *(T.StructField(n, T.DoubleType()) for n in FEATURES)])

    def features(batches):
        for batch in batches:
            stats = np.column_stack([batch.column(2 + i).to_numpy() for i in range(len(STATS))])
            ok = ~base_failed(stats)
            kept = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), *(pa.array(x) for x in ratios(stats[ok]).T)], out.names)

    return rows.mapInArrow(features, out)


def fit_rules(stats: DataFrame, labels: DataFrame, caution: float = 10.0) -> tuple[IsolationForest, float] | None:
    """Forest and threshold from all labelled documents' doc_id and STATS, or None where they are not of both kinds."""
    rows = cut(learnable(stats, labels))
    good = rows.where("good")
    n_good, n_bad = rows.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    if not n_good or not n_bad:
        return None
    spread = np.array(good.agg(*(F.max(c) - F.min(c) for c in FEATURES)).first(), float)
    forest = IsolationForest()
    rnd = np.random.default_rng([forest.seed, 1])
    draws = [rnd.choice(n_good, min(forest.rows, n_good), replace=False) for _ in range(forest.trees)]
    places = np.unique(np.concatenate(draws))
    wanted = stats.sparkSession.createDataFrame(pd.DataFrame({"_rank": places}), "_rank long")  # bounded by the forest's size
    drawn = in_total_order(good, ["doc_id", *FEATURES]).join(F.broadcast(wanted), "_rank").select("_rank", *FEATURES).toPandas().sort_values("_rank")[FEATURES].to_numpy()
    shared = stats.sparkSession.sparkContext.broadcast(forest.grow(n_good, spread, lambda _, t: drawn[np.searchsorted(places, draws[t])]))

    def score(batches):
        for batch in batches:
            x = np.column_stack([batch.column(1 + i).to_numpy() for i in range(len(FEATURES))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], ["good", "score"])

    return forest, calibrated(rows.select("good", *FEATURES).mapInArrow(score, "good boolean, score double"), n_good, n_bad, caution)


def base_failed(stats: np.ndarray) -> np.ndarray:
    """Too few words, or over a fifth of them in repeated windows."""
    return (stats[:, 0] < 10) | (100 * stats[:, 4] > 20 * stats[:, 0])


def verdicts(stats: np.ndarray, model: tuple[IsolationForest, float] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, anomaly, kept."""
    failed = base_failed(stats)
    if model is None or not len(stats):
        return failed, np.zeros(len(stats)), ~failed
    forest, most = model
    anomaly = forest.score(ratios(stats))
    return failed, anomaly, ~failed & (anomaly < most)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, STATS, base_failed, anomaly, kept of each row. labels: doc_id, quality (1 good, 0 bad). Texts are read once: the rules learn and judge from the stored statistics."""
    rows = cut(text_stats(docs))
    shared = docs.sparkSession.sparkContext.broadcast(fit_rules(rows, labels))
    fields = [*rows.schema, T.StructField("base_failed", T.BooleanType()), T.StructField("anomaly", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    names = [f.name for f in fields]

    def judge(batches):
        for batch in batches:
            stats = np.column_stack([batch.column(1 + i).to_numpy() for i in range(len(STATS))])
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, verdicts(stats, shared.value))], names)

    return rows.mapInArrow(judge, T.StructType(fields))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, all columns as they are; no text is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_rules(text_stats(docs), labels))
    at = docs.columns.index("text")

    def judge(batches):
        for batch in batches:
            for first, texts in slices(batch, f"c{at}"):
                stats = np.array([stats_of(t) for t in texts], np.int64)
                yield batch.slice(first, len(texts)).filter(pa.array(verdicts(stats, shared.value)[2]))

    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # any names may stand in docs
    return numbered.mapInArrow(judge, numbered.schema).toDF(*docs.columns)
