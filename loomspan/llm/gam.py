"""Quality classifier: a generalised additive model with pairwise interactions.

Features are cut to bins at quantiles. Boosting goes round the features in turn; each step fits a shallow tree on one feature's bins to the gradient of the
log loss and adds it, damped, to that feature's lookup table, so that no feature outruns the others. Then the pairs whose coarse grids lower the loss most get
tables of their own by the same cycle, with trees of one cut a side. A document's score is the logistic of an intercept and one table entry for each feature and pair, found and
added for whole columns at once.

Learning reads at most `sample` labelled rows (least hash of the id), none of them held out; text statistics are the only inputs. All rows are scored.

Defined results: a null text is empty and scored as such; without labels of both kinds every score is the labels' share of good (0.5 without any); repeated rows get
equal scores each; an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import label_sample, slices
from .text_stats import STATS, ratios, stats_of, text_stats


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class PairwiseGam:
    def __init__(self, bins: int = 48, rounds: int = 150, rate: float = 0.15, pairs: int = 8, coarse: int = 8, ridge: float = 2.0):
        self.n_bins, self.rounds, self.rate, self.n_pairs, self.coarse, self.ridge = bins, rounds, rate, pairs, coarse, ridge

    @staticmethod
    def _edges(x: np.ndarray, bins: int) -> np.ndarray:
        values = np.unique(x)
        if len(values) > bins:
            values = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))
            return values
        return (values[1:] + values[:-1]) / 2

    def _tree(self, g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
        """Values of a tree of a few leaves on bins in order, from sums of gradient and curvature."""
        parts = [(0, len(g))]
        worth = lambda a, b: a * a / (b + self.ridge)
        while len(parts) < leaves:
            best = (1e-9, None)
            for i, (a, b) in enumerate(parts):
                if b - a < 2:
                    continue
                cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
                gain = worth(cg[:-1], ch[:-1]) + worth(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - worth(cg[-1], ch[-1])
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), (i, a + k + 1))
            if best[1] is None:
                break
            i, at = best[1]
            a, b = parts[i]
            parts[i : i + 1] = [(a, at), (at, b)]
        out = np.zeros(len(g))
        for a, b in parts:
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + self.ridge)
        return out

    def _quadrants(self, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        """Gain and values of the best tree with one cut along each side of a grid."""
        cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
        parts = lambda c: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
        if min(g.shape) < 2:
            return 0.0, np.zeros(g.shape)
        pg, ph = parts(cg), parts(ch)
        gain = sum(a * a / (b + self.ridge) for a, b in zip(pg, ph, strict=True)) - cg[-1, -1] ** 2 / (ch[-1, -1] + self.ridge)
        i, j = np.unravel_index(int(gain.argmax()), gain.shape)
        values = [float(a[i, j] / (b[i, j] + self.ridge)) for a, b in zip(pg, ph, strict=True)]
        out = np.empty(g.shape)
        out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
        return float(gain[i, j]), out

    def fit(self, x: np.ndarray, y: np.ndarray) -> PairwiseGam:
        y = y.astype(float)
        share = float(y.mean()) if len(y) else 0.5
        self.edges = [self._edges(c, self.n_bins) for c in x.T] if len(x) else []
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.grids: list[np.ndarray] = []
        self.coarse_edges = [self._edges(c, self.coarse) for c in x.T] if len(x) else []
        self.base = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1)))
        if share in (0.0, 1.0) or not len(y):
            self.base = 0.0 if not len(y) else self.base
            self.edges, self.tables, self.coarse_edges = [], [], []
            return self
        codes = [np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)]
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for j, code in enumerate(codes):
                p = _logistic(f)
                n = len(self.tables[j])
                step = self.rate * self._tree(np.bincount(code, y - p, n), np.bincount(code, p * (1 - p), n))
                self.tables[j] += step
                f += step[code]
        coarse = [np.searchsorted(e, c, side="left") for e, c in zip(self.coarse_edges, x.T, strict=True)]
        sizes = [len(e) + 1 for e in self.coarse_edges]

        def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
            p = _logistic(f)
            code, n = coarse[i] * sizes[j] + coarse[j], sizes[i] * sizes[j]
            return np.bincount(code, y - p, n).reshape(sizes[i], sizes[j]), np.bincount(code, p * (1 - p), n).reshape(sizes[i], sizes[j])

        gains = sorted(((self._quadrants(*sums(i, j))[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
        self.pairs = [(i, j) for gain, i, j in gains[: self.n_pairs] if gain > 0]
        self.grids = [np.zeros((sizes[i], sizes[j])) for i, j in self.pairs]
        for _ in range(self.rounds // 3):
            for k, (i, j) in enumerate(self.pairs):
                step = self.rate * self._quadrants(*sums(i, j))[1]
                self.grids[k] += step
                f += step[coarse[i], coarse[j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        for e, t, c in zip(self.edges, self.tables, x.T, strict=False):
            f += t[np.searchsorted(e, c, side="left")]
        if self.pairs:
            coarse = [np.searchsorted(e, c, side="left") for e, c in zip(self.coarse_edges, x.T, strict=True)]
            for (i, j), grid in zip(self.pairs, self.grids, strict=True):
                f += grid[coarse[i], coarse[j]]
        return _logistic(f)


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: CRC-32 of the id as text divisible by 5."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of each row. labels: doc_id, quality."""
    chosen = label_sample(labels.where(~held_out()), sample)  # bounded, so it may be broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.struct("doc_id", "quality").alias("doc_id"), "text")
    rows = text_stats(found).select("doc_id.*", *STATS).orderBy("doc_id", *STATS).limit(2 * sample).toPandas()  # repeated ids may give an id more rows
    model = docs.sparkSession.sparkContext.broadcast(PairwiseGam().fit(ratios(rows[STATS].to_numpy()), rows["quality"].to_numpy()))

    def score(batches):
        for batch in batches:
            for first, texts in slices(batch):
                s = model.value.score(ratios(np.array([stats_of(t) for t in texts], np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.select("doc_id", "text").mapInArrow(score, T.StructType(fields)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
