"""Quality classifier: a generalised additive model with pairwise interactions.

Features are shares and log counts of whole texts (byte classes, word and line
repetition, lengths).  Each is cut into bins at quantiles of the training rows.
Boosting goes round the features in turn; each step fits a tree of at most four
leaves on one feature's bins to the log-loss residuals and adds a small part of
it to that feature's lookup table.  The pairs of features that explain most of
what is left then get tables over both features' coarser bins, boosted in the
same way.  A score is the logistic function of a sum of table entries.

Fitting uses at most ``max_rows`` labelled training rows; scoring is one scan.

Edge cases: null and empty texts are scored like any other (all counts zero);
without training rows of both classes every score is the share of positive rows
(1 if there are none, so that nothing is rejected); null ids and repeated rows
are scored row by row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm import measures as M
from riskfeat.llm.labelled import bounded, marks, with_texts
from riskfeat.llm.textops import byte_view, slices

FEATURES = (
    "log_words", "log_words_a_line", "log_lines", "chars_a_word", "upper", "digits", "symbols", "stops", "bangs", "other", "non_ascii",
    "distinct", "after_itself", "repeated_lines", "repeated_words",
)


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text."""
    t = M.Texts(data, offs)
    k = t.kinds().astype(float)
    words = np.maximum(t.n_words, 1)
    chars = np.maximum(k[:, M.UPPER : M.MORE].sum(axis=1), 1)
    letters = np.maximum(k[:, M.UPPER] + k[:, M.LOW] + k[:, M.WIDE], 1)
    again = np.bincount(t.row[t.after_itself()], minlength=t.rows)
    lines = np.bincount(t.line_row[t.line_words > 0], minlength=t.rows)
    dup = np.bincount(t.line_row[t.repeated_lines()], minlength=t.rows)
    return np.stack([
        np.log1p(t.n_words), np.log1p(t.n_words / np.maximum(lines, 1)), np.log1p(lines), chars / words, k[:, M.UPPER] / letters,
        k[:, M.DIGIT] / chars, k[:, M.SYMBOL] / chars, k[:, M.STOP] / words, k[:, M.BANG] / words, k[:, M.OTHER] / chars, k[:, M.WIDE] / chars,
        t.distinct_words() / words, again / words, dup / np.maximum(lines, 1), t.repeated_words(8) / words,
    ], axis=1)


@dataclass
class Model:
    bias: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, f], side="right")]
        for i, j, t in self.pairs:
            z += t[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Bin edges just above the quantiles, half way to the next value, so that a common value has a bin."""
    values = np.unique(x)
    at = np.arange(1, len(values))
    if len(values) > bins:
        at = np.unique(np.searchsorted(values, np.quantile(x, np.arange(1, bins) / bins), side="right"))
        at = at[(at > 0) & (at < len(values))]
    return (values[at - 1] + values[at]) / 2


def _split(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> tuple[float, int]:
    """Best cut of a run of bins by gradient and curvature sums: gain, place."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    ok = (hl >= least) & (ht - hl >= least)
    if not ok.any():
        return 0.0, 0
    gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
    at = int(np.argmax(np.where(ok, gain, -1)))
    return max(float(gain[at]), 0.0), at + 1


def _tree(g: np.ndarray, h: np.ndarray, least: float = 2.0, ridge: float = 1.0) -> np.ndarray:
    """Leaf values of a depth-two tree over the bins of one feature."""
    out = np.full(len(g), g.sum() / (h.sum() + ridge))
    gain, cut = _split(g, h, least, ridge)
    for part in (slice(0, cut), slice(cut, len(g))) if gain > 0 else ():
        out[part] = g[part].sum() / (h[part].sum() + ridge)
        more, at = _split(g[part], h[part], least, ridge)
        if more > 0:
            for leaf in (slice(part.start, part.start + at), slice(part.start + at, part.stop)):
                out[leaf] = g[leaf].sum() / (h[leaf].sum() + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float = 2.0, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Leaf values of a depth-two tree over two features' bins (best order), and its gain."""
    best, value = -1.0, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        gain, cut = _split(a.sum(axis=1), b.sum(axis=1), least, ridge)
        if gain <= 0:
            continue
        out, total = np.zeros_like(a), gain
        for part in (slice(0, cut), slice(cut, len(a))):
            more, at = _split(a[part].sum(axis=0), b[part].sum(axis=0), least, ridge)
            total += more
            for leaf in (slice(0, at), slice(at, a.shape[1])) if more > 0 else (slice(0, a.shape[1]),):
                out[part, leaf] = a[part, leaf].sum() / (b[part, leaf].sum() + ridge)
        if total > best:
            best, value = total, out.T if flip else out
    return value, best


def train(x: np.ndarray, y: np.ndarray, bins: int = 32, coarse: int = 8, rounds: int = 200, pairs: int = 8, pair_rounds: int = 60, rate: float = 0.1) -> Model:
    """Cyclic boosting of single features, then of the strongest pairs."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    m = Model(float(np.log(share / (1 - share))))
    m.edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    m.coarse = [_edges(x[:, f], coarse) for f in range(x.shape[1])]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.edges)]
    z = np.full(len(y), m.bias)

    def push() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f, own in enumerate(at):
            r, c = push()
            n = len(m.tables[f])
            step = rate * _tree(np.bincount(own, r, n), np.bincount(own, c, n))
            m.tables[f] += step
            z += step[own]
    low = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.coarse)]
    shape = [len(e) + 1 for e in m.coarse]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        r, c = push()
        key = low[i] * shape[j] + low[j]
        return tuple(np.bincount(key, v, shape[i] * shape[j]).reshape(shape[i], shape[j]) for v in (r, c))

    gains = sorted(((_pair_tree(*sums(i, j))[1], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    m.pairs = [(i, j, np.zeros((shape[i], shape[j]))) for _, i, j in gains[:pairs]]
    for _ in range(pair_rounds):
        for i, j, t in m.pairs:
            step = rate * _pair_tree(*sums(i, j))[0]
            t += step
            z += step[low[i], low[j]]
    return m


def fit(docs: DataFrame, labels: DataFrame, fold: Column, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20_000, **how) -> Model:
    """Model of the labelled rows for which ``fold`` holds, on at most about ``max_rows`` of them."""
    marked = marks(labels, label, fold, id_col)
    count = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    sample = with_texts(docs, bounded(marked, "doc", sum(count.values()), max_rows), id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("y"), pa.array(features(*byte_view(b.column("text"))).tolist(), pa.list_(pa.float64()))], ["doc", "y", "x"]
            )

    got = sample.mapInArrow(run, "doc long, y int, x array<double>").toPandas().sort_values("doc", kind="stable")
    y = got["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Model(-40.0 if len(y) and not y[0] else 40.0)
    return train(np.array(got["x"].tolist()), y, **how)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` per row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(model.score(features(*byte_view(b.column("text")))))], ["doc", "score"])

    out = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, f"doc {dict(out.dtypes)['doc']}, score double").withColumnRenamed("doc", id_col)
