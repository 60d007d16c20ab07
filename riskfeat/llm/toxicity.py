"""Toxicity: character n-gram linear classifier on naive Bayes scaled features.

Features are the presence of byte n-grams (A-Z lower-cased, separators as one
space each) hashed to ``2 ** BUCKET_BITS`` buckets.  Document counts by class
over all training rows give the naive Bayes log-count ratio of every bucket;
logistic regression with an L2 penalty is then fitted on presence times ratio.
The buckets that tell the classes apart (by the ratio's standard error) enter
the regression, which is fitted on at most ``max_rows`` training rows.

Scoring is one pass of array operations over the bytes of whole texts.

Edge cases: null and empty texts have no n-gram and get the model's base score;
without training rows of both classes every score is the share of positive
training rows (0 if there are none); null ids and repeated rows are scored row
by row; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.labelled import bounded, marks, with_texts
from riskfeat.llm.textops import IS_SEP, LOWER, MULT, byte_view, pack, slices, unpack

BUCKET_BITS = 21
ORDERS = (3, 4, 5, 6)
CHUNKS = 64  # of the bucket range, each summed by one task
PART = 1 << 19  # features of rows that a pass of the regression takes at once


@dataclass
class Model:
    bias: float
    bucket: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float64))


_FOLD = LOWER.copy()
_FOLD[IS_SEP] = 0x20


def gram_buckets(data: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte (too short ends are left out)."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code = np.full(n, order, np.uint64)
    for j in range(order):
        code = (code << np.uint64(8)) | data[j : j + n]
    return ((code * MULT) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _hits(data: np.ndarray, offs: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) of the n-grams whose bucket is wanted."""
    folded = _FOLD[data].astype(np.uint64)
    found = []
    for order in ORDERS:
        b = gram_buckets(folded, order)
        at = np.flatnonzero(wanted[b])
        row = np.searchsorted(offs, at, side="right") - 1
        inside = at + order <= offs[row + 1]
        found.append((row[inside] << BUCKET_BITS) | b[at[inside]])
    key = np.unique(np.concatenate(found))
    return key >> BUCKET_BITS, key & ((1 << BUCKET_BITS) - 1)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by class that have each bucket, as blobs by chunk of the range."""
    size = 1 << BUCKET_BITS
    have = np.zeros((2, size), np.uint32)
    stamp = np.zeros(size, np.int64)
    for b in slices(batches, "text"):
        data, offs = byte_view(b.column("text"))
        folded = _FOLD[data].astype(np.uint64)
        for i, y in enumerate(b.column("y").to_pylist()):
            own = folded[offs[i] : offs[i + 1]]
            g = np.concatenate([gram_buckets(own, o) for o in ORDERS])
            place = np.arange(len(g))
            stamp[g] = place  # the last one to write a bucket stands for it
            have[y][g[stamp[g] == place]] += 1
    per = size // CHUNKS
    out = []
    for c in range(CHUNKS):
        part = have[:, c * per : (c + 1) * per]
        at = np.flatnonzero(part.any(axis=0))
        if len(at):
            gaps = np.diff(at, prepend=0)
            out.append((c, *(pack(x.astype("<u4")) for x in (gaps, part[0, at], part[1, at]))))
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(("chunk", "at", "neg", "pos"), r)) for r in out], schema=_BLOBS)


_BLOBS = pa.schema([("chunk", pa.int32()), ("at", pa.binary()), ("neg", pa.binary()), ("pos", pa.binary())])


def _select(n_neg: int, n_pos: int, per_chunk: int, min_z: float):
    """Sum a chunk's counts; keep its buckets whose ratio is sure."""

    def one(t: pa.Table) -> pa.Table:
        chunk = t.column("chunk")[0].as_py()
        per = (1 << BUCKET_BITS) // CHUNKS
        have = np.zeros((2, per), np.int64)
        for at, neg, pos in zip(*(t.column(c).to_pylist() for c in ("at", "neg", "pos"))):
            at, neg, pos = (unpack(x, "<u4") for x in (at, neg, pos))
            at = np.cumsum(at)
            have[0, at] += neg
            have[1, at] += pos
        q, p = have[0] + 1.0, have[1] + 1.0
        ratio = np.log(p / (n_pos + 2.0)) - np.log(q / (n_neg + 2.0))
        z = np.abs(ratio) / np.sqrt(1 / p + 1 / q)
        best = np.argsort(-z, kind="stable")[:per_chunk]
        best = best[(z[best] >= min_z) & (have[:, best].sum(axis=0) >= 3)]
        return pa.table({"bucket": best + chunk * per, "ratio": ratio[best], "z": z[best]})

    return one


def _regress(size: np.ndarray, col: np.ndarray, ratio: np.ndarray, y: np.ndarray, l2: float, steps: int) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ratio, by Adam over all rows.

    ``col`` holds the features of row after row, ``size`` of each; the passes go
    over blocks of rows, so that nothing wider than ``col`` is as long as it.
    """
    n = len(y)
    end = np.cumsum(size)
    cut = np.unique(np.r_[0, np.searchsorted(end, np.arange(PART, int(end[-1]), PART)), n])
    parts = [(lo, hi, col[end[lo] - size[lo] : end[hi - 1]]) for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist())]
    w, b = np.zeros(len(ratio)), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    m, v = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for t in range(1, steps + 1):
        each, back, off = w * ratio, np.zeros(len(ratio)), 0.0
        for lo, hi, c in parts:
            row = np.repeat(np.arange(hi - lo), size[lo:hi])
            z = np.bincount(row, weights=each[c], minlength=hi - lo) + b
            err = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[lo:hi]
            back += np.bincount(c, weights=err[row], minlength=len(ratio))
            off += err.sum()
        g = np.append(ratio * back + l2 * w, off)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit(
    docs: DataFrame,
    labels: DataFrame,
    fold: Column,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    features: int = 1 << 14,
    min_z: float = 4.0,
    max_rows: int = 20_000,
    l2: float = 0.3,
    steps: int = 400,
) -> Model:
    """Counts over all training rows; the regression over at most ``max_rows`` of them."""
    rows = with_texts(docs, marks(labels, label, fold, id_col), id_col, text_col)
    count = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_neg, n_pos = count.get(0, 0), count.get(1, 0)
    if not n_neg or not n_pos:
        share = n_pos / max(1, n_neg + n_pos)
        return Model(float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share else -40.0))
    blobs = rows.select("text", "y").mapInArrow(_count, "chunk int, at binary, neg binary, pos binary")
    picked = blobs.groupBy("chunk").applyInArrow(_select(n_neg, n_pos, 4 * features // CHUNKS, min_z), "bucket long, ratio double, z double")
    best = picked.orderBy(F.desc("z"), "bucket").limit(features).select("bucket", "ratio").toPandas().sort_values("bucket")
    bucket, ratio = best["bucket"].to_numpy(), best["ratio"].to_numpy()
    if not len(bucket):
        return Model(float(np.log(n_pos / n_neg)))

    def present(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BUCKET_BITS, bool)
        wanted[bucket] = True
        for b in slices(batches, "text"):
            data, offs = byte_view(b.column("text"))
            row, got = _hits(data, offs, wanted)
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            at = np.searchsorted(bucket, got).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [b.column("y"), pa.array([at[cut[i] : cut[i + 1]].tobytes() for i in range(b.num_rows)], pa.binary())], ["y", "at"]
            )

    sample = bounded(rows, "doc", n_neg + n_pos, max_rows).select("text", "y").mapInArrow(present, "y int, at binary").toPandas()
    y, size = sample["y"].to_numpy(float), np.array([len(x) // 2 for x in sample["at"]], np.int64)
    col = np.frombuffer(b"".join(sample.pop("at")), "<u2")
    w, b = _regress(size, col, ratio, y, l2, steps)
    return Model(b, bucket, w * ratio)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` per row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << BUCKET_BITS)
        weight[model.bucket] = model.weight
        wanted = weight != 0
        for b in slices(batches, "text"):
            data, offs = byte_view(b.column("text"))
            row, got = _hits(data, offs, wanted)
            z = model.bias + np.bincount(row, weights=weight[got], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc", "score"])

    out = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = dict(out.dtypes)["doc"]
    return out.mapInArrow(run, f"doc {kind}, score double").withColumnRenamed("doc", id_col)


def keep_clean(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is under ``threshold``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << BUCKET_BITS)
        weight[model.bucket] = model.weight
        for b in slices(batches, text_col):
            data, offs = byte_view(b.column(text_col))
            row, got = _hits(data, offs, weight != 0)
            z = model.bias + np.bincount(row, weights=weight[got], minlength=b.num_rows)
            yield b.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))) < threshold))

    return docs.mapInArrow(run, docs.schema)
