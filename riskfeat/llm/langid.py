"""Language identification: a bidirectional gated recurrent network over bytes.

Texts are cut into segments of ``span`` bytes.  One network of gated units reads
each segment forwards and another backwards; at every byte both states give the
probabilities of the languages.  A document's probabilities are the means over
all its bytes.  Capitals (ASCII and Latin-1) are read as small letters.

Training is back-propagation through time in numpy with Adam, on at most
``max_rows`` labelled documents spread evenly over the languages, a few segments
of each.  Prediction is one scan; all segments of a slice advance together, so
a step is a handful of array operations.

Edge cases: a null text or one without a letter is ``und`` with score 0; if
nothing can be learned every text is; null ids and repeated rows are handled row
by row; very long texts are more segments; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.textops import LOWER, byte_view, slices

SLICE = 256 << 10  # bytes of text read together
UNDECIDED = "und"
MAX_LANGUAGES = 1000


def fold_case(data: np.ndarray) -> np.ndarray:
    out = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[after] += 0x20
    return out


@dataclass
class Net:
    """Weights of both directions (leading axis) and of the labelling layer."""

    e: np.ndarray  # (2, 256, 3H): what a byte adds to update gate, reset gate and candidate
    u: np.ndarray  # (2, H, 3H): what the state adds
    v: np.ndarray  # (2, H, C)
    c: np.ndarray  # (C,)
    langs: list[str] = field(default_factory=list)

    @staticmethod
    def fresh(hidden: int, langs: list[str], seed: int = 0) -> "Net":
        rng = np.random.default_rng(seed)
        make = lambda *s: (rng.normal(size=s) / np.sqrt(hidden)).astype(np.float32)
        return Net(make(2, 256, 3 * hidden), make(2, hidden, 3 * hidden), make(2, hidden, len(langs)), np.zeros(len(langs), np.float32), langs)

    @property
    def weights(self) -> tuple[np.ndarray, ...]:
        return self.e, self.u, self.v, self.c

    def states(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States after each step, (T, 2, B, H), of time-major bytes ``x`` (T, B)."""
        steps, b = x.shape
        hidden = self.u.shape[1]
        h = np.zeros((2, b, hidden), self.u.dtype)
        out = np.empty((steps, 2, b, hidden), self.u.dtype)
        a = np.empty((2, b, 3 * hidden), self.u.dtype)
        for t in range(steps):
            np.take(self.e[0], x[t], axis=0, out=a[0])
            np.take(self.e[1], x[steps - 1 - t], axis=0, out=a[1])
            g = np.matmul(h, self.u)
            gates = a[..., : 2 * hidden] + g[..., : 2 * hidden]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[..., :hidden], gates[..., hidden:]
            n = np.tanh(a[..., 2 * hidden :] + r * g[..., 2 * hidden :])
            if trace is not None:
                trace.append((h, z, r, n, g[..., 2 * hidden :]))
            h = out[t]
            if trace is None:
                np.subtract(out[t - 1] if t else 0, n, out=h)
            else:
                np.subtract(trace[-1][0], n, out=h)
            h *= z
            h += n
        return out

    def label(self, states: np.ndarray) -> np.ndarray:
        """Probabilities of the languages at every byte, (T, B, C)."""
        z = states[:, 0] @ self.v[0] + states[::-1, 1] @ self.v[1] + self.c
        z -= z.max(axis=-1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=-1, keepdims=True)
        return z

    def gradient(self, x: np.ndarray, y: np.ndarray, real: np.ndarray) -> tuple[float, tuple[np.ndarray, ...]]:
        """Mean log loss over real bytes and its gradient, by back-propagation through time."""
        steps, b = x.shape
        trace: list = []
        s = self.states(x, trace)
        p = self.label(s)
        n_real = max(1, int(real.sum()))
        pick = p[:, np.arange(b), y]
        loss = float(-(np.log(np.maximum(pick, 1e-12)) * real).sum() / n_real)
        d = p
        d[:, np.arange(b), y] -= 1
        d *= (real / n_real)[..., None].astype(d.dtype)
        dv = np.stack([np.einsum("tbh,tbc->hc", s[:, 0], d), np.einsum("tbh,tbc->hc", s[::-1, 1], d)])
        ds = np.stack([d @ self.v[0].T, (d @ self.v[1].T)[::-1]], axis=1)
        de, du = np.zeros_like(self.e), np.zeros_like(self.u)
        da = np.empty((steps, *trace[0][0].shape[:2], self.u.shape[2]), self.u.dtype)
        carry = np.zeros_like(trace[0][0])
        for t in range(steps - 1, -1, -1):
            h, z, r, n, gn = trace[t]
            dh = ds[t] + carry
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            da[t] = np.concatenate([dz, dr, dn], axis=-1)
            dg = np.concatenate([dz, dr, dn * r], axis=-1)
            du += np.matmul(h.transpose(0, 2, 1), dg)
            carry = dh * z + np.matmul(dg, self.u.transpose(0, 2, 1))
        for i, bytes_in in enumerate((x, x[::-1])):
            flat, g = bytes_in.ravel(), da[:, i].reshape(steps * b, -1)
            order = np.argsort(flat, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(flat[order].astype(np.int64)) > 0])
            de[i, flat[order][first]] = np.add.reduceat(g[order], first)
        return loss, (de, du, dv, d.sum(axis=(0, 1)))


def train(segments: np.ndarray, real: np.ndarray, y: np.ndarray, langs: list[str], hidden: int = 12, steps: int = 300, batch: int = 192, rate: float = 0.02) -> Net:
    """Adam over batches of segments (N, T); ``real`` marks bytes that are not padding."""
    net = Net.fresh(hidden, langs)
    rng = np.random.default_rng(1)
    m, v = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(y))])
        own, order = order[:batch], order[batch:]
        _, grads = net.gradient(np.ascontiguousarray(segments[own].T), y[own], np.ascontiguousarray(real[own].T))
        now = rate * (1 - step / (steps + 1))
        for w, g, a, b in zip(net.weights, grads, m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= (now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(w.dtype)
    return net


def cut(data: np.ndarray, offs: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each segment, its bytes (N, span) padded with zeros, and its length."""
    n = np.diff(offs)
    pieces = -(-n // span)
    row = np.repeat(np.arange(len(n)), pieces)
    at = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * span
    size = np.minimum(n[row] - at, span)
    out = np.zeros((len(row), span), np.uint8)
    inside = np.arange(span) < size[:, None]
    out[inside] = data
    return row, out, size


def fit(
    docs: DataFrame,
    fold: Column,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = 128,
    max_rows: int = 4_000,
    segments_each: int = 4,
    train_span: int = 64,
    **how,
) -> Net | None:
    """Network of the documents for which ``fold`` holds and that name a language."""
    rows = docs.where(fold & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(id_col).cast("long").alias("doc"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted(counts)
    if not langs:
        return None
    each = max(1, max_rows // len(langs))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, each / counts[k]))) for k in langs])
    # "about": a hash of the id chooses
    sample = rows.where(F.pmod(F.xxhash64("doc", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            data, offs = byte_view(b.column("text"))
            data = fold_case(data)
            doc, lang, seg = [], [], []
            for i, (d, k) in enumerate(zip(b.column("doc").to_pylist(), b.column("lang").to_pylist())):
                own = data[offs[i] : offs[i + 1]]
                for a in sorted({int(s) for s in np.linspace(0, max(0, len(own) - train_span), segments_each)}):
                    doc.append(d), lang.append(k), seg.append(own[a : a + train_span].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(lang), pa.array(seg, pa.binary())], ["doc", "lang", "seg"])

    got = sample.mapInArrow(run, "doc long, lang string, seg binary").toPandas().sort_values(["doc", "seg"], kind="stable")
    x = np.zeros((len(got), train_span), np.uint8)
    real = np.zeros((len(got), train_span), np.float32)
    for i, s in enumerate(got["seg"]):
        x[i, : len(s)] = np.frombuffer(s, np.uint8)
        real[i, : len(s)] = 1
    y = np.searchsorted(np.array(langs), got["lang"].to_numpy(dtype=str))
    return train(x, real, y, langs, **how)


def predict(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text", span: int = 128) -> DataFrame:
    """``(id, lang_pred, score, probabilities)`` per row, the last in the order of ``net.langs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            data, offs = byte_view(b.column("text"))
            total = np.zeros((b.num_rows, len(net.langs) if net else 0))
            if net is not None and len(data):
                row, seg, size = cut(fold_case(data), offs, span)
                order = np.argsort(-size, kind="stable")  # full segments together, so that padding is not read
                row, seg, size = row[order], seg[order], size[order]
                for at in range(0, len(row), 2048):
                    part = slice(at, at + 2048)
                    longest = int(size[at])
                    p = net.label(net.states(np.ascontiguousarray(seg[part, :longest].T)))
                    p *= (np.arange(longest)[:, None] < size[part])[..., None]
                    np.add.at(total, row[part], p.sum(axis=0, dtype=np.float64))
            letters = _has_letter(b.column("text"), data, offs) if net is not None else np.zeros(b.num_rows, bool)
            p = total / np.maximum(np.diff(offs), 1)[:, None]
            best = p.argmax(axis=1) if net is not None else np.zeros(b.num_rows, int)
            lang = [net.langs[k] if ok else UNDECIDED for k, ok in zip(best.tolist(), letters.tolist())]
            top = np.where(letters, np.clip(p.max(axis=1, initial=0.0), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(lang, pa.string()), pa.array(top), pa.array(p.tolist(), pa.list_(pa.float64()))], ["doc", "lang_pred", "score", "probabilities"]
            )

    out = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, f"doc {dict(out.dtypes)['doc']}, lang_pred string, score double, probabilities array<double>").withColumnRenamed("doc", id_col)


def _has_letter(texts: pa.Array, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    low = LOWER[data]
    seen = np.r_[0, np.cumsum((low >= 97) & (low <= 122))]
    out = seen[offs[1:]] > seen[offs[:-1]]
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(c.isalpha() for c in texts[i].as_py() or "")
    return out
