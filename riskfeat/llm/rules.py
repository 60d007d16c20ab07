"""Quality rules: a linear-chain conditional random field over a text's lines.

Each non-blank line is described by discrete measures (length, case, symbols,
punctuation, repetition, ...).  The field marks the lines as content or
boilerplate: emission weights for the measures, transition weights between
neighbouring lines; Viterbi decoding finds the best marking of a whole text.
A text is kept when content lines hold at least ``min_share`` of its words.

There are no line labels, so the field is trained by distant supervision: on a
bounded sample of different texts (``max_rows``), lines that meet one of the ``seed``
rules (symbols, capitals, bars, words repeated or cut by marks, equal lines)
count as boilerplate, the others as content; the weights are
fitted by the gradient of the conditional likelihood (forward-backward over all
texts of the sample at once).  The seed rules are given to the field only
through the measures, never as an answer.

Edge cases: a null or empty text has no line and is not kept; blank lines have
no mark and do not interrupt the chain; null ids and repeated rows are handled
row by row; an empty table trains to a field that marks all as content; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm import measures as M
from riskfeat.llm.labelled import bounded
from riskfeat.llm.textops import byte_view, slices
from riskfeat.session import checkpoint

CONTENT, BOILERPLATE = 0, 1
#: bin edges of each measure
EDGES = {
    "words": (1, 2, 4, 8, 16, 32, 64), "word_length": (2, 4, 6, 8, 12, 20), "upper": (0.05, 0.15, 0.3, 0.6, 0.9), "symbols": (0.001, 0.02, 0.05, 0.1, 0.2, 0.4),
    "stops": (0.001, 0.05, 0.1, 0.3, 0.6), "bangs": (0.001, 0.05, 0.2, 0.5), "digits": (0.001, 0.02, 0.1, 0.3), "other": (0.001, 0.02, 0.1, 0.3),
    "after_itself": (0.001, 0.1, 0.3, 0.6), "again": (0.5,), "stop_at_end": (0.5,), "upper_at_start": (0.5,), "mark_words": (0.001, 0.1, 0.3, 0.6),
}
WIDTH = [len(e) + 1 for e in EDGES.values()]
BASE = np.cumsum([0, *WIDTH])[:-1]
SIZE = sum(WIDTH)


def lines(data: np.ndarray, offs: np.ndarray) -> tuple[M.Texts, np.ndarray, np.ndarray, np.ndarray]:
    """The texts, their non-blank lines, each line's active weights, and its seed mark."""
    t = M.Texts(data, offs)
    some = np.flatnonzero(t.line_words > 0)
    k = t.kinds(by_line=True)[some].astype(float)
    n = t.line_words[some].astype(float)
    chars = np.maximum(k[:, M.UPPER : M.MORE].sum(axis=1), 1)
    letters = np.maximum(k[:, M.UPPER] + k[:, M.LOW] + k[:, M.WIDE], 1)
    per_line = lambda mask: np.bincount(t.line[mask], minlength=len(t.line_row))[some]
    last = M.KIND[data[t.end - 1]] if len(t.end) else np.zeros(0, np.uint8)
    first = M.KIND[data[t.start]] if len(t.start) else np.zeros(0, np.uint8)
    at_end, at_start = np.r_[t.line[1:] != t.line[:-1], True][: len(t.line)], np.r_[True, t.line[1:] != t.line[:-1]][: len(t.line)]
    marked = (last == M.SYMBOL) | (last == M.BANG)
    again = t.repeated_lines()[some].astype(float)
    measure = {
        "words": n, "word_length": chars / n, "upper": k[:, M.UPPER] / letters, "symbols": k[:, M.SYMBOL] / chars, "stops": k[:, M.STOP] / n,
        "bangs": k[:, M.BANG] / n, "digits": k[:, M.DIGIT] / chars, "other": k[:, M.OTHER] / chars, "after_itself": per_line(t.after_itself()) / n,
        "again": again, "stop_at_end": per_line((last == M.STOP) & at_end).astype(float), "upper_at_start": per_line((first == M.UPPER) & at_start).astype(float),
        "mark_words": per_line(marked) / n,
    }
    active = np.stack([np.searchsorted(e, measure[f], side="right") + b for (f, e), b in zip(EDGES.items(), BASE)], axis=1)
    seed = (
        (measure["symbols"] > 0.05) | ((measure["upper"] > 0.6) & (n >= 3)) | (measure["mark_words"] > 0.3) | (measure["bangs"] > 0.3)
        | ((measure["after_itself"] > 0.3) & (n >= 4)) | (again > 0)
    )
    return t, some, active, seed


@dataclass
class Field:
    emit: np.ndarray  # (SIZE, 2)
    move: np.ndarray  # (2, 2): from, to
    start: np.ndarray  # (2,)


def chains(row: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """First line of each chain, longest chain first; per step, the lines at that step."""
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    n = np.diff(np.r_[first, len(row)])
    order = np.argsort(-n, kind="stable")
    first, n = first[order], n[order]
    alive = np.searchsorted(-n, -np.arange(int(n.max(initial=0))), side="left")
    return first, [first[:m] + i for i, m in enumerate(alive.tolist())]


def viterbi(emission: np.ndarray, row: np.ndarray, field: Field) -> np.ndarray:
    """Best marking of every chain; all chains advance together."""
    _, steps = chains(row)
    mark = np.zeros(len(row), np.int64)
    if not steps:
        return mark
    best = np.empty_like(emission)
    came = np.zeros((len(row), 2), np.int64)
    best[steps[0]] = field.start + emission[steps[0]]
    for before, now in zip(steps, steps[1:]):
        through = best[before[: len(now)], :, None] + field.move
        came[now] = through.argmax(axis=1)
        best[now] = through.max(axis=1) + emission[now]
    for i in range(len(steps) - 1, -1, -1):
        now = steps[i]
        go_on = len(steps[i + 1]) if i + 1 < len(steps) else 0
        ends = now[go_on:]
        mark[ends] = best[ends].argmax(axis=1)
        if go_on:
            after = steps[i + 1]
            mark[now[:go_on]] = came[after, mark[after]]
    return mark


def expectations(emission: np.ndarray, row: np.ndarray, field: Field) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log partition sum, line marginals, summed pair marginals, summed start marginals."""
    _, steps = chains(row)
    forward, backward = np.empty_like(emission), np.zeros_like(emission)
    lse = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    forward[steps[0]] = field.start + emission[steps[0]]
    for before, now in zip(steps, steps[1:]):
        forward[now] = lse(forward[before[: len(now)], :, None] + field.move, 1) + emission[now]
    log_z = np.zeros(len(row))
    for i in range(len(steps) - 1, -1, -1):
        now = steps[i]
        go_on = len(steps[i + 1]) if i + 1 < len(steps) else 0
        ends = now[go_on:]
        log_z[ends] = lse(forward[ends], 1)
        if go_on:
            after = steps[i + 1]
            backward[now[:go_on]] = lse(field.move + (emission[after] + backward[after])[:, None, :], 2)
            log_z[now[:go_on]] = log_z[after]
    line = np.exp(forward + backward - log_z[:, None])
    pair = np.zeros((2, 2))
    for before, now in zip(steps, steps[1:]):
        b = before[: len(now)]
        pair += np.exp(forward[b, :, None] + field.move + (emission[now] + backward[now])[:, None, :] - log_z[now, None, None]).sum(axis=0)
    return float(log_z[steps[0]].sum()), line, pair, line[steps[0]].sum(axis=0)


def train(active: np.ndarray, row: np.ndarray, mark: np.ndarray, steps: int = 120, l2: float = 1.0, rate: float = 0.1) -> Field:
    """Weights of highest penalised conditional likelihood, by Adam."""
    field = Field(np.zeros((SIZE, 2)), np.zeros((2, 2)), np.zeros(2))
    if not len(row):
        field.start[CONTENT] = 1.0
        return field
    same = np.flatnonzero(row[1:] == row[:-1])
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    seen_pair = np.bincount(mark[same] * 2 + mark[same + 1], minlength=4).reshape(2, 2)
    seen_start = np.bincount(mark[first], minlength=2)
    seen = np.zeros((SIZE, 2))
    for col in active.T:
        np.add.at(seen, (col, mark), 1)
    parts = (field.emit, field.move, field.start)
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        emission = field.emit[active].sum(axis=1)
        _, line, pair, start = expectations(emission, row, field)
        want = np.stack([sum(np.bincount(col, line[:, s], SIZE) for col in active.T) for s in (0, 1)], axis=1)
        for p, g, a, b in zip(parts, (seen - want, seen_pair - pair, seen_start - start), m, v):
            g = g - l2 * p
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            p += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return field


def draw(docs: DataFrame, text_col: str = "text", max_rows: int = 4_000, max_lines: int = 200_000) -> DataFrame:
    """``(key, n, active, seed)`` of about ``max_rows`` different texts, each once.

    Texts are drawn by their hash, out of about as many as there are different
    ones.  A task sends a text once however often it meets it, so a text that
    fills a third of the table costs a row per task.  Texts of more than
    ``max_lines`` non-blank lines are not drawn.
    """
    d = docs.select(F.col(text_col).cast("string").alias("text")).where(F.length("text") > 0).withColumn("key", F.xxhash64("text"))

    def unseen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # at most the keys drawn
        for b in batches:
            new = []
            for k in b.column("key").to_pylist():
                new.append(k not in sent)
                sent.add(k)
            yield b.filter(pa.array(new, pa.bool_()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(unseen(batches), "text"):
            t, some, active, seed = lines(*byte_view(b.column("text")))
            cut = np.searchsorted(t.line_row[some], np.arange(t.rows + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(np.diff(cut).astype(np.int64)),
                 pa.array([active[x:y].astype("<u1").tobytes() for x, y in zip(cut, cut[1:])], pa.binary()),
                 pa.array([seed[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary())],
                ["key", "n", "active", "seed"],
            )

    different = d.agg(F.approx_count_distinct("key", 0.02)).first()[0]
    out = bounded(d, "key", different, max_rows).mapInArrow(run, "key long, n long, active binary, seed binary")
    return checkpoint(out.where(F.col("n") <= max_lines).dropDuplicates(["key"]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 4_000, max_lines: int = 200_000) -> Field:
    """Field of about ``max_rows`` different texts, in the order of their hashes up to ``max_lines`` lines."""
    drawn = draw(docs, text_col, max_rows, max_lines)
    sizes = drawn.select("key", "n").toPandas().sort_values("key")
    keys = sizes["key"][sizes["n"].cumsum() <= max_lines]
    got = drawn.where(F.col("key") <= int(keys.max())) if len(keys) else drawn.limit(0)
    got = got.toPandas().sort_values("key")
    active = np.frombuffer(b"".join(got["active"]), "<u1").astype(np.int64).reshape(-1, len(EDGES))
    mark = np.frombuffer(b"".join(got["seed"]), "?").astype(np.int64)
    row = np.repeat(np.arange(len(got)), got["n"].to_numpy(dtype=np.int64))
    return train(active, row, mark)


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", window: int = 8, min_share: float = 0.5) -> DataFrame:
    """Counts and the field's verdict per row of ``docs``.

    ``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_content_lines, content_words, marks, content)``; ``marks`` has a letter per
    line (``c``, ``b``, ``-`` for blank) and ``content`` is the verdict.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content_lines", "content_words"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            t, some, active, _ = lines(*byte_view(b.column("text")))
            mark = viterbi(field.emit[active].sum(axis=1), t.line_row[some], field)
            good = some[mark == CONTENT]
            letters = np.full(len(t.line_row), ord("-"), np.uint8)
            letters[some] = np.where(mark == CONTENT, ord("c"), ord("b"))
            edge = np.r_[t.first_line, len(t.line_row)]
            k = t.kinds()
            content = np.bincount(t.line_row[good], t.line_words[good], t.rows).astype(np.int64)
            cols = [
                t.n_words, k[:, M.UPPER : M.MORE].sum(axis=1), k[:, M.SYMBOL], np.bincount(t.line_row[t.repeated_lines()], minlength=t.rows),
                t.repeated_words(window), t.n_lines, np.bincount(t.line_row[good], minlength=t.rows), content,
            ]
            marks = [letters[x:y].tobytes().decode() for x, y in zip(edge.tolist(), edge[1:].tolist())]
            verdict = (t.n_words > 0) & (content >= min_share * t.n_words)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), *(pa.array(c.astype(np.int64)) for c in cols), pa.array(marks, pa.string()), pa.array(verdict)],
                ["doc", *names, "marks", "content"],
            )

    out = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc {dict(out.dtypes)['doc']}, " + ", ".join(f"{n} long" for n in names) + ", marks string, content boolean"
    return out.mapInArrow(run, schema).withColumnRenamed("doc", id_col)
