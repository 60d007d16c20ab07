"""Language-model scoring with a weighted backoff automaton.

The model is a smoothed bigram model over lower-cased words and the end of the
text, written as an automaton: a state per known word (the last word read), a
start state, and the root.  A bigram seen in training is an arc out of its
first word's state; every state has a failure arc to the root, whose arcs are
the unigrams and the unknown word.  With ``c`` the training counts and

    p(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w | h) = (c(h w) + k p(w)) / (c(h) + k)

the arc weighs ``log10 p(w | h)`` and the failure arc ``log10 k / (c(h) + k)``,
so that a word not seen after ``h`` costs the failure arc plus its root arc and
every state's probabilities sum to one.  ``k`` is the grid value that gives the
training tokens the highest likelihood, each left out of the counts in turn.

Distribution: texts are cut into blocks of about ``BLOCK_TOKENS`` tokens (a long
text into several; a piece starts in the state the one before ends in).  A
block sends its distinct unigrams and bigrams, with training counts, to buckets
by hash; a bucket adds them up and answers each block with the totals of just
the n-grams it asked for.  The block builds its part of the automaton from the
answer and reads its texts once, left to right.  Counts are pre-aggregated per
block and packed, so a frequent word is one entry per block; no task and no
driver ever holds the whole model.  Words and bigrams are told apart by 64-bit
hashes.

Edge cases: null and empty texts hold the end alone; null ids and repeated rows
are scored row by row; with no training rows every word is unknown; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.textops import LOWER, MULT, byte_view, mix64, pack, slices, unpack, word_hashes, word_spans
from riskfeat.session import checkpoint

BLOCK_TOKENS = 1 << 21
STEP = 1 << 18  # tokens for which arcs are looked up at a time
BUCKET_KEYS = 1 << 21  # n-grams, before adding up, that a bucket takes on average
END = np.uint64(0x5EED0E0D)  # stands for the end of a text
START = np.uint64(0x5EED05AA)  # context of a text's first token
PRIORS = tuple(4.0**i for i in range(8))  # grid for k

_BLOCK = "uid array<long>, doc array<long>, held array<boolean>, n array<long>, context binary, words binary, seq binary"


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as byte planes of their differences."""
    d = np.diff(keys, prepend=np.uint64(0))
    return pack(d.view(np.uint8).reshape(-1, 8).T)


def _unpack_keys(b: bytes) -> np.ndarray:
    d = np.ascontiguousarray(unpack(b, "u1").reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(d, dtype=np.uint64)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to blocks of pieces: local word ids in order, and the words' hashes, frequent first."""
    ctx = TaskContext.get()
    uid = (ctx.partitionId() if ctx else 0) << 40
    pieces: list[tuple] = []  # uid, doc, held, context, tokens
    size = 0

    def block() -> pa.RecordBatch:
        n = [len(p[4]) for p in pieces]
        both = np.concatenate([*(p[4] for p in pieces), np.array([p[3] for p in pieces], np.uint64)])
        words, seq, count = np.unique(both, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        seq = rank[seq].astype("<u4")
        cols = ([p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces], n)
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array([c], pa.list_(k)) for c, k in zip(cols, kinds)),
                pa.array([seq[sum(n) :].tobytes()], pa.binary()),
                pa.array([words[order].tobytes()], pa.binary()),
                pa.array([pack(seq[: sum(n)].view(np.uint8).reshape(-1, 4).T)], pa.binary()),  # as byte planes
            ],
            ["uid", "doc", "held", "n", "context", "words", "seq"],
        )

    for b in slices(batches, "text"):
        data, offs = byte_view(b.column("text"))
        data = LOWER[data]
        row, start, end = word_spans(data, offs)
        h = word_hashes(data, start, end)
        stop = np.cumsum(np.bincount(row, minlength=b.num_rows) + 1)
        tokens = np.full(int(stop[-1]), END, np.uint64)
        tokens[np.delete(np.arange(len(tokens)), stop - 1)] = h
        for i, (doc, held, a, z) in enumerate(zip(b.column("doc").to_pylist(), b.column("held").to_pylist(), [0, *stop[:-1].tolist()], stop.tolist())):
            for at in range(a, z, BLOCK_TOKENS):
                pieces.append((uid + i, doc, held, START if at == a else tokens[at - 1], tokens[at : min(at + BLOCK_TOKENS, z)]))
                size += len(pieces[-1][4])
                if size >= BLOCK_TOKENS:
                    yield block()
                    pieces, size = [], 0
        uid += b.num_rows
    if pieces:
        yield block()


class _Block:
    """One block read back: tokens, contexts, and its distinct bigrams."""

    def __init__(self, r: dict) -> None:
        self.words = np.frombuffer(r["words"], np.uint64)
        self.seq = np.ascontiguousarray(unpack(r["seq"], "u1").reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
        self.n = np.array(r["n"], np.int64)
        self.first = np.cumsum(self.n) - self.n
        self.held = np.array(r["held"], bool)
        self.context = np.empty_like(self.seq)
        self.context[1:] = self.seq[:-1]
        self.context[self.first] = np.frombuffer(r["context"], "<u4")
        self.train = np.repeat(~self.held, self.n)
        pair, self.bigram = np.unique(self.context << 32 | self.seq, return_inverse=True)
        self.h, self.w = pair >> 32, pair & 0xFFFFFFFF
        self.keys = mix64(self.words[self.h] * MULT + self.words[self.w])


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the leading bits; rises with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pack_totals(n: np.ndarray) -> bytes:
    """Counts over the corpus, 64 bits each, as byte planes: the upper ones are zeros and cost nothing."""
    return pack(n.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def _unpack_totals(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpack(b, "u1").reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


_ASK = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _ask(buckets: int):
    """A block's distinct unigrams (kind 1) and bigrams (kind 2) with its training counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x = _Block(r)
                uni = np.bincount(x.seq[x.train], minlength=len(x.words))
                bi = np.bincount(x.bigram[x.train], minlength=len(x.keys))
                for kind, keys, counts in ((1, mix64(x.words), uni), (2, x.keys, bi)):
                    order = np.argsort(keys)
                    keys, counts = keys[order], counts[order].astype("<u4")
                    of = _bucket_of(keys, buckets)
                    edge = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                    rows = [
                        (kind, int(of[a]), r["block"], _pack_keys(keys[a:z]), pack(counts[a:z]))
                        for a, z in zip(edge.tolist(), np.r_[edge[1:], len(keys)].tolist())
                    ]
                    yield pa.RecordBatch.from_pylist([dict(zip(_ASK.names, y)) for y in rows], schema=_ASK)

    return run


_ANSWER = "kind int, bucket long, block long, counts binary, total long, kinds long"


def _add_up(t: pa.Table) -> pa.Table:
    """A bucket's totals, in the order each block asked; its sums on the first row."""
    keys = [_unpack_keys(k) for k in t.column("keys").to_pylist()]
    counts = [unpack(c, "<u4") for c in t.column("counts").to_pylist()]
    uniq, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(uniq)).astype(np.int64)
    stop = np.cumsum([len(k) for k in keys])
    out = [_pack_totals(total[at[z - len(k) : z]]) for k, z in zip(keys, stop)]
    zero = [0] * (len(keys) - 1)
    return pa.table({
        "kind": t.column("kind"), "bucket": t.column("bucket"), "block": t.column("block"), "counts": pa.array(out, pa.binary()),
        "total": pa.array([int(total.sum()), *zero], pa.int64()), "kinds": pa.array([int((total > 0).sum()), *zero], pa.int64()),
    })


_SCORED = "uid long, doc long, held boolean, n_tokens long, n_known long, base double, scores array<double>, loo array<double>"


def traverse(seq: list[int], starts: list[int], ends: list[int], contexts: list[int], arcs: dict[int, int], width: int, known: list[bool]) -> tuple[list[int], list[int]]:
    """Read each piece once, left to right, carrying the state.

    A state is the local id of the last word, or -1 for the root; ``arcs`` maps
    ``state * width + word`` to a bigram arc.  Returns per token the arc taken
    from its state (-1: none) and the state that its failure arc left (-1: no
    failure arc was taken).
    """
    took: list[int] = []
    failed: list[int] = []
    arc = arcs.get
    for a, z, state in zip(starts, ends, contexts):
        for w in seq[a:z]:
            if state < 0:
                took.append(-1)
                failed.append(-1)
            else:
                x = arc(state * width + w, -1)
                took.append(x)
                failed.append(state if x < 0 else -1)
            state = w if known[w] else -1
    return took, failed


def _walk(x: _Block, bi: np.ndarray, known: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's arcs and failures, STEP tokens at a time: only their arcs are in memory as a map."""
    width, listed = len(x.words), known.tolist()
    took, failed = np.empty(len(x.seq), np.int64), np.empty(len(x.seq), np.int64)
    for lo in range(0, len(x.seq), STEP):
        hi = min(lo + STEP, len(x.seq))
        own = np.unique(x.bigram[lo:hi])
        own = own[bi[own] > 0]
        arcs = dict(zip((x.h[own] * width + x.w[own]).tolist(), own.tolist()))
        inside = np.flatnonzero((x.first >= lo) & (x.first < hi))
        starts, states = x.first[inside].tolist(), entry[inside].tolist()
        if not starts or starts[0] > lo:  # a piece goes on
            starts.insert(0, lo)
            states.insert(0, int(x.seq[lo - 1]) if known[x.seq[lo - 1]] else -1)
        a, f = traverse(x.seq[lo:hi].tolist(), [s - lo for s in starts], [s - lo for s in [*starts[1:], hi]], states, arcs, width, listed)
        took[lo:hi], failed[lo:hi] = a, f
    return took, failed


def _score(n_train: int, n_kinds: int, n_texts: int):
    """Cogrouped (block, answers) to one row per piece, for every k of the grid."""
    denominator = n_train + 0.5 * (n_kinds + 1)
    # a token left out of the training counts
    less = max(n_train - 1, 0) + 0.5 * (n_kinds + 1)

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("uid", "doc", "held", "n_tokens", "n_known", "base", "scores", "loo")}
        for r in block.to_pylist():
            x = _Block(r)
            got = {}
            for kind, keys in ((1, mix64(x.words)), (2, x.keys)):
                rows = sorted((a["bucket"], a["counts"]) for a in answers.to_pylist() if a["kind"] == kind)
                got[kind] = np.empty(len(keys), np.int64)
                got[kind][np.argsort(keys)] = np.concatenate([_unpack_totals(c) for _, c in rows])
            uni, bi = got[1], got[2]
            of_state = np.where(x.words == START, n_texts, uni)  # how often a state is left
            seen = np.flatnonzero(bi > 0)
            known = uni > 0
            first = x.context[x.first]
            entry = np.where(known[first] | (x.words[first] == START), first, -1)
            took, failed = _walk(x, bi, known, entry)
            root = np.log10((uni + 0.5) / denominator)  # weights of the root's arcs
            on_root, on_arc, on_fail = root[x.seq], np.flatnonzero(took >= 0), np.flatnonzero(failed >= 0)
            arc, fail = took[on_arc], failed[on_fail]
            total = lambda v: np.add.reduceat(v, x.first)
            scores, loo = [], []
            c_hw, c_h, p_w = bi[seen], of_state[x.h[seen]], (uni[x.w[seen]] + 0.5) / denominator
            index = np.full(len(bi), -1)
            index[seen] = np.arange(len(seen))
            arc = index[arc]
            p_left = (np.maximum(uni[x.w[seen]] - 1, 0) + 0.5) / less
            train = x.train[on_arc]
            for k in PRIORS:
                token = on_root.copy()
                token[on_arc] = np.log10((c_hw + k * p_w) / (c_h + k))[arc]
                token[on_fail] += np.log10(k / (of_state[fail] + k))
                scores.append(total(token))
                left = np.log10((c_hw - 1 + k * p_left) / (np.maximum(c_h - 1, 0) + k))[arc]
                loo.append(float(left[train].sum()))
            n = len(x.n)
            out["uid"] += r["uid"]
            out["doc"] += r["doc"]
            out["held"] += r["held"]
            out["n_tokens"] += r["n"]
            out["n_known"] += total(known[x.seq].astype(np.int64)).tolist()
            out["base"] += total(on_root).tolist()
            out["scores"] += np.array(scores).T.tolist()
            out["loo"] += [loo] + [[0.0] * len(PRIORS)] * (n - 1)
        kinds = {"uid": pa.int64(), "doc": pa.int64(), "held": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.list_(pa.float64()))) for k, v in out.items()})

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score, prior)`` per row.

    The model is learned from the rows for which ``held_out`` does not hold.
    """
    d = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_col).cast("string").alias("text")
    )
    blocks = checkpoint(d.mapInArrow(_blocks, _BLOCK).withColumn("block", F.monotonically_increasing_id()))
    each = F.explode(F.arrays_zip("uid", "held", "n"))
    sums = blocks.select(each.alias("p")).agg(
        F.sum("p.n").alias("tokens"), F.count_distinct(F.when(~F.col("p.held"), F.col("p.uid"))).alias("texts")
    ).first()
    buckets = max(1, -(-2 * (sums.tokens or 0) // BUCKET_KEYS))
    asked = blocks.mapInArrow(_ask(buckets), "kind int, bucket long, block long, keys binary, counts binary")
    answers = checkpoint(asked.groupBy("kind", "bucket").applyInArrow(_add_up, _ANSWER))
    uni = answers.where("kind = 1").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("v")).first()
    scored = checkpoint(
        blocks.groupBy("block").cogroup(answers.select("block", "kind", "bucket", "counts").groupBy("block")).applyInArrow(_score(uni.n, uni.v, sums.texts or 0), _SCORED)
    )
    loo = scored.agg(*[F.sum(F.col("loo")[i]).alias(f"k{i}") for i in range(len(PRIORS))]).first()
    best = max(range(len(PRIORS)), key=lambda i: (loo[i] or 0.0, i))
    return scored.groupBy("uid").agg(
        F.first("doc").alias(id_col), F.first("held").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.lit(int(uni.n)).cast("long").alias("train_tokens"), F.sum("base").alias("base_score"), F.sum(F.col("scores")[best]).alias("score"),
        F.lit(PRIORS[best]).alias("prior"),
    ).drop("uid")
