"""Document quality from a linear-chain conditional random field over lines (operator 2).

Every line with a word is a position of a chain with two labels, bad and good.
Its features come from the line and from its two neighbours; a learned
transition matrix ties neighbouring labels.  Forward-backward gives each line's
probability of being good, and the mean of these, weighted by the lines'
lengths in words, is the document's score.

Training takes all lines of a bounded sample of documents (``TRAIN_DOCS`` a class),
the labelled ones with the smallest hash of their id; each line bears its
document's label and the classes are weighted back to their shares among all
labelled rows.  Up to ``DRIVER_LINES`` lines are fitted on the driver; of more, each
round sums the gradients of whole chains in Spark tasks, and only these sums
reach the driver.  Scoring is one Arrow pass over whole texts.

Defined results: null and empty texts, and texts without a word, score the
share of good documents among the labelled ones (0.5 without labels); rows are
scored one by one, so repeated rows and null ids are no special case; without
both classes among the labels every text scores that share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import checkpointed, map_arrow, unused, without
from .quality_rules import _DIGIT, _LETTER, _STOP, _SYMBOL, _UPPER
from .textbytes import blocks, hashes, lines, words

TRAIN_DOCS = 1000
DRIVER_LINES = 1 << 17  # more lines are fitted in Spark tasks
SEGMENT = 64  # lines of a chain that are stepped through; longer chains are joined from such segments
OWN = 14  # features of a line by itself
WIDE = 3 * OWN + 2  # with both neighbours', and whether there are any


def line_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, words, row) of each line with a word, in order."""
    ws, we, _ = words(data, at)
    ls, le, row = lines(data, at)
    first, last = np.searchsorted(ws, ls, "left"), np.searchsorted(ws, le, "left")
    has = last > first
    ls, le, row, first, last = ls[has], le[has], row[has], first[has], last[has]
    n = (last - first).astype(float)
    x = np.zeros((ls.size, OWN), np.float32)
    if not ls.size:
        return x, n, row
    h = hashes(data, ws, we)
    ends = data[we - 1]

    def within(flags: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[hi] - total[lo]).astype(float)

    letters = np.maximum(within(_LETTER[data], ls, le), 1)
    line_of = np.repeat(np.arange(ls.size), last - first)
    order = np.lexsort((h, line_of))
    new = np.ones(h.size, bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][new], minlength=ls.size)
    stutter = np.zeros(h.size, bool)
    stutter[1:] = (h[1:] == h[:-1]) & (line_of[1:] == line_of[:-1])
    upper = within(_UPPER[data], ls, le) / letters
    symbols = within(_SYMBOL[data], ls, le) / n
    odd = within(_SYMBOL[ends] | (ends == 0x21), first, last) / n
    length = within(_LETTER[data] | _DIGIT[data], ls, le) / n
    lh = hashes(data, ls, le)
    order = np.lexsort((np.arange(lh.size), lh, row))
    seen = np.zeros(lh.size, bool)
    seen[order[1:]] = (lh[order][1:] == lh[order][:-1]) & (row[order][1:] == row[order][:-1])
    x[:, 0] = 1
    x[:, 1] = np.minimum(np.log1p(n), 8) / 4
    x[:, 2] = upper
    x[:, 3] = upper > 0.3
    x[:, 4] = np.minimum(symbols, 2)
    x[:, 5] = symbols > 0.1
    x[:, 6] = odd
    x[:, 7] = within(_DIGIT[data], ls, le) / np.maximum(n * length, 1)
    x[:, 8] = np.minimum(length, 20) / 10
    x[:, 9] = within(stutter, first, last) / n
    x[:, 10] = distinct / n
    x[:, 11] = (distinct / n < 0.5) & (n >= 8)
    x[:, 12] = _STOP[data[le - 1]]
    x[:, 13] = seen
    return x, n, row


def with_neighbours(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Features of a line, the one before and the one after it in the same document."""
    out = np.zeros((len(x), WIDE), np.float32)
    out[:, :OWN] = x
    if len(x) > 1:
        same = row[1:] == row[:-1]
        out[1:, OWN:2 * OWN][same] = x[:-1][same]
        out[:-1, 2 * OWN:3 * OWN][same] = x[1:][same]
        out[1:, -2] = same
        out[:-1, -1] = same
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices of logs, each up to a factor."""
    c = np.logaddexp(a[:, :, :1] + b[:, :1, :], a[:, :, 1:] + b[:, 1:, :])
    return c - c.max((1, 2), keepdims=True)


def _running(matrix: np.ndarray, place: np.ndarray, back: bool = False) -> np.ndarray:
    """Product of each matrix with all before it in its chain, by doubling; ``place``: how many these are.

    ``back``: the arrays run from the chains' ends, so the factors change sides.
    """
    out, d = matrix, 1
    while d <= place.max(initial=0):
        at = np.flatnonzero(place >= d)
        more = out.copy()
        more[at] = _times(out[at], out[at - d]) if back else _times(out[at - d], out[at])
        out, d = more, 2 * d
    return out


def marginals(score: np.ndarray, move: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once.

    ``score``: (lines, 2) log potentials; ``move``: (2, 2) of transitions;
    chain i has lines first[i] to first[i] + size[i], and is not empty.  Returns each
    line's label probabilities, and the expected transition counts of each chain.
    """
    parts = -(-size // SEGMENT)  # segments of each chain, in order
    chain = np.repeat(np.arange(size.size), parts)
    place = np.arange(chain.size) - np.repeat(np.cumsum(parts) - parts, parts)
    start = first[chain] + place * SEGMENT
    length = np.minimum(size[chain] - place * SEGMENT, SEGMENT)
    order = np.argsort(-length, kind="stable")
    longest = int(length.max(initial=0))
    alive = [order[:int(np.searchsorted(-length[order], -t, "left"))] for t in range(longest)]  # segments longer than t
    come, leave = np.zeros((chain.size, 2)), np.zeros((chain.size, 2))  # log sums before and after each segment
    if (several := parts[chain] > 1).any():
        # each segment's matrix from the label before it to its last one
        whole = np.zeros((chain.size, 2, 2))
        for t in range(longest):
            on = alive[t][several[alive[t]]]
            into = score[start[on] + t][:, None, :]
            if t:
                before = whole[on]
                into = into + np.logaddexp(before[:, :, :1] + move[0], before[:, :, 1:] + move[1])
            else:
                into = into + np.where((place[on] > 0)[:, None, None], move, 0.0)
            whole[on] = into - into.max((1, 2), keepdims=True)
        on = np.flatnonzero(several)
        ahead = _running(whole[on], place[on])[:, 0]
        later = np.flatnonzero(place[on] > 0)
        come[on[later]] = ahead[later - 1]
        behind = _running(whole[on][::-1], (parts[chain] - 1 - place)[on][::-1], back=True)[::-1]
        leave[on[later - 1]] = np.logaddexp(behind[later][:, :, 0], behind[later][:, :, 1])
    alpha, beta = np.empty_like(score), np.empty_like(score)
    for t, on in enumerate(alive):
        at = start[on] + t
        before = alpha[at - 1] if t else come[on]
        into = np.logaddexp(before[:, :1] + move[0], before[:, 1:] + move[1])
        if not t:
            into[place[on] == 0] = 0
        alpha[at] = into + score[at]
        alpha[at] -= alpha[at].max(1, keepdims=True)  # keeps sums small; marginals are normalised below
    beta[start + length - 1] = leave
    for t in range(longest - 2, -1, -1):
        at = start[alive[t + 1]] + t
        on = beta[at + 1] + score[at + 1]
        b = np.logaddexp(move[:, 0] + on[:, :1], move[:, 1] + on[:, 1:])
        beta[at] = b - b.max(1, keepdims=True)
    g = alpha + beta
    p = np.exp(g - np.logaddexp(g[:, :1], g[:, 1:]))
    owner = np.repeat(np.arange(size.size), size)
    at = np.arange(owner.size) - np.repeat(np.cumsum(size) - size, size)
    at, owner = (np.repeat(first, size) + at)[at > 0], owner[at > 0]  # lines after another one
    e = alpha[at - 1][:, :, None] + move + (beta[at] + score[at])[:, None, :]
    e = np.exp(e - e.max((1, 2), keepdims=True))
    e /= e.sum((1, 2), keepdims=True)
    moves = np.stack([np.bincount(owner, e[:, i, j], size.size) for i in (0, 1) for j in (0, 1)], 1)
    return p, moves.reshape(-1, 2, 2)


class Crf:
    """Weights of the good label's features against the bad one's, transitions, and the share of good documents."""

    def __init__(self, weights: np.ndarray, move: np.ndarray, good: float):
        self.weights, self.move, self.good = weights, move, good

    def score(self, column: pa.Array) -> np.ndarray:
        """Length-weighted mean probability of the good label, for each text."""
        out = np.full(len(column), self.good)
        if self.weights is None:
            return out
        for lo, hi, data, at in blocks(column):
            x, n, row = line_features(data, at)
            if not len(x):
                continue
            p = self.lines(x, row)
            total = np.bincount(row, n, hi - lo)
            good = np.bincount(row, n * p, hi - lo)
            some = total > 0
            out[lo:hi][some] = np.clip(good[some] / total[some], 0, 1)
        return out

    def lines(self, x: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Probability of the good label of each line."""
        z = with_neighbours(x, row) @ self.weights
        score = np.stack([np.zeros_like(z), z], 1).astype(float)
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        return marginals(score, self.move, first, np.diff(np.r_[first, row.size]))[0][:, 1]


def gradient(params: np.ndarray, x: np.ndarray, size: np.ndarray, labels: np.ndarray, by_class: np.ndarray) -> np.ndarray:
    """Of the conditional log-likelihood, summed over whole chains; ``x``: their lines with neighbours.

    ``by_class``: weight of a chain of each label; each line or transition has its chain's over the chain's size.
    """
    move = params[WIDE:].reshape(2, 2)
    z = x @ params[:WIDE].astype(np.float32)
    p, moves = marginals(np.stack([np.zeros_like(z), z], 1).astype(float), move, np.cumsum(size) - size, size)
    own = by_class[labels] / size
    seen = np.zeros((size.size, 2, 2))
    seen[np.arange(size.size), labels, labels] = size - 1
    miss = np.repeat(own, size) * (np.repeat(labels, size) - p[:, 1])
    return np.r_[x.T @ miss, ((seen - moves) * own[:, None, None]).sum(0).ravel()]


def ascend(slope: Callable[[np.ndarray], np.ndarray], share: float, rounds: int = 150, ridge: float = 1e-3) -> Crf:
    """Fit by Adam; ``slope``: the gradient at given parameters."""
    params = np.zeros(WIDE + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        grad = slope(params) - ridge * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        params = params + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Crf(params[:WIDE].astype(np.float32), params[WIDE:].reshape(2, 2), share)


def wide_chains(features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(features with neighbours, size) of chains of line features."""
    size = np.array([len(x) for x in features])
    return with_neighbours(np.concatenate(features), np.repeat(np.arange(size.size), size)), size


def train(chains: list[tuple[int, np.ndarray]], share: float, rounds: int = 150, ridge: float = 1e-3) -> Crf:
    """Fit on (label, line features) chains by Adam on the conditional log-likelihood.

    ``share``: of good documents among all labelled ones.  Chains are weighted
    so that the two classes have these shares; each chain counts the same.
    """
    labels = np.array([y for y, _ in chains])
    if not len(chains) or labels.min() == labels.max():
        return Crf(None, None, share)
    x, size = wide_chains([x for _, x in chains])
    by_class = np.array([1 - share, share]) / np.bincount(labels)
    return ascend(lambda params: gradient(params, x, size, labels, by_class), share, rounds, ridge)


def train_in_tasks(chains: DataFrame, by_class: np.ndarray, share: float) -> Crf:
    """Fit on (label, features) rows, each round in one pass of Spark tasks; a row for each task reaches the driver."""

    def slope(params: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(params)
            for batch in batches:
                labels, features = batch.column(0).to_numpy(), [_features(f.as_buffer()) for f in batch.column(1)]
                edge = np.cumsum([0, *map(len, features)])
                lo = 0
                while lo < len(features):  # so many chains at a time, or one
                    hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + DRIVER_LINES, "right")) - 1)
                    total += gradient(params, *wide_chains(features[lo:hi]), labels[lo:hi], by_class)
                    lo = hi
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["grad"])

        return np.sum([r["grad"] for r in chains.mapInArrow(run, "grad array<double>").collect()], axis=0)

    return ascend(slope, share)


def _features(raw) -> np.ndarray:
    return np.frombuffer(raw, np.float32).reshape(-1, OWN)


def training_chains(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                    text: str = "text", per_class: int = TRAIN_DOCS) -> DataFrame:
    """(label, features): features of all lines of the sampled documents; ``labels`` are those that may be learned from."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("__id IS NOT NULL AND label IN (0, 1)").dropDuplicates()
    sample = None
    for c in (0, 1):
        part = known.where(F.col("label") == c).orderBy(F.xxhash64("__id"), "__id").limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    both = docs.select(F.col(id_col).alias("__id"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(sample), "__id")  # 2 * per_class rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in blocks(batch.column(0)):
                x, _, row = line_features(data, at)
                edge = np.searchsorted(row, np.arange(len(at)))
                out = [x[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), pa.array(out, pa.binary())],
                                                 ["label", "features"])

    return both.select("text", "label").mapInArrow(run, T.StructType(
        [T.StructField("label", T.IntegerType()), T.StructField("features", T.BinaryType())]))


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
           text: str = "text", per_class: int = TRAIN_DOCS, driver_lines: int = DRIVER_LINES) -> Crf:
    """Learn from ``labels`` rows found in ``docs``; at most ``driver_lines`` lines reach the driver, more stay in tasks."""
    got = checkpointed(training_chains(docs, labels, id_col, label_col, text, per_class).where("length(features) > 0"))
    n, good = labels.where(F.col(label_col).isin(0, 1)).agg(F.count("*"), F.sum(F.col(label_col))).first()
    share = float(good) / n if n else 0.5
    found = {r["label"]: r for r in got.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.length("features").cast("long")).alias("bytes")).collect()}
    n_lines = sum(r["bytes"] for r in found.values()) // (4 * OWN)
    if n_lines > driver_lines and len(found) == 2:
        by_class = np.array([(1 - share) / found[0]["n"], share / found[1]["n"]])
        return train_in_tasks(checkpointed(got.repartition(-(-n_lines // driver_lines))), by_class, share)
    if len(found) < 2:
        return Crf(None, None, share)
    chains = [(r["label"], _features(r["features"])) for r in got.collect()]
    chains.sort(key=lambda c: (c[0], c[1].tobytes()))  # the same model whatever the order of arrival
    return train(chains, share)


def with_score(docs: DataFrame, model: Crf, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (all, if None) of every document and its ``score``."""
    fields = without(docs.select(*(docs.columns if carry is None else carry)).schema, ["score"])
    names = [f.name for f in fields]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:len(names)], pa.array(model.score(batch.column(batch.num_columns - 1)))], [*names, "score"])

    given = docs.select(*names, F.col(text).cast("string").alias(unused(docs, "text_of_row")))
    return map_arrow(given, one, T.StructType([*fields, T.StructField("score", T.DoubleType())]))


def keep(docs: DataFrame, model: Crf, least: float, text: str = "text") -> DataFrame:
    """The documents that score ``least`` or more, with their own columns."""
    names = docs.columns

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = model.score(batch.column(batch.num_columns - 1)) >= least
        return pa.RecordBatch.from_arrays(batch.columns[:len(names)], names).filter(pa.array(good))

    return map_arrow(docs.select("*", F.col(text).cast("string").alias(unused(docs, "text_of_row"))), one, docs.schema)
