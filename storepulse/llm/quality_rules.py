"""Quality rules by weak supervision (operator 4).

Each rule looks at a few counts of a text and votes good, bad or abstains.
The rules' accuracies are not set by hand: expectation-maximisation over the
votes of all documents estimates them, together with the share of good
documents, under the model that a document's true class draws each rule's
vote independently.  A document's posterior probability of being good then
replaces "every rule must pass".

Work over the data: one Arrow pass counts each vote pattern (at most
3 ** rules of them, whatever the input's size), EM runs on these weighted
patterns, and a second Arrow pass scores every document from its own pattern.
No text is shuffled.  Counts of patterns are sums, so a hot source or a group
of copies is pre-aggregated like anything else.

Defined results: null text counts as empty (no words: ``base_failed``); rows
are judged one by one, so repeated rows, null ids and ties get the same answer
each; an empty table gives an empty result; a column of the input that has the
name of an output column is replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import map_arrow, unused, without
from .textbytes import SPACE, blocks, hashes, lines, mixed, per_row, summed, words

WINDOW = 8  # words of a window whose repetition counts
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True

#: Rules as (name, count, count it is a share of, good below, bad above); between the two they abstain.
SHARE_RULES = (
    ("repeats", "n_repeat_words", "n_words", 0.05, 0.3),
    ("symbols", "n_symbols", "n_words", 0.02, 0.1),
    ("odd_endings", "n_odd", "n_words", 0.02, 0.1),
    ("capitals", "n_upper", "n_letters", 0.1, 0.3),
    ("copied_lines", "n_dup_lines", "n_lines", 0.05, 0.3),
    ("stutter", "n_stutter", "n_words", 0.02, 0.1),
    ("digits", "n_digits", "word_chars", 0.05, 0.15),
)
OTHER_RULES = ("line_ends", "variety", "word_length")
RULES = (*(r[0] for r in SHARE_RULES), *OTHER_RULES)

BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE_COUNTS, "n_lines", "n_upper", "n_letters", "n_digits", "n_distinct", "n_ended", "n_odd", "n_stutter")


def _repeated(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Words in windows of WINDOW words that a row has twice or more."""
    m = h.size - WINDOW + 1
    if m <= 0:
        return np.zeros(n, np.int64)
    with np.errstate(over="ignore"):
        w = mixed(row[:m].astype(np.uint64) + np.uint64(1))
        for k in range(WINDOW):
            w = (w ^ h[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
            w ^= w >> np.uint64(29)
    whole = np.flatnonzero(row[:m] == row[WINDOW - 1:])
    order = np.argsort(w[whole])
    v = w[whole][order]
    same = v[1:] == v[:-1]
    twice = np.zeros(v.size, bool)
    twice[1:] |= same
    twice[:-1] |= same
    step = np.zeros(h.size + 1, np.int64)
    at = whole[order[twice]]
    step[at] += 1
    np.add.at(step, at + WINDOW, -1)
    return per_row(row[np.cumsum(step[:-1]) > 0], n)


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """Every count of COUNTS for each text of an Arrow column, as int64."""
    out = {k: np.zeros(len(column), np.int64) for k in COUNTS}
    for lo, hi, data, at in blocks(column):
        n = hi - lo
        start, end, row = words(data, at)
        h = hashes(data, start, end)
        put = lambda name, v: out[name].__setitem__(slice(lo, hi), v)
        put("n_words", per_row(row, n))
        put("word_chars", summed(~SPACE[data] & ((data & 0xC0) != 0x80), at))
        put("n_symbols", summed(_SYMBOL[data], at))
        put("n_upper", summed(_UPPER[data], at))
        put("n_letters", summed(_LETTER[data] & ((data & 0xC0) != 0x80), at))
        put("n_digits", summed(_DIGIT[data], at))
        put("n_repeat_words", _repeated(h, row, n))
        put("n_stutter", per_row(row[1:][(h[1:] == h[:-1]) & (row[1:] == row[:-1])], n))
        order = np.lexsort((h, row))
        hr, rr = h[order], row[order]
        new = np.ones(hr.size, bool)
        new[1:] = (hr[1:] != hr[:-1]) | (rr[1:] != rr[:-1])
        put("n_distinct", per_row(rr[new], n))
        if start.size:
            body = data[end - 1]
            put("n_odd", per_row(row[_SYMBOL[body] | (body == 0x21)], n))
        ls, le, lrow = lines(data, at)
        if start.size:
            worded = np.searchsorted(start, le, "left") > np.searchsorted(start, ls, "left")
            ls, le, lrow = ls[worded], le[worded], lrow[worded]
            put("n_lines", per_row(lrow, n))
            put("n_ended", per_row(lrow[_STOP[data[le - 1]]], n))
            lh = hashes(data, ls, le)
            order = np.lexsort((lh, lrow))
            lh, lr = lh[order], lrow[order]
            put("n_dup_lines", per_row(lr[1:][(lh[1:] == lh[:-1]) & (lr[1:] == lr[:-1])], n))
    return out


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """Votes of all rules, (documents, rules): 1 good, -1 bad, 0 abstains.

    Texts without a word get no vote at all.
    """
    out = np.zeros((len(c["n_words"]), len(RULES)), np.int8)

    def vote(name: str, good: np.ndarray, bad: np.ndarray) -> None:
        out[:, RULES.index(name)] = good.astype(np.int8) - (bad & ~good).astype(np.int8)

    def share(a: str, b: str) -> np.ndarray:
        return c[a] / np.maximum(c[b], 1)

    for name, part, whole, low, high in SHARE_RULES:
        x = share(part, whole)
        vote(name, x < low, x > high)
    ended, variety, length = share("n_ended", "n_lines"), share("n_distinct", "n_words"), share("word_chars", "n_words")
    vote("line_ends", ended > 0.9, ended < 0.5)
    vote("variety", variety > 0.6, variety < 0.3)
    vote("word_length", (length >= 3.5) & (length <= 6.5), (length < 3) | (length > 8))
    out[c["n_words"] == 0] = 0
    return out


def pattern_code(v: np.ndarray) -> np.ndarray:
    return ((v.astype(np.int64) + 1) * 3 ** np.arange(len(RULES))).sum(1)


def pattern_votes(code: np.ndarray) -> np.ndarray:
    return (code[:, None] // 3 ** np.arange(len(RULES)) % 3 - 1).astype(np.int8)


def pattern_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, n): how many documents voted each way, over all documents."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        code, n = np.unique(pattern_code(votes(counts(batch.column(0)))), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], ["pattern", "n"])

    part = map_arrow(docs.select(F.col(text).cast("string").alias("text")), one,
                     T.StructType([T.StructField("pattern", T.LongType()), T.StructField("n", T.LongType())]))
    return part.groupBy("pattern").agg(F.sum("n").alias("n"))


class LabelModel:
    """Share of good documents, and each rule's chances of its three votes by true class.

    ``chance[c, r, v + 1]``: of vote v of rule r in class c (0 bad, 1 good).
    """

    def __init__(self, good: float, chance: np.ndarray):
        self.good, self.chance = good, chance

    @staticmethod
    def start() -> LabelModel:
        """Rules are better than chance, and most documents are good: this names the classes."""
        chance = np.empty((2, len(RULES), 3))
        chance[0] = 0.35, 0.25, 0.4
        chance[1] = 0.05, 0.25, 0.7
        return LabelModel(0.8, chance)

    def log_odds(self, v: np.ndarray) -> np.ndarray:
        each = np.log(self.chance[1]) - np.log(self.chance[0])
        out = np.full(len(v), np.log(self.good) - np.log1p(-self.good))
        for r in range(len(RULES)):
            out += each[r][v[:, r].astype(np.int64) + 1]
        return out

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of being good by row of votes; without any vote the share of good documents."""
        p = 1 / (1 + np.exp(-np.clip(self.log_odds(v), -700, 700)))
        p[~v.any(1)] = self.good
        return p


def fit(patterns: list[tuple[int, int]], rounds: int = 100, prior: float = 1.0) -> LabelModel:
    """EM on weighted vote patterns; ``prior`` is a pseudo-count of each vote, so no chance is 0."""
    model = LabelModel.start()
    if not patterns:
        return model
    code, n = (np.array(x) for x in zip(*sorted(patterns)))
    v = pattern_votes(code)
    n = n.astype(float)
    for _ in range(rounds):
        p = model.posterior(v)
        chance = np.empty_like(model.chance)
        for c, w in enumerate((n * (1 - p), n * p)):
            for x in (-1, 0, 1):
                chance[c, :, x + 1] = w @ (v == x) + prior
        chance /= chance.sum(2, keepdims=True)
        good = (n @ p + 4) / (n.sum() + 5)
        done = abs(good - model.good) < 1e-9 and np.abs(chance - model.chance).max() < 1e-9
        model = LabelModel(good, chance)
        if done:
            break
    return model


def fit_on(docs: DataFrame, text: str = "text") -> LabelModel:
    """The label model of all documents; at most 3 ** rules counts reach the driver."""
    return fit([(r["pattern"], r["n"]) for r in pattern_counts(docs, text).collect()])


OUT = T.StructType([
    *(T.StructField(k, T.LongType()) for k in BASE_COUNTS),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("p_good", T.DoubleType()),
    T.StructField("kept", T.BooleanType()),
])


def judge(docs: DataFrame, model: LabelModel, text: str = "text", least: float = 0.5,
          carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (all, if None) of every document with its counts, posterior and verdict.

    ``kept``: not ``base_failed``, and a posterior of ``least`` or more.
    """
    columns = docs.columns if carry is None else carry
    fields = without(docs.select(*columns).schema, OUT.names)
    names = [f.name for f in fields]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = counts(batch.column(batch.num_columns - 1))
        p, failed = model.posterior(votes(c)), base_failed(c)
        made = [*(pa.array(c[k]) for k in BASE_COUNTS), pa.array(failed), pa.array(p), pa.array(~failed & (p >= least))]
        return pa.RecordBatch.from_arrays([*batch.columns[:len(names)], *made], [*names, *OUT.names])

    given = docs.select(*names, F.col(text).cast("string").alias(unused(docs, "text_of_row")))
    return map_arrow(given, one, T.StructType([*fields, *OUT.fields]))


def keep(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that the rules keep, with their own columns; one more pass over the texts, no shuffle."""
    model = fit_on(docs, text)
    names = docs.columns

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = counts(batch.column(batch.num_columns - 1))
        kept = ~base_failed(c) & (model.posterior(votes(c)) >= least)
        rows = pa.RecordBatch.from_arrays(batch.columns[:len(names)], names)
        return rows.filter(pa.array(kept))

    return map_arrow(docs.select("*", F.col(text).cast("string").alias(unused(docs, "text_of_row"))), one, docs.schema)
