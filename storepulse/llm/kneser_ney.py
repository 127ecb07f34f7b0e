"""Interpolated modified Kneser-Ney n-gram model, counted in Spark (operator 3).

Tokens are words as 64-bit hashes, then one end of the text; before a text's
first token stand as many starts as a context is long.  ``train`` takes the
order (2 by default, any from 2 on).

Counting: tasks turn blocks of texts into different words, and then into
different n-grams of the highest order, with their counts, and send them as
packed arrays to the bucket of their context.  A bucket's task merges what it
gets, writes sorted hash arrays (``.npy``) into a folder that all workers share,
and sends each n-gram's ending to the next lower order, where it counts once
for each different word before it (an ending that begins with a start has no
different ones and keeps its count).  Words and n-grams are pre-aggregated
before every shuffle, so a frequent one is one entry for each block.  Contexts
all of whose words are frequent enough to fill an eighth of a bucket are spread
over all buckets by the next word; their sums are added in Spark.
The number of buckets follows the number of tokens, so a bucket's size does not.

Scoring: workers memory-map the arrays and look up each block's different
n-grams at once by binary search, from the lowest order to the highest:

    p(w | h) = max(c(h w) - D(c(h w)), 0) / c(h) + g(h) * p(w | h without its first word)
    p(w) = max(n(. w) - D'(n(. w)), 0) / n(. .) + g * 1 / (V + 1)

with the three discounts of each level taken from its counts of counts, and
1 / (V + 1) for every word not seen.

Memory-mapping needs a folder that is mounted on all workers: the shared
checkpoint folder has to be a ``file:`` path (a network file system); other
schemes raise an error.  Files are written under a name of their own and then
renamed, so a task that runs twice leaves one whole file.

Defined results: null text is empty (one token, its end); repeated rows each
count and get the same score; with no training text every token is unknown
(V = 0, p = 1), N is 0 and base_score uses (0.5 / 0.5); an empty table to score
gives an empty result; columns of the input named like an output are replaced.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import map_arrow, shared_folder, unused, without
from .textbytes import LOWER, blocks, hashes, mixed, words

END = np.uint64(0x0E4D)
START = np.uint64(0x57A7)
FLUSH = 3_000_000  # tokens gathered before they are merged and sent
BUCKET = 2_000_000  # tokens a bucket is made for
ORDER = 2
_K = np.uint64(0x9E3779B97F4A7C15)

BLOB = "bucket long, a binary, n binary, b binary, c binary"
STATS = ("total", "one", "two", "more")  # of a context: its counts in all, and its different n-grams by count


def tokens(data: np.ndarray, at: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(hash, hashes 1, 2, .. order - 1 tokens before, row) of every token of a block of texts, ends included."""
    data = LOWER[data]
    start, end, row = words(data, at)
    n = len(at) - 1
    size = np.bincount(row, minlength=n) + 1
    last = np.cumsum(size) - 1
    h = np.full(int(size.sum()), END)
    inside = np.ones(h.size, bool)
    inside[last] = False
    h[inside] = hashes(data, start, end)
    before, now = [], h
    for _ in range(order - 1):
        shifted = np.empty_like(h)
        shifted[1:] = now[:-1]
        shifted[last - size + 1] = START
        before.append(shifted)
        now = shifted
    return h, before, np.repeat(np.arange(n), size)


def gram_key(context: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mixed(context * _K + h)


def context_key(before: list[np.ndarray]) -> np.ndarray:
    """One hash of the tokens before, nearest first; a single one stands for itself."""
    key = before[0]
    for x in before[1:]:
        key = mixed(key * _K + x)
    return key


def bucket_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(h.size, np.int64)


def tally(keys: tuple[np.ndarray, ...], counts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Different rows of ``keys`` in order, then their summed counts."""
    if len(keys) == 1 and counts is None:
        return np.unique(keys[0], return_counts=True)
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    new = np.zeros(order.size, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    if counts is None:
        n = np.diff(np.r_[first, order.size])
    else:
        n = np.add.reduceat(counts[order], first) if first.size else counts[:0]
    return (*(k[first] for k in keys), n.astype(np.int64))


def _blobs(bucket: np.ndarray, a: list[np.ndarray], b: np.ndarray | None, c: np.ndarray) -> pa.RecordBatch:
    """Entries, sorted by bucket (and all of a, where b is given), as one row a bucket."""
    edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if bucket.size else bucket
    rows: list[list] = [[], [], [], [], []]
    for lo, hi in zip(edge, np.r_[edge[1:], bucket.size]):
        counts = _narrow(c[lo:hi]).tobytes()
        x = [k[lo:hi] for k in a]
        if b is None:
            row = (x[0].tobytes(), None, None, counts)
        else:
            new = np.zeros(hi - lo, bool)
            new[0] = True
            for k in x:
                new[1:] |= k[1:] != k[:-1]
            first = np.flatnonzero(new)
            row = (np.stack([k[first] for k in x], 1).tobytes(), np.diff(np.r_[first, hi - lo]).astype("<u4").tobytes(),
                   b[lo:hi].tobytes(), counts)
        for column, value in zip(rows, (int(bucket[lo]), *row)):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), *(pa.array(r, pa.binary()) for r in rows[1:])],
                                      ["bucket", "a", "n", "b", "c"])


def _gathered(docs: DataFrame, text: str, order: int, send: Callable[..., pa.RecordBatch]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, _, data, at in blocks(batch.column(0)):
                h, before, _ = tokens(data, at, order)
                held.append((h, *before))
                n += h.size
                if n >= FLUSH:
                    yield send(*(np.concatenate(x) for x in zip(*held)))
                    held, n = [], 0
        if n:
            yield send(*(np.concatenate(x) for x in zip(*held)))

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, BLOB)


def _joined(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _counts(rows: pa.Table, of: str) -> np.ndarray:
    """Counts of the 8-byte entries in ``of``; each row has them in 4 or in 8 bytes."""
    parts = [np.frombuffer(c, "<u8" if len(c) == len(x) else "<u4").astype(np.int64)
             for x, c in zip(rows[of].to_pylist(), rows["c"].to_pylist())]
    return np.concatenate(parts)


def _save(folder: str, name: str, x: np.ndarray) -> None:
    """Write one array whole, whichever attempt comes last."""
    own = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    with open(own, "wb") as f:
        np.save(f, x)
    os.replace(own, os.path.join(folder, f"{name}.npy"))


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype("<u4") if not x.size or x.max() < 2 ** 32 else x.astype("<u8")


def _load(folder: str, name: str) -> np.ndarray:
    return np.load(os.path.join(folder, f"{name}.npy"), mmap_mode="r")


def _of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, 5), minlength=6)[1:5].tolist()


def discounts(of: list[int]) -> np.ndarray:
    """Of counts 1, 2 and 3 or more, from the numbers of counts 1 to 4; entry 0 is 0."""
    n1, n2, n3, n4 = (float(x) for x in of)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))])


class Model:
    """Sizes, discounts and the folder of the arrays; small enough for every task's closure."""

    def __init__(self, folder: str, order: int, word_bits: int, bits: int, hot: np.ndarray, n: int, v: int, pairs: int,
                 low: list[int], low_sums: list[int], high: dict[int, list[int]]):
        self.folder, self.order, self.word_bits, self.bits, self.hot = folder, order, word_bits, bits, hot
        self.n, self.v, self.pairs = n, v, pairs
        self.low, self.high = discounts(low), {k: discounts(x) for k, x in high.items()}
        self.rest = float(self.low[1:] @ np.array(low_sums)) / pairs if pairs else 1.0

    def _find(self, kind: str, bits: int, bucket: np.ndarray, keys: np.ndarray, fields: tuple[str, ...]) -> list[np.ndarray]:
        """Values of sorted (bucket, key); 0 where there is none."""
        out = [np.zeros(keys.size, np.int64) for _ in fields]
        edge = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        for b in np.flatnonzero(edge[1:] > edge[:-1]):
            lo, hi = edge[b], edge[b + 1]
            if not os.path.exists(os.path.join(self.folder, f"{kind}-{b}-key.npy")):
                continue
            have = _load(self.folder, f"{kind}-{b}-key")
            if not have.size:
                continue
            at = np.minimum(np.searchsorted(have, keys[lo:hi]), have.size - 1)
            known = np.flatnonzero(have[at] == keys[lo:hi])
            for x, f in zip(out, fields):
                x[lo + known] = _load(self.folder, f"{kind}-{b}-{f}")[at[known]]
        return out

    def words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, contexts seen with) of sorted different words."""
        return tuple(self._find("word", self.word_bits, bucket_of(h, self.word_bits), h, ("count", "contexts")))

    def log10(self, h: np.ndarray, before: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, count in training) of each token."""
        word, at = np.unique(h, return_inverse=True)
        count, contexts = self.words(word)
        if not self.n:
            return np.zeros(h.size), count[at]
        low = np.maximum(contexts - self.low[np.minimum(contexts, 3)], 0) / max(self.pairs, 1) + self.rest / (self.v + 1)
        p = low[at]
        for k in range(2, self.order + 1):
            p = self._level(k, h, before[:k - 1], p)
        return np.log10(p), count[at]

    def _level(self, k: int, h: np.ndarray, before: list[np.ndarray], lower: np.ndarray) -> np.ndarray:
        """Probability of each token by n-grams of order ``k``, from that by the order below."""
        context, spread = context_key(before), all_hot(before, self.hot)
        # different n-grams, sorted by bucket and key
        bucket, key = gram_bucket(context, h, spread, self.bits), gram_key(context, h)
        order = np.lexsort((key, bucket))
        new = np.r_[True, key[order][1:] != key[order][:-1]] if order.size else np.zeros(0, bool)
        first = order[new]
        (c,) = self._find(f"gram{k}", self.bits, bucket[first], key[first], ("count",))
        gram = np.empty(h.size, np.int64)
        gram[order] = np.cumsum(new) - 1
        # different contexts, whole ones and spread ones
        context, one_of, of = np.unique(context, return_index=True, return_inverse=True)
        stats = np.zeros((4, context.size), np.int64)
        for kind, some in (("context", ~spread[one_of]), ("spread", spread[one_of])):
            x = context[some]
            stats[:, some] = self._find(f"{kind}{k}", self.bits, bucket_of(x, self.bits), x, STATS)
        total, (d1, d2, d3) = stats[0], self.high[k][1:]
        left = np.where(total > 0, (d1 * stats[1] + d2 * stats[2] + d3 * stats[3]) / np.maximum(total, 1), 1.0)
        seen = c[gram]
        return np.maximum(seen - self.high[k][np.minimum(seen, 3)], 0) / np.maximum(total[of], 1) + left[of] * lower


def all_hot(before: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    """Where all tokens of a context are frequent."""
    out = np.ones(before[0].size, bool)
    for x in before:
        out &= np.isin(x, hot)
    return out


def gram_bucket(context: np.ndarray, h: np.ndarray, spread: np.ndarray, bits: int) -> np.ndarray:
    """By the context, or for a spread context by the word that follows."""
    out = bucket_of(context, bits)
    out[spread] = bucket_of(mixed(h[spread]), bits)
    return out


def _bits(n: int, at_most: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, n / at_most)))))


def _merge_words(folder: str, frequent: float) -> Callable[[tuple, pa.Table], pa.Table]:
    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        b = key[0].as_py()
        w, c = tally((_joined(rows["a"], "<u8"),), _counts(rows, "a"))
        _save(folder, f"word-{b}-key", w)
        _save(folder, f"word-{b}-count", _narrow(c))
        top = np.flatnonzero(c > frequent)
        return pa.table({"types": pa.array([w.size]), "n": pa.array([int(c.sum())]),
                         "top": pa.array([w[top].view(np.int64).tolist()], pa.list_(pa.int64())),
                         "top_n": pa.array([c[top].tolist()], pa.list_(pa.int64()))})

    return merge


def _save_contexts(folder: str, name: str, context: np.ndarray, stats: list[np.ndarray]) -> None:
    order = np.argsort(context)
    _save(folder, f"{name}-key", context[order])
    for field, x in zip(STATS, stats):
        _save(folder, f"{name}-{field}", _narrow(x[order]))


LEVEL = f"kind string, {BLOB}, of_counts array<long>"


def _merge_grams(folder: str, k: int, bits: int, word_bits: int, hot: np.ndarray) -> Callable[[tuple, pa.Table], pa.Table]:
    """A bucket of order ``k``: its arrays, the blobs of the order below ("down") and the sums of spread contexts ("spread")."""

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        own = key[0].as_py()
        runs = _joined(rows["a"], "<u8").reshape(-1, k - 1)
        size = _joined(rows["n"], "<u4")
        before = [np.repeat(runs[:, i], size) for i in range(k - 1)]
        *before, h, c = tally((*before, _joined(rows["b"], "<u8")), _counts(rows, "b"))
        new = np.zeros(h.size, bool)
        new[:1] = True
        for x in before:
            new[1:] |= x[1:] != x[:-1]
        first = np.flatnonzero(new)
        stats = [np.add.reduceat(x, first).astype(np.int64) for x in (c, c == 1, c == 2, c > 2)]
        context, spread = context_key([x[first] for x in before]), all_hot([x[first] for x in before], hot)
        _save_contexts(folder, f"context{k}-{own}", context[~spread], [x[~spread] for x in stats])
        gram = gram_key(np.repeat(context, np.diff(np.r_[first, h.size])), h)
        order = np.argsort(gram)
        _save(folder, f"gram{k}-{own}-key", gram[order])
        _save(folder, f"gram{k}-{own}-count", _narrow(c[order]))
        if k == 2:
            w, contexts = tally((h,))
            down = _blobs(bucket_of(w, word_bits), [w], None, contexts)
        else:
            before = before[:-1]
            bucket = gram_bucket(context_key(before), h, all_hot(before, hot), bits)
            bucket, *before, w, contexts = tally((bucket, *before, h), np.where(before[-1] == START, c, 1))
            down = _blobs(bucket, before, w, contexts)
        at = np.flatnonzero(spread)
        at = at[np.argsort(bucket_of(context[at], bits), kind="stable")]
        shared = _blobs(bucket_of(context[at], bits), [context[at]], None, np.arange(at.size))
        made = pa.Table.from_batches([down, shared])
        sums = np.stack([x[at] for x in stats], 1).astype("<i8")
        edge = np.cumsum([0, *(len(x) // 8 for x in shared.column(1).to_pylist())])
        packed = [*down.column(4).to_pylist(), *(sums[lo:hi].tobytes() for lo, hi in zip(edge[:-1], edge[1:]))]
        made = made.set_column(4, "c", pa.array(packed, pa.binary()))
        kinds = ["down"] * down.num_rows + ["spread"] * shared.num_rows
        counts = [_of_counts(c)] + [[0] * 4] * (len(kinds) - 1)
        return made.add_column(0, "kind", pa.array(kinds)).append_column("of_counts", pa.array(counts, pa.list_(pa.int64())))

    return merge


def _merge_spread(folder: str, k: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        context, parts = _joined(rows["a"], "<u8"), _joined(rows["c"], "<i8").reshape(-1, 4)
        order = np.argsort(context, kind="stable")
        context, parts = context[order], parts[order]
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        _save_contexts(folder, f"spread{k}-{key[0].as_py()}", context[first], list(np.add.reduceat(parts, first).T))
        return pa.table({"contexts": pa.array([first.size])})

    return merge


def train(docs: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Count all of ``docs`` and write the model's arrays to the shared checkpoint folder."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    folder = shared_folder(spark, "kneser-ney")
    word_bits = _bits(docs.select(F.col(text)).rdd.getNumPartitions(), 1)

    def send_words(h: np.ndarray, *_: np.ndarray) -> pa.RecordBatch:
        w, c = tally((h,))
        return _blobs(bucket_of(w, word_bits), [w], None, c)

    words_path = f"file://{folder}/words"
    # a bucket will hold over half of BUCKET tokens, so the words that may fill a quarter of it are known before their number is
    _gathered(docs, text, 2, send_words).groupBy("bucket").applyInArrow(
        _merge_words(folder, BUCKET / 8), "types long, n long, top array<long>, top_n array<long>").write.parquet(words_path)
    sums = spark.read.schema("types long, n long, top array<long>, top_n array<long>").parquet(words_path)
    n, v = (int(x or 0) for x in sums.agg(F.sum("n"), F.sum("types")).first())
    bits = _bits(n, BUCKET)
    hot: list[int] = []
    if bits:  # at most 4 << bits words; the start is the context of every text's first token
        top = sums.select(F.explode(F.arrays_zip("top", "top_n")).alias("t")).where(F.col("t.top_n") > n / (4 << bits))
        hot = [int(START), *(int(np.int64(r[0]).view(np.uint64)) for r in top.select("t.top").collect())]
    hot = np.array(sorted(hot), np.uint64)

    def send_grams(h: np.ndarray, *before: np.ndarray) -> pa.RecordBatch:
        bucket = gram_bucket(context_key(list(before)), h, all_hot(list(before), hot), bits)
        bucket, *before, h, c = tally((bucket, *before, h))
        return _blobs(bucket, before, h, c)

    entries, high = _gathered(docs, text, order, send_grams), {}
    for k in range(order, 1, -1):
        path = f"file://{folder}/level{k}"
        entries.groupBy("bucket").applyInArrow(_merge_grams(folder, k, bits, word_bits, hot), LEVEL).write.parquet(path)
        merged = spark.read.schema(LEVEL).parquet(path)
        of = merged.agg(*(F.sum(F.col("of_counts")[i]) for i in range(4))).first()
        high[k] = [int(x or 0) for x in of]
        if hot.size:
            merged.where("kind = 'spread'").select("bucket", "a", "c").groupBy("bucket").applyInArrow(
                _merge_spread(folder, k), "contexts long").agg(F.sum("contexts")).collect()
        entries = merged.where("kind = 'down'").select("bucket", "a", "n", "b", "c")

    def merge_contexts(key: tuple, rows: pa.Table) -> pa.Table:
        b = key[0].as_py()
        w, c = tally((_joined(rows["a"], "<u8"),), _counts(rows, "a"))
        _save(folder, f"word-{b}-contexts", _narrow(c))  # the same words, in the same order, as word-b-key
        more = [int((c == 1).sum()), int((c == 2).sum()), int((c > 2).sum())]
        return pa.table({"of_counts": pa.array([_of_counts(c)]), "sums": pa.array([more]), "pairs": pa.array([int(c.sum())])})

    last = entries.select("bucket", "a", "c").groupBy("bucket").applyInArrow(
        merge_contexts, "of_counts array<long>, sums array<long>, pairs long")
    last = last.agg(*(F.sum(F.col("of_counts")[i]) for i in range(4)), *(F.sum(F.col("sums")[i]) for i in range(3)), F.sum("pairs"))
    low = [int(x or 0) for x in last.first()]
    return Model(folder, order, word_bits, bits, hot, n, v, low[7], low[:4], low[4:7], high)


OUT = T.StructType([
    *(T.StructField(k, T.LongType()) for k in ("n_tokens", "n_known", "train_tokens")),
    *(T.StructField(k, T.DoubleType()) for k in ("base_score", "score", "perplexity")),
])


def with_score(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (all, if None) of every document, token counts, log10 scores and perplexity by token."""
    fields = without(docs.select(*(docs.columns if carry is None else carry)).schema, OUT.names)
    names = [f.name for f in fields]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.num_columns - 1)
        n_tokens, n_known = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        base, score = np.zeros(len(texts)), np.zeros(len(texts))
        total = np.log10(model.n + 0.5 * (model.v + 1))
        for lo, hi, data, at in blocks(texts, 8 << 20):
            h, before, row = tokens(data, at, model.order)
            p, count = model.log10(h, before)
            n_tokens[lo:hi] = np.bincount(row, minlength=hi - lo)
            n_known[lo:hi] = np.bincount(row[count > 0], minlength=hi - lo)
            base[lo:hi] = np.bincount(row, np.log10(count + 0.5) - total, hi - lo)
            score[lo:hi] = np.bincount(row, p, hi - lo)
        made = [n_tokens, n_known, np.full(len(texts), model.n), base, score, 10 ** np.minimum(-score / np.maximum(n_tokens, 1), 300)]
        return pa.RecordBatch.from_arrays([*batch.columns[:len(names)], *map(pa.array, made)], [*names, *OUT.names])

    given = docs.select(*names, F.col(text).cast("string").alias(unused(docs, "text_of_row")))
    return map_arrow(given, one, T.StructType([*fields, *OUT.fields]))
