"""Spelling variants: words that differ by one letter, found in a frequency-vector trie (operator 12).

A word's frequency vector counts its letters by ``GROUPS`` of letters.  The trie
arranges words by these counts, one group after the other.  Two words that
differ by one inserted, deleted or replaced letter have vectors that differ by
at most one too many and one too few, so a depth-first search for a word's
neighbours goes from a node to the children whose count is the word's own, one
more (spending the surplus) or one less (spending the deficit).  The words of
the leaves that it reaches are verified letter by letter.

On Spark the upper trie is what splits the work.  A node with more than
``LEAF`` words is split by the next group, so the nodes where that ends hold at
most ``LEAF`` words (words of one whole vector beyond that are dealt to blocks).
Their number is about the number of words over ``LEAF``; they are shipped to the
tasks as packed prefixes.  Every word is searched through them, and goes with
what is left of its budget to each node it reaches.  Where many words search one
node (its neighbour in the trie may hold a third of all words) they are dealt to
groups of about ``QUERIES``, each of which gets the node's words.  A group builds
the rest of its trie, searches it for all its words in numpy (frontiers of a
bounded size on a stack, the deepest first), and returns one row a word: how many
are near and the most frequent of them.  No task emits pairs.

Words are counted with DataFrame functions; counting aggregates before the
shuffle, so a frequent word is no hot key.  Chains of forms are followed by
pointer doubling: a form is at least twice as frequent, so 63 links are the
most, and six joins.

Defined results: a null text has no words; a null id counts as an empty text in
the checksum; repeated rows count as often as they occur; an empty table gives
an empty result; ties between forms go to the smaller word in code-point order;
a word without a near word has n_near 0, no form, and itself as root.  Words
are of any length (counts over 255 stand as 255, which only widens the search).
Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import checkpointed, map_arrow

RUN = "([A-Za-z\\u00C0-\\u00FF]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3

#: Letters that are counted together, frequent ones alone; all others are one more group.
GROUPS = ("e", "a", "i", "n", "r", "s", "t", "o", "l", "u", "d", "c", "mh", "gpv", "bfkqwxyzj")
WIDTH = len(GROUPS) + 1

LEAF = 8192
QUERIES = 32768
FRONTIER = 1 << 15
PAIRS = 1 << 16
LONG = 64  # letters; longer words are compared one by one

_GROUP = np.full(256, len(GROUPS), np.uint8)
for _k, _letters in enumerate(GROUPS):
    _GROUP[[ord(c) for c in _letters]] = _k


def words(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur at least ``least`` times."""
    runs = documents.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                            F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), 1)).alias("run"))
    runs = runs.where(F.length("run") >= LEAST_LENGTH).withColumn("run", F.translate("run", UPPER, LOWER))
    h = F.crc32(F.concat_ws(":", "id", "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DROP == 0, cut).otherwise(F.col("run"))
    counted = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return counted.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


# ---- words as arrays

def _letters(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words in a row, offsets); all are below 256."""
    text = column.to_pylist()
    flat = np.frombuffer("".join(text).encode("latin-1"), np.uint8)
    return flat, np.r_[0, np.cumsum([len(w) for w in text], dtype=np.int64)]


def vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The frequency vectors of words, as bytes."""
    flat, at = _letters(column)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    counts = np.bincount(row * WIDTH + _GROUP[flat], minlength=(len(at) - 1) * WIDTH)
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, WIDTH)


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p, least = 0, min(len(a), len(b))
    while p < least and a[p] == b[p]:
        p += 1
    return a[p + (len(a) >= len(b)):] == b[p + (len(b) >= len(a)):]


class Words:
    """Words that can be compared in pairs."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        self.text = column.to_pylist()
        self.size = np.array([len(w) for w in self.text], np.int64)
        width = int(min(self.size.max(initial=0), LONG)) + 2
        self.table = np.zeros((len(self.text), width), np.uint8)
        flat, at = _letters(column)
        row = np.repeat(np.arange(self.size.size), self.size)
        place = np.arange(flat.size) - at[row]
        short = place < width - 2
        self.table[row[short], place[short]] = flat[short]


def near(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (a[i], b[j]) differ by exactly one edit."""
    out = np.zeros(i.size, bool)
    less = a.size[i] - b.size[j]
    long = (a.size[i] > LONG) | (b.size[j] > LONG)
    for k in np.flatnonzero(long & (np.abs(less) <= 1)):
        out[k] = one_edit(a.text[i[k]], b.text[j[k]])
    width = min(a.table.shape[1], b.table.shape[1])  # longer words are out by their length
    k = np.flatnonzero((less == 0) & ~long)
    out[k] = (a.table[i[k], :width] != b.table[j[k], :width]).sum(1) == 1
    for way in (-1, 1):
        k = np.flatnonzero((less == way) & ~long)
        if k.size:
            s, t = (a.table[i[k]], b.table[j[k]]) if way < 0 else (b.table[j[k]], a.table[i[k]])
            s, t = s[:, :width - 1], np.pad(t, ((0, 0), (0, 1)))[:, :width]
            apart = np.logical_or.accumulate(s != t[:, :-1], 1)
            out[k] = ~(apart & (s != t[:, 1:])).any(1)
    return out


# ---- the trie

class Trie:
    """Vectors by successive counts from group ``first``; children stand in order of (node, count)."""

    def __init__(self, vecs: np.ndarray, first: int):
        self.order = np.lexsort(vecs[:, ::-1].T) if len(vecs) else np.zeros(0, np.int64)
        vecs, self.first, self.keys = vecs[self.order], first, []
        node = np.zeros(len(vecs), np.int64)
        for g in range(first, vecs.shape[1]):
            key, node = np.unique((node << 8) | vecs[:, g], return_inverse=True)
            self.keys.append(key)
        self.start = np.searchsorted(node, np.arange(node.max(initial=-1) + 2))  # rows of each leaf

    def search(self, vecs: np.ndarray, more: np.ndarray, less: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of ``vecs``, leaf) of all leaves that each reaches within its surplus and deficit."""
        stack = [(0, q, np.zeros(q.size, np.int64), more[q], less[q])
                 for q in np.array_split(np.arange(len(vecs)), max(1, len(vecs) // FRONTIER))]
        while stack:
            level, q, node, up, down = stack.pop()
            if not q.size:
                continue
            if level == len(self.keys):
                yield q, node
                continue
            found, keys = [], self.keys[level]
            own = vecs[q, self.first + level].astype(np.int64)
            for step, able in ((0, None), (1, up), (-1, down)):
                k = np.arange(q.size) if able is None else np.flatnonzero(able)
                count = own[k] + step
                inside = (count >= 0) & (count < 256)
                key = (node[k] << 8) | np.where(inside, count, 0)
                at = np.minimum(np.searchsorted(keys, key), keys.size - 1)
                hit = inside & (keys[at] == key)
                k = k[hit]
                found.append((q[k], at[hit], up[k] & (step != 1), down[k] & (step != -1)))
            q, node, up, down = (np.concatenate(x) for x in zip(*found))
            for lo in range(0, q.size, FRONTIER):
                stack.append((level + 1, *(x[lo:lo + FRONTIER] for x in (q, node, up, down))))


def _packed(text: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(text.to_pylist()), np.uint8).reshape(len(text), -1)


def _compare(group: pa.Table) -> pa.Table:
    """For each searching word of a group how many stored ones are near, and the most frequent of them."""
    stored = group.filter(group["stored"])
    queries = group.filter(pc.invert(group["stored"]))
    empty = group.schema.empty_table().select(["word", "n", "word", "n"]).rename_columns(["word", "n_near", "best", "best_n"])
    if not len(stored) or not len(queries):
        return empty
    depth = len(group["node"][0].as_py())
    kept, asked = stored["word"].combine_chunks(), queries["word"].combine_chunks()
    trie = Trie(vectors(kept), depth)
    a, b = Words(asked), Words(kept.take(pa.array(trie.order)))
    n = stored["n"].to_numpy()[trie.order]
    hits = []
    flags = queries["budget"].to_numpy()
    for q, leaf in trie.search(vectors(asked), (flags & 1) > 0, (flags & 2) > 0):
        lo, size = trie.start[leaf], trie.start[leaf + 1] - trie.start[leaf]
        ends = np.cumsum(size)
        for first in range(0, int(ends[-1]), PAIRS):  # pairs of words, some at a time
            pair = np.arange(first, min(first + PAIRS, int(ends[-1])))
            k = np.searchsorted(ends, pair, "right")
            i, j = q[k], lo[k] + pair - (ends[k] - size[k])
            close = np.flatnonzero(np.abs(a.size[i] - b.size[j]) <= 1)
            i, j = i[close], j[close]
            good = near(a, i, b, j)
            hits.append((i[good], j[good]))
    if not hits or not any(i.size for i, _ in hits):
        return empty
    i, j = (np.concatenate(x) for x in zip(*hits))
    rank = np.empty(len(b.text), np.int64)
    rank[sorted(range(len(b.text)), key=b.text.__getitem__)] = np.arange(len(b.text))
    by = np.lexsort((rank[j], -n[j], i))
    i, j = i[by], j[by]
    own, first, many = np.unique(i, return_index=True, return_counts=True)
    return pa.table({"word": asked.take(pa.array(own)), "n_near": pa.array(many.astype(np.int64)),
                     "best": pa.array([b.text[k] for k in j[first]], pa.string()), "best_n": pa.array(n[j[first]])})


def _upper(vocabulary: DataFrame, leaf: int) -> set[bytes]:
    """Prefixes of vectors that more than ``leaf`` words share: about words / leaf a group of letters."""
    distinct = vocabulary.groupBy("vec").agg(F.count("*").alias("n"))
    prefixes = distinct.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(WIDTH)), lambda k: F.substring("vec", F.lit(1), k)))
                               .alias("prefix"), "n")
    many = prefixes.groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") > leaf)
    return {bytes(r["prefix"]) for r in many.select("prefix").collect()}


class Upper:
    """The upper trie: a node that is not among ``large``, or is a whole vector, is where a word stays."""

    def __init__(self, large: set[bytes]):
        self.large = large

    def home(self, vec: bytes) -> bytes:
        k = 0
        while k < WIDTH and vec[:k] in self.large:
            k += 1
        return vec[:k]

    def reached(self, vec: bytes, nodes: dict[bytes, int]) -> list[tuple[bytes, int]]:
        """(node, budget) of the nodes with words that a search from ``vec`` reaches; bit 1 of a budget: surplus, bit 2: deficit."""
        out, stack = [], [(b"", 3)]
        while stack:
            prefix, left = stack.pop()
            k = len(prefix)
            if k == WIDTH or prefix not in self.large:
                if prefix in nodes:
                    out.append((prefix, left))
                continue
            own = vec[k]
            stack.append((prefix + bytes([own]), left))
            if left & 1 and own < 255:
                stack.append((prefix + bytes([own + 1]), left & 2))
            if left & 2 and own:
                stack.append((prefix + bytes([own - 1]), left & 1))
        return out


def neighbours(vocabulary: DataFrame, leaf: int = LEAF, queries: int = QUERIES) -> DataFrame:
    """(word, n_near, best, best_n) of the words of (word, n) that have a near word."""
    spark = vocabulary.sparkSession

    def with_vector(batch: pa.RecordBatch) -> pa.RecordBatch:
        vecs = vectors(batch.column(0))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([v.tobytes() for v in vecs], pa.binary())], ["word", "n", "vec"])

    vecs = map_arrow(vocabulary.select("word", "n"), with_vector, "word string, n long, vec binary")
    upper = Upper(_upper(vecs, leaf))

    def with_home(batch: pa.RecordBatch) -> pa.RecordBatch:
        home = {v: upper.home(v) for v in set(batch.column(2).to_pylist())}
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([home[v] for v in batch.column(2).to_pylist()], pa.binary())], ["word", "n", "vec", "node"])

    placed = map_arrow(vecs, with_home, "word string, n long, vec binary, node binary")
    nodes = {bytes(r["node"]): r["n"] for r in placed.groupBy("node").agg(F.count("*").alias("n")).collect()}  # about words / leaf

    def searched(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[bytes, list] = {}
        rows, at, left = [], [], []
        for k, v in enumerate(batch.column(2).to_pylist()):
            got = seen.get(v)
            if got is None:
                got = seen[v] = upper.reached(v, nodes)
            for node, budget in got:
                rows.append(k)
                at.append(node)
                left.append(budget)
        word = batch.column(0).take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([word, pa.array(at, pa.binary()), pa.array(left, pa.int32())], ["word", "node", "budget"])

    asked = checkpointed(map_arrow(vecs, searched, "word string, node binary, budget int"))
    split = asked.groupBy("node").agg(F.count("*").alias("asking"))
    split = spark.createDataFrame(  # as many rows as there are nodes
        [(r["node"], max(1, -(-nodes[bytes(r["node"])] // leaf)), max(1, -(-r["asking"] // queries))) for r in split.collect()],
        "node binary, blocks int, chunks int")
    deal = lambda column: F.pmod(F.xxhash64("word"), F.col(column)).cast("int")
    every = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    stored = placed.join(split, "node").withColumn("block", deal("blocks")).withColumn("chunk", every("chunks"))
    asking = asked.join(split, "node").withColumn("chunk", deal("chunks")).withColumn("block", every("blocks"))
    both = stored.select("node", "block", "chunk", "word", "n", F.lit(0).alias("budget"), F.lit(True).alias("stored")).unionByName(
        asking.select("node", "block", "chunk", "word", F.lit(0).cast("long").alias("n"), "budget", F.lit(False).alias("stored")))
    found = both.groupBy("node", "block", "chunk").applyInArrow(_compare, "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), following forms to the last by pointer doubling."""
    state = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = state.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        far = checkpointed(far)
        state = far.drop("moved")
        if far.where("moved").isEmpty():
            return state


def variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF, queries: int = QUERIES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word; see the module's text."""
    vocabulary = checkpointed(words(documents, id_col, text_col))
    found = neighbours(vocabulary, leaf, queries)
    good = F.col("best_n") >= 2 * F.col("n")
    each = checkpointed(vocabulary.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")))
    last = roots(each.where("form IS NOT NULL"))
    return each.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
