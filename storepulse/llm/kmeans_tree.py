"""Approximate nearest neighbours by a hierarchical k-means tree (operator 13).

The tree is fitted on a bounded sample (``SAMPLE`` rows, the first by hash):
a node's rows are split by k-means into ``BRANCHES``, and these again, until
there are about as many leaves as ``LEAF_ROWS`` rows each need, ``MOST_LEAVES``
at most.  Every row of the table is placed in a leaf by descent to the nearest
centre; this index is written once to the shared folder.

A search is best-bin-first: a priority queue holds the nodes seen so far by the
distance of their centre; the nearest is taken, an inner node puts its children
in, a leaf is visited.  How many leaves a search visits is calibrated:
``CALIBRATION`` sampled rows get their exact nearest by a pass over all rows,
and visits are widened (doubled, then cut back to the least that does) until
``RECALL`` of these is found.  Where nothing clusters that is most leaves.

On Spark a visited leaf is a group of the leaf's rows and the queries that visit
it.  Leaves with over ``BLOCK`` rows are dealt to blocks and queries to chunks of
``CHUNK``, so that a leaf with a third of all rows is many groups of a bounded
size, and every row of it is compared.  A group returns the nearest k of its
rows for each query; the nearest k of these are ranked by a window, which cuts
before its shuffle.  Distances come from a matrix product, and are computed
again, sqrt(sum((a - b)^2)) in double precision, for all within rounding of the
k-th, which is what ranks.

Of equal vectors in a group only the k smallest ids that aren't the query's own
can be among its nearest, so the others are not measured.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part; vectors of different lengths are not compared; a row
with the query's own id is never its candidate; each different (id, vector) is a
query once; fewer candidates than k: all of them; a candidate with a null id
comes after others at its distance; a null id is no query.  An empty table gives
an empty result.  Extra columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import checkpointed, map_arrow

K = 10
RECALL = 0.95
SAMPLE = 16384
CALIBRATION = 128
BRANCHES = 16
STEPS = 10
LEAF_ROWS = 256
MOST_LEAVES = 4096
BLOCK = 8192
CHUNK = 1024
SEED = 13
#: Numbers in a temporary array.
CELLS = 1 << 20


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The nearest of up to k centres of each row, by Lloyd's steps from different rows."""
    different = np.unique(x, axis=0)
    centres = different[rng.choice(len(different), min(k, len(different)), replace=False)]
    own = squared(x, centres).argmin(1)
    for _ in range(STEPS):
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = (total / np.maximum(size, 1)[:, None])[size > 0]
        own, before = squared(x, centres).argmin(1), own
        if np.array_equal(own, before):
            break
    return own


class Tree:
    """Centres of nodes; a node without children is a leaf, numbered by ``leaf``."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._grow(sample, max(1, len(sample) // max(1, leaves)), np.random.default_rng(SEED))
        self.centres = np.array(self.centres)

    def _grow(self, x: np.ndarray, rows: int, rng: np.random.Generator) -> int:
        node = len(self.centres)
        self.centres.append(x.mean(0))
        self.children.append([])
        self.leaf.append(-1)
        if len(x) > rows:
            own = kmeans(x, min(BRANCHES, -(-len(x) // rows)), rng)
            parts = [x[own == c] for c in np.unique(own)]
            if len(parts) > 1:
                self.children[node] = [self._grow(p, rows, rng) for p in parts]
        if not self.children[node]:
            self.leaf[node] = self.leaves
            self.leaves += 1
        return node

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            own = squared(x[rows], self.centres[kids]).argmin(1)
            todo += [(kid, rows[own == c]) for c, kid in enumerate(kids) if (own == c).any()]
        return out

    def best_bins(self, x: np.ndarray, visits: int) -> Iterator[list[int]]:
        """For each row the leaves that a best-bin-first search visits, in order."""
        step = max(1, CELLS // len(self.centres))
        for lo in range(0, len(x), step):
            for far in squared(x[lo:lo + step], self.centres).tolist():
                queue, seen = [(far[0], 0)], []
                while queue and len(seen) < visits:
                    _, node = heapq.heappop(queue)
                    if self.leaf[node] >= 0:
                        seen.append(self.leaf[node])
                    for kid in self.children[node]:
                        heapq.heappush(queue, (far[kid], kid))
                yield seen


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _numbered(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Equal ids as equal numbers, of any type; null is -1."""
    both = pa.concat_arrays([a, b]).dictionary_encode().indices.fill_null(-1).to_numpy()
    return both[:len(a)], both[len(a):]


def nearest(x: np.ndarray, ids: pa.Array, queries: np.ndarray, own: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row of x, distance) of the k nearest rows of each query that have another id; all within ties, then cut."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    # of equal vectors the k + 1 smallest ids: the query's own may be one of them
    _, group = np.unique(x[order], axis=0, return_inverse=True)
    by = np.argsort(group.ravel(), kind="stable")
    first = np.r_[True, np.diff(group.ravel()[by]) != 0]
    place = np.arange(len(by)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    kept = order[np.sort(by[place <= k])]
    x, number, own = x[kept], *_numbered(ids.take(pa.array(kept)), own)
    size = (x * x).sum(1)
    out, step = [], max(1, CELLS // len(x))
    for lo in range(0, len(queries), step):
        q = queries[lo:lo + step]
        far = squared(q, x)
        far[number[None, :] == own[lo:lo + step, None]] = np.inf
        slack = 1e-12 * (size + (q * q).sum(1)[:, None])  # far above rounding
        most = np.partition(far + slack, k - 1, axis=1)[:, k - 1:k] if k < len(x) else np.inf
        i, j = np.nonzero((far - slack <= most) & np.isfinite(far))
        exact, rows = np.empty(i.size), max(1, CELLS // x.shape[1])
        for a in range(0, i.size, rows):
            s = slice(a, a + rows)
            exact[s] = np.sqrt(np.square(q[i[s]] - x[j[s]]).sum(1))
        by = np.lexsort((rank[kept[j]], exact, i))
        i, j, exact = i[by], j[by], exact[by]
        first = np.searchsorted(i, i)
        top = np.arange(i.size) - first < k
        out.append((i[top] + lo, kept[j[top]], exact[top]))
    return tuple(np.concatenate(c) for c in zip(*out))


@dataclass
class Index:
    rows: DataFrame  # (row, id, vec, leaf), written
    tree: Tree
    sizes: dict[int, int]  # rows of each leaf
    visits: int
    recall: float  # of the calibration queries at so many visits


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.col(vec_col)
    fine = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(vec, lambda c: c != 0)
    return vectors.where(F.coalesce((F.size(vec) > 0) & fine, F.lit(False))).select(
        F.col(id_col).alias("id"), F.transform(vec, lambda c: c + F.lit(0).cast("float")).alias("vec"))  # zeros of one sign


def _top(found: DataFrame, key: str, k: int) -> DataFrame:
    window = Window.partitionBy(key).orderBy("score", F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _exact(rows: DataFrame, own: pa.Array, queries: np.ndarray, k: int) -> DataFrame:
    """(q, id, leaf, score) of the k nearest of a few queries among all rows."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        i, j, far = nearest(_matrix(batch.column(1)), batch.column(0), queries, own, k)
        j = pa.array(j)
        return pa.RecordBatch.from_arrays([pa.array(i), batch.column(0).take(j), batch.column(2).take(j), pa.array(far)],
                                          ["q", "id", "leaf", "score"])

    return _top(map_arrow(rows.select("id", "vec", "leaf"), of, T.StructType([
        T.StructField("q", T.LongType()), rows.schema["id"], T.StructField("leaf", T.IntegerType()),
        T.StructField("score", T.DoubleType())])), "q", k)


def build(usable: DataFrame, k: int = K, recall: float = RECALL, sample: int = SAMPLE, calibration: int = CALIBRATION,
          leaf_rows: int = LEAF_ROWS) -> Index | None:
    """The index of vectors (id, vec) of one length; None without any."""
    total = usable.count()
    if not total:
        return None
    # in the order of a hash: a sample of the different vectors, ``sample`` and ``calibration`` rows at most
    picked = usable.dropDuplicates(["vec"]).orderBy(F.xxhash64("vec")).limit(sample).select("vec").collect()
    tree = Tree(np.array([r["vec"] for r in picked], np.float64), min(MOST_LEAVES, -(-total // leaf_rows)))
    asked = usable.orderBy(F.xxhash64("vec", F.lit(SEED)), F.xxhash64("id"), "id").limit(calibration).toArrow()

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.place(_matrix(batch.column(1))))], ["id", "vec", "leaf"])

    placed = map_arrow(usable, place, T.StructType([*usable.schema.fields, T.StructField("leaf", T.IntegerType())]))
    rows = checkpointed(placed.withColumn("row", F.monotonically_increasing_id()))
    sizes = {r["leaf"]: r["n"] for r in rows.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # MOST_LEAVES at most

    queries = _matrix(asked["vec"])
    truth = _exact(rows, asked["id"].combine_chunks(), queries, k).select("q", "leaf").collect()  # k a query
    turn = [{leaf: t for t, leaf in enumerate(seen, 1)} for seen in tree.best_bins(queries, tree.leaves)]
    needed = np.array([turn[r["q"]][r["leaf"]] for r in truth])
    found = lambda visits: float((needed <= visits).mean()) if needed.size else 1.0
    visits = 1
    while found(visits) < recall:
        visits *= 2
    visits = next(v for v in range(visits // 2 or 1, visits + 1) if found(v) >= recall)
    return Index(rows, tree, sizes, min(visits, tree.leaves), found(visits))


def search(index: Index, queries: DataFrame, k: int = K, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(q, query_id, rank, id, score) of queries (q, id, vec)."""
    spark, tree, visits = queries.sparkSession, index.tree, index.visits

    def visited(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = list(tree.best_bins(_matrix(batch.column(2)), visits))
        at = pa.array(np.repeat(np.arange(len(seen)), [len(s) for s in seen]))
        return pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns), pa.array(np.concatenate(seen), pa.int32())],
                                          ["q", "id", "vec", "leaf"])

    visiting = map_arrow(queries.select("q", "id", "vec"), visited, T.StructType(
        [*queries.select("q", "id", "vec").schema.fields, T.StructField("leaf", T.IntegerType())]))
    asked = visiting.groupBy("leaf").agg(F.count("*").alias("n")).collect()  # MOST_LEAVES at most
    split = spark.createDataFrame([(r["leaf"], -(-index.sizes[r["leaf"]] // block), -(-r["n"] // chunk)) for r in asked
                                   if r["leaf"] in index.sizes], "leaf int, blocks int, chunks int")
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stored = index.rows.join(F.broadcast(split), "leaf").withColumn("block", deal("row", "blocks")).withColumn("chunk", every("chunks"))
    asking = visiting.join(F.broadcast(split), "leaf").withColumn("chunk", deal("q", "chunks")).withColumn("block", every("blocks"))
    both = stored.select("leaf", "block", "chunk", F.lit(None).cast("long").alias("q"), "id", "vec").unionByName(
        asking.select("leaf", "block", "chunk", "q", "id", "vec"))

    def compare(group: pa.Table) -> pa.Table:
        is_row = pc.is_null(group["q"])
        rows, asked = group.filter(is_row), group.filter(pc.invert(is_row))
        if not len(rows) or not len(asked):
            return group.schema.empty_table().select(["q", "id", "id"]).rename_columns(["q", "query_id", "id"]).append_column(
                "score", pa.array([], pa.float64()))
        ids, own = rows["id"].combine_chunks(), asked["id"].combine_chunks()
        i, j, far = nearest(_matrix(rows["vec"]), ids, _matrix(asked["vec"]), own, k)
        i = pa.array(i)
        return pa.table({"q": asked["q"].take(i), "query_id": own.take(i), "id": ids.take(pa.array(j)), "score": pa.array(far)})

    kind = index.rows.schema["id"].dataType
    found = both.groupBy("leaf", "block", "chunk").applyInArrow(compare, T.StructType([
        T.StructField("q", T.LongType()), T.StructField("query_id", kind), T.StructField("id", kind), T.StructField("score", T.DoubleType())]))
    return _top(found, "q", k)


def neighbours(vectors: DataFrame, asking: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
               block: int = BLOCK, chunk: int = CHUNK, **how) -> DataFrame:
    """(query_id, rank, id, score) of the k nearest rows found of each row for which ``asking`` (of its id column) holds."""
    usable = _usable(vectors, id_col, vec_col)
    wanted = _usable(vectors.where(asking), id_col, vec_col)
    out = None
    for size in sorted(r[0] for r in usable.select(F.size("vec")).distinct().collect()):  # usually one length
        index = build(usable.where(F.size("vec") == size), k, **how)
        queries = checkpointed(wanted.where((F.size("vec") == size) & F.col("id").isNotNull()).distinct().withColumn(
            "q", F.monotonically_increasing_id()))
        found = search(index, queries, k, block, chunk)
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = vectors.schema[id_col].dataType
        return vectors.sparkSession.createDataFrame([], T.StructType([
            T.StructField("query_id", kind), T.StructField("rank", T.IntegerType()), T.StructField(id_col, kind),
            T.StructField("score", T.DoubleType())]))
    return out.select("query_id", "rank", F.col("id").alias(id_col), "score")
