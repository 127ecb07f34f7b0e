"""Exact near-duplicate vectors by cover trees and dual traversal (operator 10).

Unit vectors at cosine c are sqrt(2 - 2c) apart, so pairs above a cosine are
pairs within a distance, and a tree whose nodes have a centre and a covering
radius can drop two nodes at once when their centres are farther apart than
both radii and that distance together.

Above the blocks the levels are made in Spark.  The first level's centres come
from a bounded sample of the different vectors (``SAMPLE``) in farthest-first
order; all vectors go to their nearest centre, and the cells' radii are measured
on all vectors.  Cells of over two blocks are then sampled by themselves and
split at half their radius, level by level, until they are small, balls of half
the radius cover less than half a block, or there are ``MOST_CELLS``.  Rows that
no ball of a split covers stay a cell by themselves, split again likewise.  Two cells within all of whose
distance everything links are settled by their sums, in linear work, however
many rows they hold; pairs that the bound drops are gone; the others are
compared in blocks of about ``BLOCK`` vectors, each pair of blocks in a group of
its own.  Inside the blocks nodes are split at half their radius again, both
blocks' trees are descended together under the same two bounds, and pairs of
leaves that neither settles are compared by one matrix product in double precision,
of the rows that a bound on a few leading axes leaves.

Equal vectors are one row throughout, with their number.  A task returns, for
each vector, how many rows its links reach, and only as many edges as it needs
to connect what is linked: no task emits all pairs of a group.

The bound decides what is compared, never what counts as a link, so the result
is exact whatever the sample.  Where distances hardly differ (random directions
in many dimensions) it drops little, splits bring no smaller radii and are not
kept, and work grows with the square of the number of different vectors; in
clustered data most pairs of cells go, and dense clusters are settled whole.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing (0 links, a component of their own); vectors of
different lengths never link; equal vectors link; rows with equal ids each get
their row; a null id is never a component's smallest unless all its ids are null;
an empty table gives an empty result.  Extra columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import Forest, components
from .frames import checkpointed, map_arrow

LEAST = 0.95
SAMPLE = 2048
MOST_CELLS = 1024
BLOCK = 4096
LEAF = 256
FEW = 32  # rows that are never split
BRANCHES = 16
SHRINK = 0.8  # a small node is split if radii fall to this share of its own
SLACK = 1e-6  # of a bound, far above rounding
HEAD = 24  # leading axes by which pairs of rows are dropped before their products are taken
HEAD_ROWS = 512  # rows of a group that these axes are taken from
HEAD_SLACK = 1e-4  # of that bound, far above rounding in single precision


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1, in double precision; no row is zero."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares can't overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def apart(cosine: np.ndarray | float) -> np.ndarray | float:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def farthest_first(x: np.ndarray, most: int, radius: float = 0.0) -> tuple[list[int], np.ndarray]:
    """Centres, each the farthest from those before, until all are within ``radius`` or there are ``most``.

    Also each row's distance to its nearest centre.
    """
    centres, near = [0], apart(x @ x[0])
    while len(centres) < most and near.max() > radius:
        centres.append(int(near.argmax()))
        near = np.minimum(near, apart(x @ x[centres[-1]]))
    return centres, near


def fullest_first(x: np.ndarray, most: int, radius: float) -> list[int]:
    """Centres, each with the most rows within ``radius`` that those before don't cover, while it covers another than itself."""
    near = x @ x.T >= 1 - radius * radius / 2
    left, centres = np.ones(len(x), bool), []
    while len(centres) < most:
        covers = near @ left.astype(np.int64)
        best = int(covers.argmax())
        if covers[best] < 2:
            break
        centres.append(best)
        left &= ~near[best]
    return centres


class Node:
    """Rows [lo, hi) of a tree, all within ``radius`` of ``centre``."""

    __slots__ = ("lo", "hi", "centre", "radius", "children")

    def __init__(self, lo: int, hi: int, centre: np.ndarray, radius: float, children: list):
        self.lo, self.hi, self.centre, self.radius, self.children = lo, hi, centre, radius, children


class Tree:
    """Nested nodes over unit vectors, each level at half the radius of the one above or less where it can be."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.x = x
        self.root = self._grow(0, len(x))
        self.x = x[self.order]

    def _grow(self, lo: int, hi: int) -> Node:
        rows = self.order[lo:hi]
        x = self.x[rows]
        centre = unit(x.mean(0, keepdims=True) + 1e-12)[0]
        radius = float(apart(x @ centre).max())
        node = Node(lo, hi, centre, radius, [])
        if hi - lo <= FEW or radius < SLACK:
            return node
        centres, _ = farthest_first(x, BRANCHES, radius / 2)
        close = x @ x[centres].T
        own = close.argmax(1)
        size = np.bincount(own, minlength=len(centres))
        if hi - lo <= LEAF or size.max() > 0.9 * (hi - lo):  # split only where radii fall, so not where nothing clusters
            far = np.zeros(len(centres))
            np.maximum.at(far, own, apart(close[np.arange(hi - lo), own]))
            if size @ far > SHRINK * radius * (hi - lo):
                return node
        self.order[lo:hi] = rows[np.argsort(own, kind="stable")]
        edge = lo + np.r_[0, np.cumsum(size)]
        node.children = [self._grow(int(a), int(b)) for a, b in zip(edge[:-1], edge[1:]) if b > a]
        return node


def dual_pairs(a: Tree, b: Tree, within: float):
    """(p, q, whole): pairs of nodes that may hold rows within the distance; each pair once if the trees are the same.

    ``whole``: every row of one is within it of every row of the other; otherwise both are leaves.
    """
    todo = [(a.root, b.root)]
    while todo:
        p, q = todo.pop()
        between, reach = math.sqrt(max(2 - 2 * float(p.centre @ q.centre), 0)), p.radius + q.radius
        if between > reach + within + SLACK:
            continue
        if between + reach <= within - SLACK:
            yield p, q, True
        elif p is q and p.children:
            todo += [(x, y) for i, x in enumerate(p.children) for y in p.children[i:]]
        elif p.children and (p.radius >= q.radius or not q.children):
            todo += [(x, q) for x in p.children]
        elif q.children:
            todo += [(p, y) for y in q.children]
        else:
            yield p, q, False


def heads(x: np.ndarray) -> np.ndarray | None:
    """For each unit vector a short one; no two vectors' cosine is above the product of their short ones.

    These are the coordinates on ``HEAD`` orthonormal axes, on which the vectors are longest, and the
    length of what these leave: what they leave of two vectors adds the product of the lengths at most.
    None if that is hardly shorter than the vectors.
    """
    if x.shape[1] < 2 * HEAD or len(x) < HEAD:
        return None
    some = x[::-(-len(x) // HEAD_ROWS)]
    axes = np.linalg.svd(some, full_matrices=False)[2][:HEAD]
    head = x @ axes.T
    rest = np.sqrt(np.maximum(1 - (head * head).sum(1, keepdims=True), 0))
    return np.concatenate([head, rest], 1).astype(np.float32)


def linked_within(x: np.ndarray, n: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows linked to each vector, label of each vector's component, pairs compared) over one or two blocks of unit vectors.

    ``n``: rows that have the vector; ``side``: 0 or 1.  With both sides present only
    links between them are looked for, with one side those within it.
    """
    one = side.size and not side.any()
    at = [np.flatnonzero(side == s) for s in ((0,) if one else (0, 1))]
    trees = [Tree(x[i]) for i in at if i.size]
    links, forest, compared = np.zeros(len(x), np.int64), Forest(len(x)), 0
    if len(trees) < len(at):
        return links, forest.label, compared
    a, b = trees[0], trees[-1]
    row_a, row_b = at[0][a.order], at[-1][b.order]
    head = heads(x)
    head_a, head_b = (None, None) if head is None else (head[row_a], head[row_b])

    def compare(p_lo: int, p_hi: int, q_lo: int, q_hi: int, same: bool) -> None:
        for lo in range(p_lo, p_hi, 512):
            hi = min(p_hi, lo + 512)
            u, v, i, j = a.x[lo:hi], b.x[q_lo:q_hi], row_a[lo:hi], row_b[q_lo:q_hi]
            if head is not None:
                may = head_a[lo:hi] @ head_b[q_lo:q_hi].T >= least - HEAD_SLACK
                if not may.any():
                    continue
                some, others = may.any(1), may.any(0)
                u, v, i, j = u[some], v[others], i[some], j[others]
            near = u @ v.T >= least
            if same:
                near &= i[:, None] != j[None, :]
            if not near.any():
                continue
            links[i] += near @ n[j]
            if not same:
                links[j] += near.T @ n[i]
            u, v = np.nonzero(near & (forest.label[i][:, None] != forest.label[j][None, :]))
            forest.join(i[u], j[v])

    met: dict[tuple[int, int], list] = {}  # of a leaf, the rows of the leaves that it is compared with
    for p, q, whole in dual_pairs(a, b, float(apart(least))):
        if whole:
            i, j = row_a[p.lo:p.hi], row_b[q.lo:q.hi]
            links[i] += n[j].sum()
            if p is q:
                links[i] -= n[i]
            else:
                links[j] += n[i].sum()
            both = np.r_[i, j]
            other = both[forest.label[both] != forest.label[i[0]]]
            forest.join(np.full(other.size, i[0]), other)
            continue
        compared += (p.hi - p.lo) * (q.hi - q.lo)
        if p is q:
            compare(p.lo, p.hi, q.lo, q.hi, True)
        else:
            met.setdefault((p.lo, p.hi), []).append((q.lo, q.hi))
    for (lo, hi), ranges in met.items():
        ranges.sort()
        first = 0
        for k in range(1, len(ranges) + 1):  # leaves side by side are compared at once
            if k == len(ranges) or ranges[k][0] != ranges[k - 1][1]:
                compare(lo, hi, ranges[first][0], ranges[k - 1][1], False)
                first = k
    return links, forest.label, compared


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return unit(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


class Cells:
    """Nested centres: a row goes from the root (node 0) to its nearest child until its node has none, a cell.

    A child covers rows within its parent's ``limit``; rows that none covers go to the
    node's last child, the rest, which keeps the parent's centre.
    """

    def __init__(self, dim: int):
        self.centre = np.zeros((1, dim))
        self.children: dict[int, np.ndarray] = {}
        self.limit: dict[int, float] = {}

    def split(self, node: int, centres: np.ndarray, limit: float = 3.0) -> None:
        self.children[node] = np.arange(len(self.centre), len(self.centre) + len(centres) + 1)
        self.limit[node] = limit
        self.centre = np.concatenate([self.centre, centres, self.centre[node:node + 1]])

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its centre) of unit vectors."""
        cell, todo = np.zeros(len(x), np.int64), [0]
        while todo:
            node = todo.pop()
            if node in self.children:
                rows = np.flatnonzero(cell == node)
                if rows.size:
                    kids = self.children[node]
                    close = x[rows] @ self.centre[kids[:-1]].T
                    covered = apart(close.max(1)) <= self.limit[node]
                    cell[rows] = np.where(covered, kids[close.argmax(1)], kids[-1])
                    todo += kids.tolist()
        return cell, apart((x * self.centre[cell]).sum(1))


def _placed(classes: DataFrame, cells: Cells) -> DataFrame:
    """The classes with their ``cell`` and how ``far`` they are from its centre."""

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        cell, far = cells.place(_matrix(batch.column(2)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)],
                                          [*batch.schema.names, "cell", "far"])

    given = classes.select("cls", "n", "vec")
    return map_arrow(given, place, T.StructType(
        [*given.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())]))


def _measured(classes: DataFrame, cells: Cells) -> dict:
    """Of each cell with vectors: their number ``n``, radius ``far``, rows ``total`` and smallest class ``first``."""
    found = _placed(classes, cells).groupBy("cell").agg(
        F.count("*").alias("n"), F.max("far").alias("far"), F.sum("n").alias("total"), F.min("cls").alias("first"))
    return {r["cell"]: r for r in found.collect()}  # MOST_CELLS at most, and what is tried


def nested_cells(classes: DataFrame, least: float = LEAST, sample: int = SAMPLE, most_cells: int = MOST_CELLS,
                 block: int = BLOCK) -> tuple[Cells, dict]:
    """Levels of cells over all ``classes`` (cls, n, vec) of one length, and what ``_measured`` says of the lowest."""
    spark, total = classes.sparkSession, classes.count()
    rows = classes.orderBy(F.xxhash64("vec"), "cls").limit(sample).select("vec").collect()  # ``sample`` at most
    picked = unit(np.array([r["vec"] for r in rows], np.float64))
    cells = Cells(picked.shape[1])
    wanted = min(max(1, most_cells // 4), max(1, total // block))
    cells.split(0, picked[farthest_first(picked, wanted)[0]])
    known, closed = _measured(classes, cells), set()
    while True:
        room = most_cells - len(known)
        dense = [c for c in known if c not in closed and known[c]["n"] > 2 * block
                 and 2 * known[c]["far"] > float(apart(least)) - SLACK]
        dense = sorted(dense, key=lambda c: (-known[c]["n"], c))[:room]
        if not dense:
            return cells, known
        # as many rows of each, by hash
        take = pa.table({"cell": pa.array(dense, pa.int32()),
                         "take": [int(min(1.0, sample / len(dense) / known[c]["n"]) * 2**30) for c in dense]})
        own = _placed(classes, cells).join(F.broadcast(spark.createDataFrame(take)), "cell")
        own = own.where(F.pmod(F.xxhash64("vec"), F.lit(2**30)) < F.col("take")).select("cell", "vec")
        seen: dict[int, list] = {c: [] for c in dense}
        for r in own.limit(2 * sample).collect():  # about ``sample``, never more than twice that
            seen[r["cell"]].append(r["vec"])
        tried = []
        for c in dense:
            most = min(BRANCHES, known[c]["n"] // block, room // len(dense))
            closed.add(c)
            if len(seen[c]) > 1:
                x = unit(np.array(sorted(seen[c]), np.float64))
                centres = fullest_first(x, most, known[c]["far"] / 2)
                if centres:
                    cells.split(c, x[centres], known[c]["far"] / 2)
                    tried.append(c)
        if not tried:
            return cells, known
        found = _measured(classes, cells)
        for c in tried:
            kids = {k: found[k] for k in cells.children[c].tolist() if k in found}
            if any(2 * r["n"] >= block and k != cells.children[c][-1] for k, r in kids.items()):
                del known[c]
                known |= kids
            else:
                del cells.children[c]


def _links_of(classes: DataFrame, least: float, sample: int, most_cells: int, block: int) -> DataFrame:
    """(a, b, n): n rows linked to class a (b null), and edges between classes; vectors of one length."""
    spark = classes.sparkSession
    cells, known = nested_cells(classes, least, sample, most_cells, block)
    placed = _placed(classes, cells)
    ids = np.array(sorted(known))
    n, far, total, first = (np.array([known[c][name] for c in ids.tolist()]) for name in ("n", "far", "total", "first"))
    between, reach = apart(cells.centre[ids] @ cells.centre[ids].T), far[:, None] + far[None, :]
    within = float(apart(least))
    whole = between + reach <= within - SLACK
    np.fill_diagonal(whole, 2 * far <= within - SLACK)
    near = ~whole & (between <= reach + within + SLACK)
    np.fill_diagonal(near, ~whole.diagonal())
    blocks = np.maximum(1, np.rint(n / block)).astype(np.int64)
    i, j = np.nonzero(near)  # MOST_CELLS ** 2 at most
    pairs = spark.createDataFrame(pa.table({
        "cell": pa.array(ids[i], pa.int32()), "other": pa.array(ids[j], pa.int32()),
        "own_blocks": pa.array(blocks[i], pa.int32()), "other_blocks": pa.array(blocks[j], pa.int32())}))

    # every row goes to each pair of blocks that its own block is in
    mine = placed.join(F.broadcast(pairs), "cell").withColumn(
        "block", F.pmod(F.xxhash64("cls"), F.col("own_blocks")).cast("int"))
    mine = mine.withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)))
    me, it = F.struct("cell", "block"), F.struct(F.col("other").alias("cell"), F.col("other_block").alias("block"))
    dealt = mine.select("cls", "n", "vec", F.least(me, it).alias("left"), F.greatest(me, it).alias("right"),
                        (me > it).cast("int").alias("side"))

    def compare(group: pa.Table) -> pa.Table:
        cls, n = group["cls"].to_numpy(), group["n"].to_numpy()
        side = group["side"].to_numpy()
        links, label, _ = linked_within(_matrix(group["vec"]), n, side, least)
        some, joined = np.flatnonzero(links), np.flatnonzero(label != np.arange(label.size))
        none = pa.nulls(some.size, pa.int64())
        return pa.table({"a": pa.array(np.r_[cls[some], cls[joined]]),
                         "b": pa.chunked_array([none, pa.array(cls[label[joined]])], pa.int64()),
                         "n": pa.chunked_array([pa.array(links[some]), pa.nulls(joined.size, pa.int64())], pa.int64())})

    # a block meets itself in a group of one side, and another one in a group of two
    found = dealt.groupBy("left", "right").applyInArrow(compare, "a long, b long, n long")

    # cells that link as a whole: rows by their sums, components by the cells' first classes
    reached = whole @ total
    some = np.flatnonzero(whole.any(1))
    if not (reached - np.where(whole.diagonal(), n == 1, 0) * total).any():
        return found  # single vectors alone with themselves
    settled = spark.createDataFrame(pa.table({
        "cell": pa.array(ids[some], pa.int32()), "reached": pa.array(reached[some].astype(np.int64)),
        "itself": pa.array(whole.diagonal()[some]), "first": pa.array(first[some].astype(np.int64))}))
    rows = placed.join(F.broadcast(settled), "cell")
    count = F.col("reached") - F.when(F.col("itself"), F.col("n")).otherwise(0)
    none = F.lit(None).cast("long")
    found = found.unionByName(rows.select(F.col("cls").alias("a"), none.alias("b"), count.alias("n")).where("n > 0"))
    found = found.unionByName(rows.where("cls <> first").select(F.col("cls").alias("a"), F.col("first").alias("b"), none.alias("n")))
    i, j = np.nonzero(np.triu(whole, 1))
    edges = spark.createDataFrame(pa.table({"a": pa.array(first[i].astype(np.int64)), "b": pa.array(first[j].astype(np.int64))}))
    return found.unionByName(edges.select("a", "b", none.alias("n")))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = LEAST,
                 sample: int = SAMPLE, most_cells: int = MOST_CELLS, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector; see the module's text."""
    vec = F.col("vec")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.coalesce((F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))
    given = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).withColumn("ok", valid)
    # zeros of either sign are one value, as the comparison of keys has it
    good = given.where("ok").select("id", F.transform("vec", lambda x: x + F.lit(0).cast("float")).alias("vec"))
    classes = checkpointed(good.groupBy("vec").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).withColumn(
        "cls", F.monotonically_increasing_id()))
    found = None
    for size in sorted(r[0] for r in classes.select(F.size("vec")).distinct().collect()):  # usually one length
        part = _links_of(classes.where(F.size("vec") == size), least, sample, most_cells, block)
        found = part if found is None else found.unionByName(part)
    out = given.where("NOT ok").select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                                       F.col("id").alias("component_id"))
    if found is not None:
        found = checkpointed(found)
        reached = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("reached"))
        group = components(found.where("b IS NOT NULL"))
        each = classes.join(reached.withColumnRenamed("a", "cls"), "cls", "left").join(
            group.withColumnRenamed("node", "cls"), "cls", "left")
        each = each.select("vec", "first_id", F.coalesce("root", "cls").alias("root"),
                           (F.col("n") - 1 + F.coalesce("reached", F.lit(0))).alias("n_links"))
        first = each.groupBy("root").agg(F.min("first_id").alias("component_id"))
        each = each.join(first, "root").select("vec", "n_links", "component_id")
        out = out.unionByName(good.join(each, "vec").select(F.col("id").alias(id_col), "n_links", "component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def oracle_sql(least: float = LEAST) -> str:
    """The same rows in DuckDB SQL, by comparing every vector with every other."""
    return f"""
WITH RECURSIVE vectors AS (SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    good AS MATERIALIZED (SELECT k, vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM vectors
        WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
    links AS MATERIALIZED (SELECT a.k AS a, b.k AS b FROM good a JOIN good b ON a.k <> b.k AND len(a.e) = len(b.e)
        AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {least}),
    reach AS (SELECT k, k AS r FROM good UNION SELECT reach.k, b FROM reach JOIN links ON a = r),
    first AS (SELECT reach.k AS k, min(vec_id) AS component_id FROM reach JOIN good ON good.k = r GROUP BY reach.k),
    n AS (SELECT a AS k, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id,
    vec_id IS NOT DISTINCT FROM coalesce(component_id, vec_id) AS kept
FROM vectors LEFT JOIN first USING (k) LEFT JOIN n USING (k)"""
