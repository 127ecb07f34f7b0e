"""Operator 10 against all pairs."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import numpy as np
import pytest

from storepulse.llm import cover_tree, queries
from storepulse.llm.frames import ship


def all_pairs(rows):
    """(id, n_links, component_id, kept) of every row, by comparing each with each."""
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    up = list(range(len(rows)))
    links = [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    units = [np.array(v, np.float64) / np.abs(v).max() if o else None for o, (_, v) in zip(ok, rows)]
    units = [u / np.sqrt(u @ u) if u is not None else None for u in units]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    ids = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            ids[root(i)] = min(k, ids.get(root(i), k))
    return Counter((k, links[i], ids.get(root(i)), k == ids.get(root(i))) for i, (k, _) in enumerate(rows))


def clustered(rng, n, dim, noise):
    heads = rng.normal(size=(max(1, n // 8), dim))
    return [(heads[rng.integers(len(heads))] + rng.normal(size=dim) * rng.choice(noise)).tolist() for _ in range(n)]


@pytest.mark.parametrize("dim,block,cells", [(2, 50, 8), (8, 64, 256), (32, 4096, 256)])
def test_links_match_all_pairs(spark, dim, block, cells, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(dim)
    values = clustered(rng, 500, dim, [0, 0.05, 0.2, 0.5])
    values = [np.float32(v).tolist() for v in values]
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1),
           [1.0] * (dim + 1), [2.0] * (dim + 1), [-0.0] * (dim - 1) + [1.0], [0.0] * (dim - 1) + [1.0], [3e38] * dim, [1e-30] * dim]
    rows = [(3 * i + 5, v) for i, v in enumerate([*values, *odd, *[values[0]] * 40])] + [(None, values[1]), (5, values[2]), (2, values[3])]
    docs = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id long, embedding array<float>, n_links string").repartition(3)
    got = Counter(tuple(r) for r in cover_tree.near_vectors(docs, block=block, most_cells=cells, sample=100).collect())
    assert got == all_pairs(rows)


def test_tree_covers_and_halves():
    rng = np.random.default_rng(1)
    x = cover_tree.unit(clustered(rng, 3000, 3, [0.01, 0.1]))
    tree = cover_tree.Tree(x)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    todo, n = [tree.root], 0
    while todo:
        node = todo.pop()
        assert cover_tree.apart(tree.x[node.lo:node.hi] @ node.centre).max() <= node.radius + 1e-7
        n += 1
        todo += node.children
    assert n > 20
    leaves = [(p, q) for p, q, whole in cover_tree.dual_pairs(tree, tree, 0.1) if not whole]
    compared = sum((p.hi - p.lo) * (q.hi - q.lo) for p, q in leaves)
    assert compared < 0.5 * len(x) ** 2  # clustered data are pruned


def hot_clusters(rng, n, dim):
    """Unit vectors: a third in one tight cluster, a third in ten, the rest in looser ones around many heads."""
    heads = cover_tree.unit(rng.normal(size=(200, dim)))
    head = np.r_[np.zeros(n // 3, int), rng.integers(1, 11, n // 3), rng.integers(11, 200, n - 2 * (n // 3))]
    noise = np.r_[np.full(n // 3, 0.01), np.full(n // 3, 0.02), np.full(n - 2 * (n // 3), 0.25)] / np.sqrt(dim)
    return cover_tree.unit(heads[head] + noise[:, None] * rng.normal(size=(n, dim)))


def components_of(near, ids):
    """Smallest id reachable from each, by passing on the neighbours' until nothing changes."""
    first = ids.copy()
    while True:
        least = np.minimum(first, np.where(near, first[None, :], 10**9).min(1))
        if (least == first).all():
            return first
        first = least


def test_bounds_settle_most_pairs():
    rng = np.random.default_rng(5)
    x = hot_clusters(rng, 4000, 64)
    n = rng.integers(1, 4, len(x))
    links, label, compared = cover_tree.linked_within(x, n, np.zeros(len(x), int), 0.95)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    assert (links == near @ n).all()
    assert (label == components_of(near, np.arange(len(x)))).all()
    assert compared < 0.1 * len(x) ** 2  # other pairs are dropped, or linked as a whole
    two = rng.integers(0, 2, len(x))
    links, _, compared = cover_tree.linked_within(x, n, two, 0.95)
    assert (links == (near & (two[:, None] != two[None, :])) @ n).all()
    assert compared < 0.05 * len(x) ** 2


def test_short_vectors_bound_the_cosine(monkeypatch):
    """Of directions that no bound on nodes tells apart, nearly all pairs are dropped by their leading axes."""
    rng = np.random.default_rng(7)
    x = cover_tree.unit(rng.normal(size=(1500, 64)))
    x[700:800] = cover_tree.unit(x[:100] + 0.02 * rng.normal(size=(100, 64)))
    head = cover_tree.heads(x)
    assert head.shape == (1500, cover_tree.HEAD + 1)
    assert (head @ head.T >= x @ x.T - cover_tree.HEAD_SLACK / 2).all()
    assert (head @ head.T >= 0.95).mean() < 0.01
    assert cover_tree.heads(x[:, :20]) is None
    side = (np.arange(1500) >= 750).astype(int)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    assert near[:100].any(1).sum() > 50
    n = rng.integers(1, 4, len(x))
    for which, mine in ((np.zeros(1500, int), near), (side, near & (side[:, None] != side[None, :]))):
        links, label, _ = cover_tree.linked_within(x, n, which, 0.95)
        assert (links == mine @ n).all()
        assert (label == components_of(mine, np.arange(len(x)))).all()


def test_dense_cells_split_and_settle(spark):
    ship(spark)
    rng = np.random.default_rng(6)
    x = hot_clusters(rng, 3000, 16).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000 + i, x[i].tolist()) for i in range(0, 3000, 7)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)

    classes = docs.groupBy(docs["embedding"].alias("vec")).count().selectExpr(
        "monotonically_increasing_id() AS cls", "count AS n", "vec").cache()
    cells, known = cover_tree.nested_cells(classes, sample=500, most_cells=200, block=50)
    assert len(cells.children) > 3 and len(known) <= 200  # the root and dense cells are split
    assert sum(r["n"] for r in known.values()) == 3000
    assert any(2 * r["far"] < 0.3 and r["n"] > 100 for r in known.values())  # the hot cluster is a cell that links as a whole
    flat = cover_tree.nested_cells(classes, sample=500, most_cells=200, block=3000)[1]
    assert len(flat) == 1

    got = {r["vec_id"]: tuple(r)[1:] for r in cover_tree.near_vectors(docs, sample=500, most_cells=200, block=50).collect()}
    ids = np.array([k for k, _ in rows])
    u = cover_tree.unit([v for _, v in rows])
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    first = components_of(near, ids)
    assert got == {int(k): (int(m), int(f), bool(k == f)) for k, m, f in zip(ids, near.sum(1), first)}


def test_empty_tables(spark):
    ship(spark)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.near_vectors(empty).count() == 0
    bad = spark.createDataFrame([(1, None), (1, [0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in cover_tree.near_vectors(bad).collect()] == [(1, 0, 1, True)] * 2


def test_sql_matches(spark):
    got = queries.op10_cover_tree(spark, "/root/testdata/sf0.01")
    db = duckdb.connect()
    db.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.01/embeddings.parquet')")
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['op10_cover_tree']})").fetchall()
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
