"""Operator 13 against all distances."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from storepulse.llm import kmeans_tree, queries
from storepulse.llm.frames import ship


def usable(rows):
    return [(i, np.array(v, np.float64)) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]


def exact(rows, every, k=10):
    """{(query, rank): (id, distance)} with all candidates."""
    rows, out = usable(rows), {}
    for q, v in {(i, tuple(v)): (i, v) for i, v in rows if i is not None and i % every == 0}.values():
        far = sorted((math.sqrt(np.square(v - w).sum()), i is None, i) for i, w in rows if i != q and len(w) == len(v))
        out |= {(q, r): (i, d) for r, (d, _, i) in enumerate(far[:k], 1)}
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", 2.0, 1) for i, v in rows], "vec_id long, embedding array<float>, leaf string, score double, rank int").repartition(parts)


def as_dict(out):
    got = out.collect()
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got}
    assert len(found) == len(got)
    return found


def data(rng, n, dim, near=0.3):
    heads = rng.normal(size=(max(1, n // 20), dim))
    return np.float32(heads[rng.integers(len(heads), size=n)] + near * rng.normal(size=(n, dim))).tolist()


def all_visits(monkeypatch):
    real = kmeans_tree.build

    def build(*a, **how):
        index = real(*a, **how)
        index.visits = index.tree.leaves
        return index

    monkeypatch.setattr(kmeans_tree, "build", build)


@pytest.mark.parametrize("dim,leaf_rows,block,chunk", [(3, 20, 8192, 1024), (16, 60, 17, 5)])
def test_all_leaves_are_exact(spark, monkeypatch, dim, leaf_rows, block, chunk):
    """With every leaf visited all rows are compared: odd vectors, ties, hot vectors, ids that repeat or are null."""
    ship(spark)
    all_visits(monkeypatch)
    rng = np.random.default_rng(dim)
    rows = list(enumerate(data(rng, 300, dim)))
    hot = rows[10][1]
    rows += [(1000 + i, hot) for i in range(150)] + [(None, hot), (None, rows[3][1]), (20, rows[4][1]), (30, rows[30][1])]
    rows += [(900, None), (910, []), (920, [0.0] * dim), (930, [float("nan")] * dim), (940, [float("inf")] + [1.0] * (dim - 1)),
             (950, [None] + [1.0] * (dim - 1)), (960, [1.0] * (dim + 1)), (970, [2.0] * (dim + 1)), (980, [float(np.float32(3e38))] * dim), (985, [-0.0] * (dim - 1) + [1.0]),
             (990, [0.0] * (dim - 1) + [1.0]), (2 ** 60, rows[7][1])]
    out = kmeans_tree.neighbours(frame(spark, rows), F.col("vec_id") % 10 == 0, block=block, chunk=chunk, leaf_rows=leaf_rows, sample=200)
    got, want = as_dict(out.where("query_id <> 20")), {k: v for k, v in exact(rows, 10).items() if k[0] != 20}  # 20 is two queries
    assert got.keys() == want.keys()
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    for k in got:
        assert got[k][1] == pytest.approx(want[k][1], rel=1e-14)
    assert out.where("query_id = 20").count() == 20


def test_few_rows(spark):
    ship(spark)
    everything = F.lit(True)
    assert as_dict(kmeans_tree.neighbours(frame(spark, []), everything)) == {}
    assert as_dict(kmeans_tree.neighbours(frame(spark, [(1, None), (2, [0.0])]), everything)) == {}
    assert as_dict(kmeans_tree.neighbours(frame(spark, [(1, [2.0])]), everything)) == {}
    rows = [(1, [2.0]), (2, [3.0]), (3, [3.0]), (None, [3.0])]
    assert as_dict(kmeans_tree.neighbours(frame(spark, rows), everything)) == {k: v for k, v in exact(rows, 1).items()}
    assert as_dict(kmeans_tree.neighbours(frame(spark, rows), F.lit(False))) == {}


def test_best_bins_are_in_order_of_a_queue():
    """Leaves come by the farthest centre on their way, and no leaf twice."""
    rng = np.random.default_rng(1)
    x = np.array(data(rng, 400, 5))
    tree = kmeans_tree.Tree(x, 40)
    way = {}

    def walk(node, far, path):
        worst = max(path, far[node])
        if tree.leaf[node] >= 0:
            way[tree.leaf[node]] = worst
        for kid in tree.children[node]:
            walk(kid, far, worst)

    for q, seen in zip(x[:20], tree.best_bins(x[:20], tree.leaves)):
        walk(0, kmeans_tree.squared(q[None], tree.centres)[0], 0)
        assert sorted(seen) == list(range(tree.leaves))
        assert [way[s] for s in seen] == sorted(way.values())
    assert list(tree.best_bins(x[:20], 3)) == [s[:3] for s in tree.best_bins(x[:20], tree.leaves)]
    assert set(tree.place(x)) <= set(range(tree.leaves))


def recall(got, want):
    return len({(q, v[0]) for (q, _), v in got.items()} & {(q, v[0]) for (q, _), v in want.items()}) / len(want)


def test_calibrated_visits(spark):
    """Where vectors cluster, few leaves reach the recall."""
    ship(spark)
    rng = np.random.default_rng(3)
    rows = list(enumerate(data(rng, 2000, 24, 0.05)))
    given = frame(spark, rows)
    index = kmeans_tree.build(kmeans_tree._usable(given, "vec_id", "embedding"), leaf_rows=50)
    assert sum(index.sizes.values()) == len(rows) and index.rows.count() == len(rows)
    assert index.tree.leaves >= 20 and index.visits < index.tree.leaves / 3 and index.recall >= 0.95
    got = as_dict(kmeans_tree.neighbours(given, F.col("vec_id") % 20 == 0, leaf_rows=50))
    assert recall(got, exact(rows, 20)) >= 0.9


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = as_dict(queries.op13_kmeans_tree(spark, "/root/testdata/sf0.1")), exact(rows, 100)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.9
    vec = dict(usable(rows))
    for (q, r), (i, far) in got.items():
        assert i != q and far == pytest.approx(math.sqrt(np.square(vec[q] - vec[i]).sum()), rel=1e-14)
        assert r == 1 or got[q, r - 1][::-1] < (far, i)
