"""Operator 3 against an n-gram model in plain Python dictionaries."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from storepulse.llm import frames, kneser_ney
from storepulse.llm.frames import ship

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("score", T.StringType())])


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


class Plain:
    def __init__(self, texts, order=2):
        self.order, self.count, grams = order, Counter(), Counter()
        for t in texts:
            w = split(t)
            self.count.update(w)
            padded = ["<s>"] * (order - 1) + w
            grams.update(tuple(padded[i:i + order]) for i in range(len(w)))
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.grams, self.by, self.cuts = {}, {}, {}
        for k in range(order, 0, -1):
            self.grams[k], self.by[k] = grams, defaultdict(list)
            for g, c in grams.items():
                self.by[k][g[:-1]].append(c)
            self.cuts[k] = kneser_ney.discounts([sum(c == x for c in grams.values()) for x in (1, 2, 3, 4)])
            below = Counter()
            for g, c in grams.items():
                below[g[1:]] += c if g[1:2] == ("<s>",) else 1
            grams = below

    def p(self, h, w):
        """Of a word after a tuple of words before it."""
        k = len(h) + 1
        lower = self.p(h[1:], w) if h else 1 / (self.v + 1)
        counts = self.by[k][h]
        if not counts:
            return lower
        cut, c = self.cuts[k], self.grams[k][(*h, w)]
        rest = sum(cut[min(x, 3)] for x in counts)
        return (max(c - cut[min(c, 3)], 0) + rest * lower) / sum(counts)

    def score(self, text):
        w = split(text)
        padded = ["<s>"] * (self.order - 1) + w
        return sum(math.log10(self.p(tuple(padded[i:i + self.order - 1]), x)) for i, x in enumerate(w))

    def base(self, text):
        return sum(math.log10((self.count[x] + 0.5) / (self.n + 0.5 * (self.v + 1))) for x in split(text))


def make_texts():
    rng = random.Random(4)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 200))) for _ in range(150)]
    return [None, "", " \n", "Word", "WORD word\x0bÉté été", "x" * 5000, "the " * 4000, *texts, texts[0], texts[0]]


@pytest.mark.parametrize("bucket,order", [(2_000_000, 2), (500, 2), (2_000_000, 3), (500, 3), (500, 4)])
def test_scores_match_plain_python(spark, monkeypatch, bucket, order):
    ship(spark)
    monkeypatch.setattr(kneser_ney, "BUCKET", bucket)  # the smaller one makes many buckets and hot contexts
    texts = make_texts()
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    model = kneser_ney.train(docs.where("doc_id % 5 != 1"), order=order)
    assert (model.bits > 2 and len(model.hot) > 2) == (bucket == 500)
    plain = Plain([t for i, t in enumerate(texts) if i % 5 != 1], order)
    assert (model.n, model.v, model.pairs) == (plain.n, plain.v, len(plain.grams[2]))
    rows = kneser_ney.with_score(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = split(r["text"])
        assert r["n_tokens"] == len(w) and r["n_known"] == sum(plain.count[x] > 0 for x in w) and r["train_tokens"] == plain.n
        assert r["base_score"] == pytest.approx(plain.base(r["text"]), rel=1e-9)
        assert r["score"] == pytest.approx(plain.score(r["text"]), rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(order):
    plain = Plain(make_texts(), order)
    words = [*plain.count, "never seen"]
    for h in [("<s>",) * (order - 1), *([(None,), ("the",), ("never seen",)] if order == 2 else []), *list(plain.by[order])[:20]]:
        assert sum(plain.p(h, w) for w in words) == pytest.approx(1)


def test_empty_tables(spark):
    ship(spark)
    empty = spark.createDataFrame([], SCHEMA)
    model = kneser_ney.train(empty)
    docs = spark.createDataFrame([(1, "a b", None), (2, None, None)], SCHEMA)
    rows = {r["doc_id"]: r for r in kneser_ney.with_score(docs, model).collect()}
    assert rows[1]["n_tokens"] == 3 and rows[1]["n_known"] == 0 and rows[1]["score"] == 0 and rows[1]["base_score"] == 0
    assert kneser_ney.with_score(empty, model).count() == 0
    with pytest.raises(ValueError, match="order"):
        kneser_ney.train(empty, order=1)


def test_unmounted_folder_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(frames, "ensure_checkpoint_dir", lambda s: "hdfs://host/folder")
    with pytest.raises(ValueError, match="memory-mapped"):
        frames.shared_folder(spark, "x")
