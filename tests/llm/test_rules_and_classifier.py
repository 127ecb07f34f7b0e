"""Operators 4 and 2 against plain Python, on a fixture with every odd case."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from storepulse.llm import crf_quality, quality_rules
from storepulse.llm.frames import ship

GOOD = ["The quick fox of the hill sees one more long and quiet river bend near that old stone mill today.",
        "Every morning we walk along a narrow path through fields where small birds sing about spring weather.",
        "Nobody knows how these letters came here, but their words have moved many readers over past years."]
TEXTS = [
    None, "", " \t\n ", "word", "\n".join(GOOD), "\n".join(GOOD[::-1]), "\n".join(GOOD), " ".join(GOOD) * 3,
    "BUY!! NOW!! CHEAP!! PILLS!! " * 20, "ab### cd$$$ ef%%% gh&&& ij*** " * 9, "x " * 500, "a\nb\na\n\n\nb\n a",
    "é" * 300 + " über straße " * 40, "one two three four five six seven eight " * 2 + "nine", "y" * 100_000,
    "\x1f\xa0 odd\x0bspace\x0cs", "\n".join(f"line {i} of a very long text, with words." for i in range(3000)),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("n_words", T.StringType()), T.StructField("score", T.StringType()), T.StructField("p_good", T.StringType()),
])


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, t, "mine", "mine", "mine") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, TEXTS[4], None, None, None)], SCHEMA).repartition(3)


def brute(text: str | None) -> dict:
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeated = {i + k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
            "base_failed": len(w) < 20 or 100 * len(repeated) > 30 * len(w)}


def test_counts_match_plain_python(docs):
    model = quality_rules.fit_on(docs)
    rows = quality_rules.judge(docs, model).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert {k: r[k] for k in brute(r["text"])} == brute(r["text"])
        assert 0 <= r["p_good"] <= 1 and r["kept"] == (not r["base_failed"] and r["p_good"] >= 0.5)
        assert r["score"] in ("mine", None)  # an extra column stays; one with an output's name is replaced


def plain_votes(text: str | None) -> list[int]:
    """The ten rules as the README of a data set would state them, with thresholds of their own."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return [0] * 10
    base = brute(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    letters = sum(c.isascii() and c.isalpha() or not c.isascii() for c in text)

    def below(part: int, whole: int, good: float, bad: float) -> int:
        x = part / max(whole, 1)
        return 1 if x < good else -1 if x > bad else 0

    def above(x: float, good: float, bad: float) -> int:
        return 1 if x > good else -1 if x < bad else 0

    length = sum(map(len, w)) / len(w)
    return [
        below(base["n_repeat_words"], len(w), 0.05, 0.3),
        below(base["n_symbols"], len(w), 0.02, 0.1),
        below(sum(x[-1] in "#*$%&|<>!" for x in w), len(w), 0.02, 0.1),
        below(sum("A" <= c <= "Z" for c in text), letters, 0.1, 0.3),
        below(base["n_dup_lines"], len(lines), 0.05, 0.3),
        below(sum(a == b for a, b in zip(w, w[1:])), len(w), 0.02, 0.1),
        below(sum("0" <= c <= "9" for c in text), sum(map(len, w)), 0.05, 0.15),
        above(sum(x[-1] in ".!?" for x in lines) / len(lines), 0.9, 0.5),
        above(len(set(w)) / len(w), 0.6, 0.3),
        1 if 3.5 <= length <= 6.5 else -1 if length < 3 or length > 8 else 0,
    ]


def test_votes_match_rules_written_out():
    more = ["Call 555 0199 or 555 0100 now, 24 hours.", "A A A b b c.", "One line.\nOne line.\nOther line!", "NO no No? #1 $2 ok*"]
    got = quality_rules.votes(quality_rules.counts(pa.array(TEXTS + more)))
    assert got.tolist() == [plain_votes(t) for t in TEXTS + more]
    assert all({-1, 1} <= set(got[:, k].tolist()) for k in range(10))  # every rule votes both ways here


def test_posteriors_match_bayes_rule_written_out():
    rng = np.random.default_rng(1)
    v = rng.integers(-1, 2, (400, len(quality_rules.RULES))).astype(np.int8)
    code, n = np.unique(quality_rules.pattern_code(v), return_counts=True)
    assert np.array_equal(np.unique(quality_rules.pattern_code(quality_rules.pattern_votes(code))), code)
    model = quality_rules.fit(list(zip(code.tolist(), n.tolist())), rounds=3)
    for row, p in zip(v[:50], model.posterior(v[:50])):
        both = [np.prod([model.chance[c, r, x + 1] for r, x in enumerate(row)]) * s
                for c, s in ((0, 1 - model.good), (1, model.good))]
        assert p == pytest.approx(both[1] / sum(both), rel=1e-9)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.8
    right = np.linspace(0.7, 0.95, len(quality_rules.RULES))
    v = np.where(rng.random((good.size, right.size)) < right, 1, -1) * np.where(good, 1, -1)[:, None]
    code, n = np.unique(quality_rules.pattern_code(v.astype(np.int8)), return_counts=True)
    model = quality_rules.fit(list(zip(code.tolist(), n.tolist())))
    assert model.good == pytest.approx(0.8, abs=0.02)
    assert np.allclose(model.chance[1, :, 2], right, atol=0.03)
    assert np.allclose(model.chance[0, :, 0], right, atol=0.03)


def test_keep_drops_junk_and_keeps_rows_whole(docs):
    kept = quality_rules.keep(docs)
    assert kept.schema == docs.schema
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[4] == 2 and ids[None] == 1 and ids[5] == 1
    assert not {0, 1, 2, 3, 8, 10, 13} & set(ids)


def test_empty_tables(spark, docs):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.judge(empty, quality_rules.fit_on(empty)).count() == 0
    assert quality_rules.keep(empty).count() == 0
    model = crf_quality.fit_on(empty, labels)
    assert crf_quality.with_score(empty, model).count() == 0
    assert {r["score"] for r in crf_quality.with_score(docs, model).collect()} == {0.5}


def chain_probabilities(score: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Marginals of the good label by summing over all labellings."""
    total = np.zeros((len(score), 2))
    for y in itertools.product((0, 1), repeat=len(score)):
        z = sum(score[i, k] for i, k in enumerate(y)) + sum(move[a, b] for a, b in zip(y, y[1:]))
        for i, k in enumerate(y):
            total[i, k] += np.exp(z)
    return total / total.sum(1, keepdims=True)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(3)
    size = np.array([1, 5, 2, 7, 1, 4])
    first = np.r_[0, np.cumsum(size)[:-1]]
    score, move = rng.normal(size=(size.sum(), 2)) * 2, rng.normal(size=(2, 2))
    p, moves = crf_quality.marginals(score, move, first, size)
    for k, (a, n) in enumerate(zip(first, size)):
        assert np.allclose(p[a:a + n], chain_probabilities(score[a:a + n], move))
        assert moves[k].sum() == pytest.approx(n - 1)


def test_line_features_know_their_neighbours():
    texts = pa.array(["first line.\nSECOND LINE!!\n\n \nthird line.", "alone"])
    data, at = crf_quality.blocks.__globals__["column_bytes"](texts)
    x, n, row = crf_quality.line_features(data, at)
    wide = crf_quality.with_neighbours(x, row)
    assert row.tolist() == [0, 0, 0, 1] and n.tolist() == [2, 2, 2, 1]
    own = crf_quality.OWN
    assert np.array_equal(wide[1, own:2 * own], x[0]) and np.array_equal(wide[1, 2 * own:3 * own], x[2])
    assert not wide[3, own:].any() and x[1, 3] == 1 and x[0, 3] == 0


def test_classifier_learns_held_out_rows(spark):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = crf_quality.fit_on(docs, labels.where("doc_id % 2 = 0"))
    got = crf_quality.with_score(docs, model, carry=["doc_id"]).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = [(r["score"] >= 0.3) == (r["quality"] == 1) for r in got]
    assert len(right) > 100 and sum(right) >= 0.97 * len(right)


def test_scores_of_odd_texts(docs, spark):
    labels = spark.createDataFrame([(4, 1), (5, 1), (7, 1), (8, 0), (9, 0), (None, 0), (6, None), (4, 1)],
                                   "doc_id long, quality int")
    model = crf_quality.fit_on(docs, labels)
    rows = crf_quality.with_score(docs, model).collect()
    assert len(rows) == len(TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[0] == by_id[1] == by_id[2] == model.good
    assert by_id[4] == by_id[None] and by_id[4] > 0.5 > by_id[8]


def log_likelihood(params: np.ndarray, x: np.ndarray, size: np.ndarray, labels: np.ndarray, by_class: np.ndarray) -> float:
    """Weighted log probability that all lines of each chain have its label, by summing over all labellings."""
    move, total, lo = params[crf_quality.WIDE:].reshape(2, 2), 0.0, 0
    for n, label in zip(size, labels):
        z = x[lo:lo + n] @ params[:crf_quality.WIDE]
        value = lambda y: sum(z[i] for i, k in enumerate(y) if k) + sum(move[a, b] for a, b in zip(y, y[1:]))
        every = np.logaddexp.reduce([value(y) for y in itertools.product((0, 1), repeat=int(n))])
        total += by_class[label] / n * (value((label,) * n) - every)
        lo += n
    return total


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(5)
    size, labels = np.array([1, 4, 3, 6, 2]), np.array([1, 0, 1, 1, 0])
    x = rng.normal(size=(size.sum(), crf_quality.WIDE)) * 0.5
    params, by_class = rng.normal(size=crf_quality.WIDE + 4) * 0.5, np.array([0.3, 0.2])
    given = (x, size, labels, by_class)
    step = 1e-4 * np.eye(params.size)
    want = [(log_likelihood(params + d, *given) - log_likelihood(params - d, *given)) / 2e-4 for d in step]
    assert np.allclose(crf_quality.gradient(params, *given), want, atol=1e-5)


@pytest.mark.parametrize("segment", [1, 2, 3])
def test_segments_of_long_chains_are_joined(monkeypatch, segment):
    rng = np.random.default_rng(4)
    size = np.array([1, 9, 2, 7, 3, 4, 6])
    first = np.cumsum(size) - size
    score, move = rng.normal(size=(size.sum(), 2)) * 3, rng.normal(size=(2, 2)) * 2
    whole, counts = crf_quality.marginals(score, move, first, size)
    monkeypatch.setattr(crf_quality, "SEGMENT", segment)
    p, moves = crf_quality.marginals(score, move, first, size)
    for a, n in zip(first, size):
        assert np.allclose(p[a:a + n], chain_probabilities(score[a:a + n], move))
    assert np.allclose(p, whole) and np.allclose(moves, counts)


def test_all_lines_of_sampled_documents_are_learned_from(docs, spark):
    labels = spark.createDataFrame([(16, 1), (8, 0)], "doc_id long, quality int")
    rows = crf_quality.training_chains(docs, labels).collect()
    size = {r["label"]: len(r["features"]) // (4 * crf_quality.OWN) for r in rows}
    assert size == {1: 3000, 0: 1}


def test_junk_after_a_clean_head_is_learned(spark):
    """The documents' first 70 lines are alike; only what follows tells good from bad."""
    ship(spark)
    head = [GOOD[k % 3] for k in range(70)]
    junk = ["BUY!! NOW!! CHEAP!! PILLS!!", "ab### cd$$$ ef%%% gh&&& ij***"]
    text = {y: "\n".join(head + [(GOOD if y else junk)[k % (3 if y else 2)] for k in range(700)]) for y in (0, 1)}
    docs = spark.createDataFrame([(i, text[i % 2]) for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    model = crf_quality.fit_on(docs, labels)
    score = {r["doc_id"]: r["score"] for r in crf_quality.with_score(docs, model).collect()}
    assert all((score[i] > 0.5) == (i % 2 == 1) for i in range(20))


def test_tasks_learn_what_the_driver_does(docs, spark):
    labels = spark.createDataFrame([(4, 1), (5, 1), (7, 1), (16, 1), (8, 0), (9, 0), (13, 0)], "doc_id long, quality int")
    one = crf_quality.fit_on(docs, labels)
    many = crf_quality.fit_on(docs, labels, driver_lines=1000)
    assert np.allclose(one.weights, many.weights, atol=1e-4) and np.allclose(one.move, many.move, atol=1e-4)
    assert one.good == many.good
