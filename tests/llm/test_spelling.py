"""Operator 12 against comparing words by their deletions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from storepulse.llm import queries, spelling
from storepulse.llm.frames import ship


def brute(rows, least=3):
    """{(word, form, root, n, n_near, form_n)} of (id, text) rows."""
    n = Counter()
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least}
    holes, beside = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k], w[k + 1:]].add(w)
            less = w[:k] + w[k + 1:]
            if less in n:
                beside[w].add(less)
                beside[less].add(w)
    for found in holes.values():
        for w in found:
            beside[w] |= found - {w}
    form = {}
    for w in n:
        best = min(beside[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), c, len(beside[w]), n[form[w]] if w in form else None) for w, c in n.items()}


def run(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    return [tuple(r) for r in spelling.variants(docs, **how).collect()]


def mutated(rng, word, letters):
    k = rng.randrange(len(word))
    return rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice(letters) + word[k:], word[:k] + rng.choice(letters) + word[k + 1:]])


def corpus(seed, letters, n=60, length=(5, 9)):
    rng = random.Random(seed)
    heads = ["".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(n)]
    heads += [mutated(rng, w, letters) for w in heads for _ in range(3)]
    weights = [1 / (k + 1) for k in range(len(heads))]
    rng.shuffle(heads)
    return [(i, " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(heads, weights, k=60)) + ".") for i in range(60)]


@pytest.mark.parametrize("letters,leaf,asking", [("ab", 4, 3), ("etaoinshä×÷Ä", 8192, 32768), ("enrxÿ", 16, 10)])
def test_equals_brute_force(spark, letters, leaf, asking):
    """Whole vectors over a leaf, small groups and small frontiers too."""
    ship(spark)
    rows = corpus(leaf, letters)
    got = run(spark, rows, leaf=leaf, queries=asking)
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)


def test_odd_rows(spark):
    ship(spark)
    long = "abcdefgh" * 40
    rows = [(1, None), (2, ""), (None, "castle castle Castle"), (3, "castles castles castle"), (3, "castles castles castle"), (4, "123 中文 a b"),
            (5, f"{long} {long} {long} {long}x {long}x {long}x"), (6, f"y{long} y{long} y{long}"), (7, "CASTLÉS " * 9), (8, "castlés " * 9)]
    assert set(run(spark, rows)) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "words once")]) == []


def test_chains_of_forms(spark):
    """Roots are many forms away."""
    ship(spark)
    words = ["aaaaa" + "b" * k for k in range(8)]
    rows = [(1, " ".join(" ".join([w] * (3 * 2 ** k)) for k, w in enumerate(words)))]
    got = set(run(spark, rows))
    assert got == brute(rows)
    assert {r[2] for r in got} == {words[-1]}


def test_pairs_and_search():
    """One edit in arrays equals one edit in strings; a search finds every pair with one too many and one too few."""
    rng = random.Random(4)
    letters = "aemé"
    text = list({"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(300)})
    text += ["e" * k for k in (63, 64, 65, 66, 300)] + ["e" * 64 + "a", "e" * 40 + "a" + "e" * 23]
    column = pa.array(text)
    w = spelling.Words(column)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(text)), np.arange(len(text))))
    want = {(a, b) for a in text for b in text if a != b and abs(len(a) - len(b)) < 2 and spelling.one_edit(a, b)}
    good = spelling.near(w, i, w, j)
    assert {(text[a], text[b]) for a, b in zip(i[good], j[good])} == want
    less = {a: {a[:k] + a[k + 1:] for k in range(len(a))} for a in text}
    changed = {a: {(a[:k], a[k + 1:]) for k in range(len(a))} for a in text}
    assert want == {(a, b) for a in text for b in text if a != b and (b in less[a] or a in less[b] or changed[a] & changed[b])}
    vecs = spelling.vectors(column)
    trie = spelling.Trie(vecs, 0)
    yes = np.ones(len(text), bool)
    reached = {(text[a], text[trie.order[k]]) for q, leaf in trie.search(vecs, yes, yes)
               for a, b in zip(q, leaf) for k in range(trie.start[b], trie.start[b + 1])}
    wide = vecs.astype(int)
    assert reached == {(a, b) for x, a in zip(wide, text) for y, b in zip(wide, text)
                       if np.maximum(x - y, 0).sum() <= 1 and np.maximum(y - x, 0).sum() <= 1}
    assert want <= reached


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op12_spelling(spark, "/root/testdata/sf0.001").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)
