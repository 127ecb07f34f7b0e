"""Operators 6 and 1 against plain Python."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storepulse.llm import byte_bpe, packing, simhash_dedup
from storepulse.llm.components import components
from storepulse.llm.frames import ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", "  ", "one", "One TWO", "one two three", "ÉCOLE été\x0bstraße\tfoo  bar\r\nbaz", "a " * 3000, "z" * 50_000,
       "tabs\t\tand  double   spaces \n\n new", "end<|endoftext|> of it", "nbsp  x   y", " lead", "trail "]


def fingerprint(text: str | None) -> int:
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def test_fingerprints_match(spark):
    ship(spark)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    got = {r["id"]: r["fp"] & (2 ** 64 - 1) for r in simhash_dedup.with_fingerprint(docs).collect()}
    assert got == {i: fingerprint(t) for i, t in enumerate(ODD)}


def test_every_pair_in_the_radius_meets_in_a_table():
    masks = simhash_dedup.covering_masks(list(range(64)))
    assert len(masks) == 15
    for r in (1, 2, 3):
        for bits in itertools.combinations(range(64), r):
            x = sum(1 << b for b in bits)
            assert any(x & m == 0 for m in masks)
    for m in masks:
        free = [b for b in range(64) if not m >> b & 1]
        for finer in simhash_dedup.covering_masks(free):
            assert len(free) - finer.bit_count() <= 16


@pytest.mark.parametrize("hot", [1024, 4])
def test_links_give_the_components_of_all_pairs(spark, hot):
    ship(spark)
    rng = random.Random(5)
    values = {0, 2 ** 64 - 1}
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            values.add(x)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
    near = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3]
    signed = lambda v: v - 2 ** 64 if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = simhash_dedup.links(frame, hot=hot).collect()
    want = smallest(values, near)
    have = smallest(values, [(a & (2 ** 64 - 1), b & (2 ** 64 - 1)) for a, b in got])
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in m.values()}
    assert groups(have) == groups(want)


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(200)]
    edges += [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(250)] + [(7, 7), (8000, 8000)]
    frame = spark.createDataFrame([*edges, (None, 3), edges[0]], "a long, b long")
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == smallest(nodes, [e for e in edges if e[0] != e[1]])
    assert components(frame.limit(0)).count() == 0


def test_documents(spark):
    ship(spark)
    rng = random.Random(7)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eta", "mu"]) for _ in range(120)) for _ in range(12)]
    texts = [*ODD, *base, *(b + " tail" for b in base), *base[:4], *base[:4]]
    rows = [(3 * i + 1, t, "kept", 5) for i, t in enumerate(texts)] + [(1, None, "kept", 6), (None, base[0], "kept", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp int").repartition(3)
    fps = [fingerprint(r[1]) for r in rows]
    near = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = smallest(range(len(rows)), near)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root[i]].append(r[0])
    want = Counter((r[0], f"{fps[i]:016x}", min(least[root[i]])) for i, r in enumerate(rows))
    got = Counter(tuple(r) for r in simhash_dedup.near_duplicates(docs).collect())
    assert got == want
    kept = simhash_dedup.keep(docs)
    assert kept.schema.names == docs.schema.names
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(min(v) for v in least.values())
    assert simhash_dedup.near_duplicates(docs.limit(0)).count() == simhash_dedup.keep(docs.limit(0)).count() == 0


def test_word_pieces_give_the_tokenizers_ids():
    t = Tokenizer.from_file(TOKENIZER)
    encoder = byte_bpe.Encoder(TOKENIZER)
    rng = random.Random(8)
    made = ["".join(rng.choice(["a", "é", " ", "  ", "\n", "'s", "1", "!", "\t", " ", " ", "\x1c", "字", "<|endoftext|>", "\x85", "\u3000", "×", ".", "It's", "\u2009", "²", "_"])
                    for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    texts = [x or "" for x in ODD] + made
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    for _ in range(2):  # pieces met before, and not
        for lo, hi, ids, edge in encoder.encoded(pa.array(texts)):
            assert [ids[a:b].tolist() for a, b in zip(edge, edge[1:])] == want[lo:hi]
    byte_bpe.KEPT_PIECES, kept = 50, byte_bpe.KEPT_PIECES
    assert [encoder.encode(x).tolist() for x in texts[:300]] == want[:300]
    byte_bpe.KEPT_PIECES = kept


@pytest.mark.parametrize("max_open", [4096, 6])
def test_packing(spark, max_open):
    ship(spark)
    rng = random.Random(9)
    texts = [*ODD, *(" ".join(rng.choice(["tion", "word", "über", "x"]) for _ in range(rng.randint(1, 4000))) for _ in range(150))]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(2)
    got = packing.pack(docs, TOKENIZER, max_open=max_open, with_ids=True).collect()
    t = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
    for i, text, _ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        have = sorted(by_doc[i], key=lambda r: r["start"])
        assert b"".join(r["ids"] for r in have) == np.array(ids, "<u4").tobytes()
        at = 0
        for r in have:
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0  # full, or a power of two: no padding


def test_placement_minimises_the_sum_of_squares():
    rng = random.Random(10)
    packer = packing.Packer(window=16)
    for doc in range(400):
        before, size = packer.levels.copy(), rng.randint(1, 15)
        options = {0: None} | {h: None for h in range(1, 17 - size) if before[h]}
        for h in options:
            n = before.copy()
            n[h] -= h > 0
            n[h + size] += 1
            options[h] = int((n[1:16] ** 2).sum())
        packer.place((doc, 0, bytes(4 * size)))
        assert int((packer.levels[1:16] ** 2).sum()) == min(options.values())


def test_packing_odd_tables(spark):
    ship(spark)
    docs = spark.createDataFrame([("a", "one"), ("a", "one"), (None, None)], "doc_id string, text string")
    got = packing.pack(docs.coalesce(1), TOKENIZER).collect()
    assert sorted((r["doc_id"] or "", r["length"]) for r in got) == [("", 1), ("a", 2), ("a", 2)]
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0
