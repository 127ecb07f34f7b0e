"""Operator 5 against listing every segmentation."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from storepulse.llm import queries
from storepulse.llm import segment_sampling as ss
from storepulse.llm.frames import ship

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return ss.Vocabulary(MODEL)


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def segmentations(sp, text):
    """Every segmentation of a text as ids, with its probability."""
    line = ("▁" + text.replace(" ", "▁")) if text else ""
    pieces = {sp.id_to_piece(i): i for i in range(259, sp.get_piece_size())}
    found = [[] for _ in range(len(line) + 1)]
    found[0] = [((), 0.0)]
    for i in range(len(line)):
        steps = [((pieces[line[i:j]],), j, -math.log1p(-sp.get_score(pieces[line[i:j]]))) for j in range(i + 1, min(len(line), i + 16) + 1)
                 if line[i:j] in pieces]
        if line[i] not in pieces:
            steps.append((tuple(3 + b for b in line[i].encode()), i + 1, 0.0))
        for ids, j, w in steps:
            found[j] += [(a + ids, x + w) for a, x in found[i]]
    total = np.logaddexp.reduce([w for _, w in found[-1]])
    return {a: w - total for a, w in found[-1]}


def drawn(vocabulary, keys, texts, k, **more):
    out = defaultdict(list)
    for d, j, raw, n, lp, g, inc in ss.sampled(vocabulary, keys, texts, k, **more):
        ids = tuple(np.frombuffer(raw, "<u4").tolist())
        assert j == len(out[d]) and n == len(ids)
        out[d].append((ids, lp, g, inc))
    return out


TEXTS = ["", "a", "the", "to be", "  a", "é\n!", "字𝔸", "on the", "a b c", "x\t y"]


@pytest.mark.parametrize("reach", [30.0, 0.5])
def test_samples_are_distinct_segmentations(vocabulary, sp, reach):
    got = drawn(vocabulary, range(len(TEXTS)), TEXTS, 12, reach=reach)
    for i, t in enumerate(TEXTS):
        every = segmentations(sp, t)
        rows = got[i]
        assert len(rows) == min(12, len(every)) == len({r[0] for r in rows})
        for ids, lp, g, inc in rows:
            assert lp == pytest.approx(every[ids], abs=1e-9) and inc <= 1e-12
        perturbed = [g for _, _, g, _ in rows]
        assert perturbed == sorted(perturbed, reverse=True)
        if len(every) <= 12:
            assert all(r[3] == 0 for r in rows)


@pytest.mark.parametrize("reach", [30.0, 0.7])
def test_draws_follow_sampling_without_replacement(vocabulary, sp, reach):
    """First and second draws against p(a) and p(a) p(b) / (1 - p(a)); inclusion scores give unbiased sums."""
    text, n = "to be", 6000
    every = {a: math.exp(w) for a, w in segmentations(sp, text).items()}
    got = drawn(vocabulary, range(n), [text] * n, 2, reach=reach)
    first, both = Counter(), Counter()
    for rows in got.values():
        first[rows[0][0]] += 1
        both[rows[0][0], rows[1][0]] += 1
    for a, p in every.items():
        assert first[a] / n == pytest.approx(p, abs=4.5 * math.sqrt(p / n) + 1e-3)
        for b, q in every.items():
            x = p * q / (1 - p) if a != b else 0.0
            assert both[a, b] / n == pytest.approx(x, abs=4.5 * math.sqrt(x / n) + 1e-3)
    mean = sum(sum(math.exp(lp - inc) for _, lp, _, inc in rows) for rows in got.values()) / n
    assert mean == pytest.approx(1, abs=0.05)  # probabilities over inclusion scores estimate their sum
    pieces = sum(sum(math.exp(lp - inc) * len(ids) for ids, lp, _, inc in rows) for rows in got.values()) / n
    assert pieces == pytest.approx(sum(len(a) * p for a, p in every.items()), rel=0.05)


def test_noise_belongs_to_the_row(vocabulary):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["the", "tion", "words", "été", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    together = drawn(vocabulary, range(40), texts, 3, reach=2.0)
    for i in (0, 7, 39):
        alone = drawn(vocabulary, [i], [texts[i]], 3, reach=2.0)[0]
        assert [r[0] for r in alone] == [r[0] for r in together[i]]
        assert np.allclose([r[1:] for r in alone], [r[1:] for r in together[i]], atol=1e-9)
    assert drawn(vocabulary, [5], [texts[7]], 3)[0] != together[7]


def test_round_trip(spark, sp):
    ship(spark)
    texts = [None, "", " ", "Some words, and more words.\nNew line\t tab  two", "z" * 3000, "word " * 8000, "字𝔸\x00\x7f", "same", "same"]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "null key", "x", "y"), (7, "same", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sample string, ids string").repartition(3)
    got = ss.decode(ss.sample(docs, MODEL, k=3), MODEL).collect()
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
        assert r["text"] == ("null key" if r["doc_id"] is None else texts[r["doc_id"]] or "")
        assert r["n_pieces"] == len(r["ids"])
    assert len(by_id[0]) == len(by_id[1]) == 1 and by_id[1][0]["log_p"] == 0 and by_id[1][0]["log_inclusion"] == 0
    assert len(by_id[5]) == 3 and len({tuple(r["ids"]) for r in by_id[5]}) == 3
    assert len(by_id[7]) == 6 and len({tuple(r["ids"]) for r in by_id[7]}) == 3  # a repeated row gets the same samples
    assert len(by_id[None]) == 3
    assert ss.sample(docs.limit(0), MODEL).count() == 0


def test_query_returns_ids_and_decodes_them(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op5_gumbel_segmentation(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        assert len(r["ids"]) == r["n_pieces"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        assert r["decoded_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").replace(ss.SPACE, " ").encode())


def test_decoder_gives_what_the_model_does(sp):
    rng = random.Random(5)
    rows = [[], [0], [1, 2], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9], *([rng.randrange(sp.get_piece_size()) for _ in range(rng.randint(0, 9))] for _ in range(2000))]
    opening = [i for i in range(sp.get_piece_size()) if sp.id_to_piece(i).startswith(ss.SPACE)]
    rows += [[rng.choice(opening), *r] for r in rows]
    flat, at = np.array([x for r in rows for x in r], np.int32), np.cumsum([0, *map(len, rows)])
    assert [t.decode() for t in ss.Decoder(MODEL).texts(flat, at)] == [sp.decode(r) for r in rows]
