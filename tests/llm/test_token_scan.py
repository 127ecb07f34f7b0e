"""Operator 7: exact round trips, and counts against plain splitting."""

from __future__ import annotations

import os
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from storepulse.llm import queries, token_scan
from storepulse.llm.frames import ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def plain(ids, ends):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x in ends:
            out.append((len(out), start, i - start, True))
            start = i + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("block,run", [(1, 2), (7, 3), (64, 2), (1 << 20, 256)])
def test_counts_match_plain_splitting(spark, tmp_path, block, run):
    ship(spark)
    rng = random.Random(block)
    files = {"a": [], "b": [9], "c": [5], "d": [5] * 6, "e": [9] * 6, "f": [1, 2, 5, 3, 9, 9, 9, 4]}
    files |= {f"g{k}": [rng.choice([5, 9] + [7] * rng.choice([1, 50])) for _ in range(rng.randint(1, 400))] for k in range(6)}
    for name, ids in files.items():
        np.array(ids, "<u2").tofile(tmp_path / f"{name}.bin")
    for ends in ((9,), (9, 5)):
        got = token_scan.count_tokens(spark, str(tmp_path), ends, block, run).collect()
        want = {(f"{tmp_path}/{name}.bin", *r) for name, ids in files.items() for r in plain(ids, ends)}
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_odd_bytes_are_an_error(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(ValueError, match="odd number"):
        token_scan.count_tokens(spark, str(tmp_path))


def test_round_trip(spark, tmp_path):
    ship(spark)
    texts = [None, "", "one", "one", "a <|endoftext|> b", "word " * 20_000, "\n\n  x", "é" * 999]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, file int").repartition(3)
    os.makedirs(tmp_path / "t")
    token_scan.write_token_files(docs, str(tmp_path / "t"), TOKENIZER).collect()
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    got = token_scan.count_tokens(spark, str(tmp_path / "t"), block=1000).collect()
    texts_back = []
    for r in got:
        ids = np.fromfile(r["file"], "<u2")[r["start"]:r["start"] + r["n_tokens"]]
        texts_back.append(t.decode(ids.tolist(), skip_special_tokens=False))
        assert r["ended"]
    assert sorted(texts_back) == sorted(x or "" for x in texts)


def test_query(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    t = Tokenizer.from_file(TOKENIZER)
    want = sorted(len(t.encode(r["text"], add_special_tokens=False).ids) for r in docs.collect())
    assert sorted(r["n_tokens"] for r in queries.op7_token_scan(spark, "/root/testdata/sf0.001").collect()) == want


def test_empty(spark, tmp_path):
    ship(spark)
    docs = spark.createDataFrame([], "text string")
    assert token_scan.write_token_files(docs, str(tmp_path), TOKENIZER).count() == 0
    assert token_scan.count_tokens(spark, str(tmp_path)).count() == 0
