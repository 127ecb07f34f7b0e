"""The pipeline against its stages done one by one in plain Python."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from storepulse.llm import crf_quality, quality_rules, queries
from storepulse.llm.frames import ship
from test_simhash_and_packing import fingerprint, smallest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_match_plain_python(spark, docs):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts = pa.array(list(rows.values()), pa.string())
    counts = quality_rules.counts(texts)
    code, n = np.unique(quality_rules.pattern_code(quality_rules.votes(counts)), return_counts=True)
    model = quality_rules.fit(list(zip(code.tolist(), n.tolist())))
    good = ~quality_rules.base_failed(counts) & (model.posterior(quality_rules.votes(counts)) >= 0.5)
    kept = {i: t for (i, t), g in zip(rows.items(), good) if g}
    stage = corpus_pipeline.quality_rules_stage(spark, docs, SF)
    assert {r["doc_id"] for r in stage.collect()} == set(kept)

    crf = queries.quality_model(docs, spark, SF)
    assert crf.weights is not None
    kept = {i: t for i, t in kept.items() if crf.score(pa.array([t]))[0] >= queries.LEAST_QUALITY}
    stage = corpus_pipeline.quality_classifier_stage(spark, stage, SF)
    assert {r["doc_id"] for r in stage.collect()} == set(kept)

    fps = {i: fingerprint(t) for i, t in kept.items()}
    near = [(i, j) for i, j in itertools.combinations(fps, 2) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = smallest(fps, near)
    kept = {i: t for i, t in kept.items() if root[i] == i}
    stage = corpus_pipeline.near_dedup_stage(spark, stage, SF)
    assert sorted(r["doc_id"] for r in stage.collect()) == sorted(kept)
    assert stage.columns == docs.columns

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    length = defaultdict(int)
    for r in corpus_pipeline.run(spark, SF).collect():
        length[r["doc_id"]] += r["length"]
    assert length == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in kept.items()}


def test_clean_documents_stay(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}
    stage = corpus_pipeline.quality_classifier_stage(spark, corpus_pipeline.quality_rules_stage(spark, docs, SF), SF)
    kept = {r["doc_id"] for r in stage.collect()}
    clean = [i for i, q in labels.items() if q == 1 and words[i] >= 20]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_classifier_acts_on_what_the_rules_keep(spark, tmp_path):
    """Documents of short, unended lines: no rule alone can name them, their lines do."""
    ship(spark)
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(3, 7))) for _ in range(3000)]

    def line(n, ended):
        words = " ".join(rng.choice(vocabulary) for _ in range(n))
        return f"{words.capitalize()}." if ended else words

    rows = [(i, "\n".join(line(12, True) for _ in range(12)) if i % 3 else "\n".join(line(3, k % 4 > 0) for k in range(40)))
            for i in range(150)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").schema
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(150)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ruled = corpus_pipeline.quality_rules_stage(spark, docs, str(tmp_path))
    assert ruled.count() == 150
    kept = corpus_pipeline.quality_classifier_stage(spark, ruled, str(tmp_path)).collect()
    assert {r["doc_id"] for r in kept} == {i for i in range(150) if i % 3}


def test_stages_take_odd_rows(spark, docs):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, "x", None, -1)], docs.schema)
    some = odd.unionByName(docs.limit(30)).unionByName(docs.limit(30))
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        out = stage(spark, some, SF)
        assert out.count() > 0
        if name != "packing":
            assert out.columns == docs.columns


def test_keep_stages_leave_clashing_columns_alone(spark, docs):
    """Columns called as helpers might be come through with their values."""
    names = ["__text", "__own", "__id", "__fp", "__n", "row", "id", "fp", "number", "first_id", "first_fp", "text_of_row", "_text_of_row", "score", "kept"]
    some = docs.limit(60)
    more = some.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:3]:
        out, plain = stage(spark, more, SF), stage(spark, some, SF)
        assert out.columns == more.columns
        rows = out.collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain.collect()) and rows, name
        assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op") and k[2].isdigit()}
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "simhash_near_dedup", "packing"]
