"""Token counts of documents in flat token files without an index (operator 7).

A token file is nothing but ids, unsigned 16-bit little-endian, with an
end-of-document id after each document.  Blocks of a file are searched at once
by vector comparison; where documents begin and end across blocks follows from
a prefix scan over what each block found.

The scan has two levels.  Within a run of ``RUN`` blocks, window functions give
each block the last separator before it and the number of separators before it;
the same over the runs of a file carries these on from run to run.  So no task
sees more than ``RUN`` blocks of one file, or one row for each run of it, even
if one file holds all tokens.

Files are memory-mapped by workers and have to be on a mounted folder.

Defined results: a file's last document may lack its end (``ended`` false);
documents may be empty (two ends in a row); an empty file has no documents; an
odd number of bytes is an error.  ``write_token_files``: null text is an empty
document, strings of special tokens are plain text, repeated rows are written
one by one, an empty table writes no file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_bpe import Encoder

END = 50256  # of byte_bpe_50k
BLOCK = 1 << 20  # tokens
RUN = 256  # blocks


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, text: str = "text", end: int = END) -> DataFrame:
    """Write each partition's documents as one token file; (file, n_tokens) of those written.

    The file is written under a name of its own and renamed, so a task that runs again replaces it whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, mark = None, np.array([end], np.uint32)
        part = TaskContext.get().partitionId()
        own, n = os.path.join(folder, f".{part}-{uuid.uuid4().hex}"), 0
        out = None
        for batch in batches:
            encoder = encoder or Encoder(tokenizer, specials=False)
            out = out or open(own, "wb")
            for lo, hi, ids, edge in encoder.encoded(batch.column(0)):
                ids = np.insert(ids, edge[1:], mark)  # one after each document
                out.write(ids.astype("<u2").tobytes())
                n += ids.size
        if out:
            out.close()
            name = os.path.join(folder, f"part-{part:06d}.bin")
            os.replace(own, name)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], ["file", "n_tokens"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "file string, n_tokens long")


def file_blocks(spark: SparkSession, folder: str, block: int = BLOCK) -> DataFrame:
    """(file, n_tokens, block) of every block of the folder's token files, one partition for each block at most."""
    files = sorted((e.path, e.stat().st_size) for e in os.scandir(folder) if e.name.endswith(".bin"))
    for path, size in files:
        if size % 2:
            raise ValueError(f"{path} has an odd number of bytes")
    rows = spark.createDataFrame([(p, s // 2) for p, s in files if s], "file string, n_tokens long")
    n_blocks = sum(-(-s // 2 // block) for _, s in files)
    cut = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / block))))
    return cut.repartition(max(1, min(n_blocks, 4 * spark.sparkContext.defaultParallelism)), "file", "block")


def block_ends(blocks: DataFrame, ends: tuple[int, ...] = (END,), block: int = BLOCK) -> DataFrame:
    """(file, block, ends, ended): positions of a block's separators.

    In a file's last block, one more after the last token if that is none; then ``ended`` is false.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.memmap(row["file"], "<u2", "r")
                lo = row["block"] * block
                part = ids[lo:lo + block]
                hit = part == ends[0]
                for e in ends[1:]:
                    hit |= part == e
                at = np.flatnonzero(hit) + lo
                open_end = lo + part.size == row["n_tokens"] and not hit[-1]
                if open_end:
                    at = np.append(at, row["n_tokens"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]]), pa.array([row["block"]]), pa.array([at], pa.list_(pa.int64())), pa.array([not open_end])],
                    ["file", "block", "ends", "ended"])

    return blocks.select("file", "n_tokens", "block").mapInArrow(run, "file string, block long, ends array<long>, ended boolean")


def document_counts(found: DataFrame, run: int = RUN) -> DataFrame:
    """(file, doc, start, n_tokens, ended) of every document, from what ``block_ends`` found.

    ``doc`` counts a file's documents from 0; ``n_tokens`` is without the separator.
    """
    rows = found.withColumn("run", F.floor(F.col("block") / run)).withColumns(
        {"n": F.size("ends").cast("long"), "last": F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)})
    before = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"n_before": F.sum("n").over(before), "last_before": F.max("last").over(before)})
    runs = rows.groupBy("file", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    before = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("file", "run", F.sum("n").over(before).alias("run_n"), F.max("last").over(before).alias("run_last"))
    zero, none = F.lit(0).cast("long"), F.lit(-1).cast("long")
    rows = rows.join(runs, ["file", "run"]).select(
        "file", "ends", "ended", (F.coalesce("n_before", zero) + F.coalesce("run_n", zero)).alias("first"),
        F.coalesce("last_before", "run_last", none).alias("previous"))
    each = rows.select("file", "ended", "first", "previous", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("previous")).otherwise(F.get("ends", F.col("k") - 1)) + 1
    return each.select("file", (F.col("first") + F.col("k")).alias("doc"), start.alias("start"), (F.col("end") - start).alias("n_tokens"),
                       (F.col("ended") | (F.col("k") < F.size("ends") - 1)).alias("ended"))


def count_tokens(spark: SparkSession, folder: str, ends: tuple[int, ...] = (END,), block: int = BLOCK, run: int = RUN) -> DataFrame:
    """Token counts of all documents of the folder's token files."""
    return document_counts(block_ends(file_blocks(spark, folder, block), ends, block), run)
