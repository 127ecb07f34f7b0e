"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing (operator 6).

Fingerprint: each 3-word shingle of the lower-cased text (A-Z only) is hashed
by XXH64 with seed 42; a bit is 1 if it is set in over half of the hashes.

Search: bit i has a nonzero vector m(i) of RADIUS + 1 bits.  For each nonzero
vector v there is a table whose mask keeps the bits with odd <m(i), v>.  At
most RADIUS differing bits have vectors that leave some v orthogonal to all of
them, and the table of that v masks them out: every pair within the radius
falls into one bucket of some table.  No pair is missed, by construction.

Equal fingerprints are one row here, so groups of copies cost nothing.  A
bucket of over ``HOT`` different fingerprints is covered once more by the same
construction over the bits its mask leaves free; fingerprints of one such
sub-bucket differ in at most 16 bits, which bounds it by 2**16 rows.  A task
compares the rows of a bucket and emits only edges from each row to the first
row that links reach from it, never all pairs.  ``components`` joins these.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; texts of fewer words than a shingle hash their whole word
sequence; repeated rows each get their row; null ids are never a component's
smallest id unless all its ids are null (then it is null); an empty table
gives an empty result; extra columns are left out (``keep`` carries them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import Forest, components
from .frames import checkpointed, map_arrow
from .textbytes import LOWER, blocks, words

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
HOT = 1024
BLOCK = 1 << 20  # bytes of text at a time: each shingle takes 64 bytes for its bits


def fingerprints(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text, as uint64."""
    out = np.zeros(len(column), np.uint64)
    hashed = xxhash.xxh64_intdigest
    for lo, hi, data, at in blocks(column, BLOCK):
        data = LOWER[data]
        start, end, row = words(data, at)
        if not start.size:
            continue
        # the words of the block, one space after each
        size = end - start + 1
        new_end = np.cumsum(size)
        new_start = new_end - size
        source = np.arange(new_end[-1]) + np.repeat(start - new_start, size)
        joined = np.append(data, np.uint8(32))[source]
        joined[new_end - 1] = 32
        text = joined.tobytes()
        new_end = new_end - 1
        n = np.bincount(row, minlength=hi - lo)
        last = np.repeat(np.cumsum(n) - 1, n)  # last word of the row
        first = last - np.repeat(n, n) + 1
        i = np.arange(start.size)
        begins = (i + shingle - 1 <= last) | (i == first)  # a short row has one, of all its words
        i = i[begins]
        until = new_end[np.minimum(i + shingle - 1, last[i])]
        h = np.fromiter((hashed(text[s:e], SEED) for s, e in zip(new_start[i].tolist(), until.tolist())),
                        np.uint64, i.size)
        rows = row[i]
        edge = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        count = np.add.reduceat(bits, edge, axis=0, dtype=np.int32)
        of = np.diff(np.r_[edge, rows.size])
        out[lo + rows[edge]] = np.packbits(2 * count > of[:, None], axis=1).view(">u8").ravel()
    return out


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over bit ``positions``; any ``radius`` of them are left out by some mask."""
    vectors = {p: 1 + j % (2 ** (radius + 1) - 1) for j, p in enumerate(positions)}
    return [sum(1 << p for p, m in vectors.items() if (m & v).bit_count() % 2)
            for v in range(1, 2 ** (radius + 1))]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _masks(rows: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)).cast("long") for m in rows])


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of each document as a signed long."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = fingerprints(batch.column(1), shingle).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["id", "fp"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    return map_arrow(given, one, T.StructType([given.schema["id"], T.StructField("fp", T.LongType())]))


def spanning_links(key: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the components of the links between rows of the same ``key`` (equal keys stand together).

    Each row that links reach from an earlier row gets one edge, to the first such row.
    """
    n = key.size
    run = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[run, n])
    ahead = np.repeat(run + size, size) - np.arange(n) - 1  # rows of the run after this one
    forest, i, d = Forest(n), np.flatnonzero(ahead > 0), 1
    while i.size:
        j = i + d
        apart = forest.label[i] != forest.label[j]
        near = np.bitwise_count(fp[i[apart]] ^ fp[j[apart]]) <= radius
        if near.any():
            forest.join(i[apart][near], j[apart][near])
        d += 1
        i = i[ahead[i] >= d]
    linked = np.flatnonzero(forest.label != np.arange(n))
    return fp[linked], fp[forest.label[linked]]


def links(distinct: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """(a, b) edges whose components are those of all pairs of different fingerprints within ``radius``."""
    tables = covering_masks(list(range(BITS)), radius)
    free = [[p for p in range(BITS) if not m >> p & 1] for m in tables]
    finer = [covering_masks(p, radius) for p in free]
    fp = F.col("fp")
    keys = distinct.select("fp", F.posexplode(_masks(tables)).alias("table", "mask")).select(
        "fp", "table", fp.bitwiseAND(F.col("mask")).alias("key"))
    shared = keys.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = keys.join(shared, ["table", "key"])
    sub = F.when(F.col("n") > hot, F.element_at(F.array(*[_masks(m) for m in finer]), F.col("table") + 1))
    members = members.select("fp", "table", "key", F.posexplode(F.coalesce(sub, _masks([0]))).alias("sub", "mask")).select(
        "fp", F.xxhash64("table", "key", "sub", fp.bitwiseAND(F.col("mask"))).alias("bucket"))
    members = members.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def found(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            if key.size:
                a, b = spanning_links(key, fp.view(np.uint64), radius)
                if a.size:
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([rest_key, batch.column(1).to_numpy()])
            fp = np.concatenate([rest_fp, batch.column(0).to_numpy()])
            whole = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
            yield from found(key[:whole], fp[:whole])
            rest_key, rest_fp = key[whole:], fp[whole:]
        yield from found(rest_key, rest_fp)

    return members.mapInArrow(run, "a long, b long")


def linked(found: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """(fp, root, component_id) of each different fingerprint of ``found`` (id, fp).

    ``root``: smallest fingerprint of the component; ``component_id``: smallest id in it.
    """
    distinct = found.groupBy("fp").agg(F.min("id").alias("first_id"))
    group = components(links(distinct.select("fp"), radius, hot))
    rooted = distinct.join(group.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id) of every document."""
    found = checkpointed(with_fingerprint(docs, id_col, text, shingle))
    return found.join(linked(found, radius), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
         radius: int = RADIUS) -> DataFrame:
    """One document of each component, that of the smallest id (and fingerprint), with its own columns.

    Of rows that repeat this id and fingerprint, one stays.
    """
    found = checkpointed(with_fingerprint(docs, id_col, text, shingle))
    group = linked(found, radius).select("fp", "root")
    first = found.join(group, "fp").groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "fp")).alias("x"))
    first = first.select(F.col("x.id").alias("first_id"), F.col("x.fp").alias("first_fp"))
    # the document as one struct, so that its columns can have any names
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = fingerprints(batch.column(2), shingle).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fp)], ["row", "id", "fp"])

    own = map_arrow(rows, one, T.StructType([rows.schema["row"], rows.schema["id"], T.StructField("fp", T.LongType())]))
    kept = own.join(first, (F.col("fp") == F.col("first_fp")) & F.col("id").eqNullSafe(F.col("first_id")))
    number = F.row_number().over(Window.partitionBy("fp", "id").orderBy(F.lit(0)))
    return kept.select("row", number.alias("number")).where("number = 1").select("row.*")
