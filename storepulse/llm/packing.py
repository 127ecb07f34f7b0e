"""Sum-of-squares online packing of documents into training sequences (operator 1).

Each task packs the documents of its partition in the order it reads them.  A
document's full windows become sequences of their own; its remainder goes to
the fill level where the sum over levels of (number of partly filled windows
there) ** 2 grows least.  The counts stand in a level array, so a placement is
one vector operation over the levels, whatever the number of open windows.

A task keeps at most ``max_open`` partly filled windows.  When it has more, or
no more documents, it closes them: documents of the emptiest windows are cut to
fill the gaps of the fullest ones, and what is left of the last window is cut
into sequences whose lengths are powers of two, which need no padding.  So
no sequence is padded at all, and only documents of windows that were still
open at that point are cut.

Sequence ids hold the task's partition in the upper bits and a count below, so
tasks need not agree on anything.  A task that runs again replaces all of its
rows.  Nothing is shuffled.

Defined results: null and empty texts are one token, the separator; repeated
rows are packed one by one; null ids stay null; an empty table gives an empty
result.  Extra columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import Encoder

WINDOW = 2048
SEPARATOR = 1
MAX_OPEN = 4096  # windows; their ids take 4 * WINDOW bytes each at most
PARTITION_BITS = 36  # sequences of one task: fewer than 2 ** 36


class Packer:
    """Packs pieces (document, start, ids as bytes) into windows; see the module's text."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)  # open windows by fill level
        self.open: dict[int, list[list]] = {}  # by fill level, windows as lists of pieces
        self.n_open = 0
        self.done: list[list] = []  # finished sequences, lists of pieces

    def add(self, doc: int, ids: bytes) -> None:
        size, step = len(ids) // 4, self.window
        at = 0
        while size - at >= step:
            self.done.append([(doc, at, ids[4 * at:4 * (at + step)])])
            at += step
        if at < size:
            self.place((doc, at, ids[4 * at:]))
        if self.n_open > self.max_open:
            self.close(self.max_open // 2)

    def place(self, piece: tuple) -> None:
        """Put a piece shorter than a window where the sum of squares grows least; ties go to the fullest."""
        size, n = len(piece[2]) // 4, self.levels
        reach = self.window - size
        # moving a window from level h to h + size changes the sum by 2 * (n[h + size] - n[h]) + 2; a new
        # window by 2 * n[size] + 1; a filled one leaves the sum by 2 * n[h] - 1
        growth = np.where(n[1:reach + 1] > 0, 2 * (n[size + 1:] - n[1:reach + 1]) + 2, np.iinfo(np.int64).max)
        growth[-1:] = -2 * n[reach] + 1 if n[reach] else np.iinfo(np.int64).max
        level = 0
        if growth.size:
            best = growth.size - 1 - int(np.argmin(growth[::-1]))
            if growth[best] <= 2 * n[size] + 1 and n[best + 1]:
                level = best + 1
        if level:
            pieces = self.open[level].pop()
            n[level] -= 1
            self.n_open -= 1
            pieces.append(piece)
        else:
            pieces = [piece]
        level += size
        if level == self.window:
            self.done.append(pieces)
        else:
            self.open.setdefault(level, []).append(pieces)
            n[level] += 1
            self.n_open += 1

    def close(self, leave: int = 0) -> None:
        """Close open windows, the emptiest giving their pieces to fill the fullest, until ``leave`` are left."""
        rows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        fill = [sum(len(p[2]) for p in w) // 4 for w in rows]
        a, b = 0, len(rows) - 1
        while a < b and b - a + 1 > leave:
            gap = self.window - fill[a]
            while gap and b > a:
                doc, start, ids = rows[b][-1]
                size = len(ids) // 4
                if size <= gap:
                    rows[b].pop()
                    rows[a].append((doc, start, ids))
                else:  # its end stays where it is: the cut piece keeps its order within the document
                    rows[b][-1] = (doc, start + gap, ids[4 * gap:])
                    rows[a].append((doc, start, ids[:4 * gap]))
                    size = gap
                gap -= size
                fill[a] += size
                fill[b] -= size
                if not fill[b]:
                    b -= 1
            if not gap:
                self.done.append(rows[a])
                a += 1
        rows, fill = rows[a:b + 1], fill[a:b + 1]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        if not leave:
            for w in rows:
                self.done += binary_cuts(w)
            return
        for w, level in zip(rows, fill):
            self.open.setdefault(level, []).append(w)
            self.levels[level] += 1
            self.n_open += 1


def binary_cuts(pieces: list[tuple]) -> list[list[tuple]]:
    """A window's pieces as sequences whose lengths are different powers of two."""
    left = sum(len(p[2]) for p in pieces) // 4
    out, queue = [], list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        row = []
        while room:
            doc, start, ids = queue.pop(0)
            size = len(ids) // 4
            if size > room:
                queue.insert(0, (doc, start + room, ids[4 * room:]))
                ids, size = ids[:4 * room], room
            row.append((doc, start, ids))
            room -= size
        out.append(row)
    return out


PIECE = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
         max_open: int = MAX_OPEN, with_ids: bool = False) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    ``tokenizer``: path of a byte-level BPE file of the tokenizers library, the
    same on every worker.  ``ids`` (with ``with_ids``): the piece's token ids as
    little-endian unsigned 32-bit numbers.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, given.schema["id"].dataType),
                           *(T.StructField(k, T.LongType()) for k in PIECE),
                           *([T.StructField("ids", T.BinaryType())] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, id_type = None, Packer(window, max_open), None
        sequence = TaskContext.get().partitionId() << PARTITION_BITS

        def finished() -> pa.RecordBatch:
            nonlocal sequence
            columns: list[list] = [[] for _ in schema]
            for pieces in packer.done:
                offset = 0
                for (name, total), start, ids in pieces:
                    size = len(ids) // 4
                    row = (name, start, size, zlib.crc32(ids), total, sequence, offset, ids)
                    for c, x in zip(columns, row):
                        c.append(x)
                    offset += size
                sequence += 1
            packer.done = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [id_type, *[pa.int64()] * len(PIECE), pa.binary()])], schema.names)

        separator = np.array([SEPARATOR], "<u4").tobytes()
        for batch in batches:
            encoder = encoder or Encoder(tokenizer)
            id_type = batch.schema.field(0).type
            names = batch.column(0).to_pylist()
            for lo, hi, ids, edge in encoder.encoded(batch.column(1)):
                raw, edge = ids.astype("<u4", copy=False).tobytes(), (4 * edge).tolist()
                for name, a, b in zip(names[lo:hi], edge, edge[1:]):
                    own = raw[a:b] + separator
                    packer.add((name, len(own) // 4), own)
                if len(packer.done) >= 2000:
                    yield finished()
        packer.close()
        if packer.done:
            yield finished()

    return given.mapInArrow(run, schema)
