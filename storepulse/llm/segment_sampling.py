"""Distinct sampled segmentations of SentencePiece text, by Gumbel top-k search (operator 5).

The lattice of a text holds every way to cut it into vocabulary pieces; a
segmentation's probability is the product of its pieces' weights, over the sum
of all.  Weights follow the pieces' merge ranks: weight (1 + rank) ** -alpha.
Characters that no piece covers become their bytes, as the model has it.

Drawing k segmentations without replacement is taking the k largest of
log-probability plus independent Gumbel noise.  An A* search finds these without
listing segmentations.  A frontier entry is a set of segmentations with one
beginning; its bound is its largest perturbed value, drawn exactly from the set's
total probability (a Gumbel variable truncated at the bound of the set it was
split from).  The best entry is completed by drawing its largest member piece by
piece, and what departs from that path, node by node, goes back to the frontier.
The bound of the best entry left after k draws is the threshold of the inclusion
scores, 1 - exp(-exp(log p - threshold)): the chance to be drawn above it.

Departures after the path's probability has fallen by exp(-``REACH``) share one
entry, with their total probability, which is split only if its turn comes (the
chance is about 1e-8 a text): nothing is left out.

Pieces never join a character and a space after it, so the lattice of a text is
a chain of those of its words.  A task builds the lattices of different
words once, for as many blocks of texts as fit ``MOST_EDGES``, and draws for all
texts of a block in step.  All noise comes from a hash of
the row's key, the round and the place in the text: a text's samples don't
depend on how the table is partitioned (its scores do by rounding, about 1e-12).

Defined results: null counts as empty; an empty text has one segmentation, of no
pieces, with probability and inclusion 1; a text with fewer than k segmentations
gets them all (then inclusion is 1); rows with equal keys and texts get equal
samples, a null key counts as one key; an empty table gives an empty result.
The word separator itself (U+2581) in a text counts as a space.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textbytes import hashes, mixed, row_blocks

SAMPLES = 2
ALPHA = 1.0
SEED = 7
REACH = 20.0
BLOCK_CHARS = 2_000_000
MOST_EDGES = 6_000_000  # 25 bytes each
DECODE_IDS = 1 << 18
SPACE = "▁"
_B = np.uint64(0x9E3779B97F4A7C15)


def uniform(seed: np.ndarray, *place) -> np.ndarray:
    """Numbers in (0, 1) from a row's seed and a place."""
    x = seed
    for p in place:
        x = mixed(x ^ (np.atleast_1d(p).astype(np.uint64) + np.uint64(1)) * _B)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def truncated(location: np.ndarray, most: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at ``location``, given that they are below ``most``."""
    with np.errstate(over="ignore"):
        return location - np.log(np.exp(location - most) - np.log(u))


def _small(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 in 16 bits where they fit, as numpy then sorts by counting."""
    return x.astype(np.uint16) if x.size and x.max() < 1 << 16 else x


class Vocabulary:
    """Pieces by the hash of their characters, for each length, and all their beginnings."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_ids = np.zeros(256, np.int32)
        pieces = {}
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                self.byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[sp.id_to_piece(i)] = (i, -alpha * np.log1p(-sp.get_score(i)))
        self.longest = max(map(len, pieces))
        self.known = np.unique(np.array([ord(p) for p in pieces if len(p) == 1], np.uint32))
        within = set("".join(pieces))
        self.alone = np.zeros(256, bool)  # ASCII characters of no piece: words end before and after them
        self.alone[[b for b in range(128) if b != 32 and chr(b) not in within]] = True
        if any(c == SPACE and a != SPACE for p in pieces for a, c in zip(p, p[1:])):
            raise ValueError("a piece of this model has a space after another character")
        # for each length, the hashes of all pieces' beginnings, and of each its piece (-1: none), weight, and whether one goes on
        self.tables = []
        for n in range(1, self.longest + 1):
            rows: dict[int, list] = {}
            for p, (i, w) in pieces.items():
                if len(p) >= n:
                    row = rows.setdefault(self._hash(p[:n]), [-1, 0.0, False])
                    if len(p) == n:
                        row[:2] = i, w
                    else:
                        row[2] = True
            h = np.array(sorted(rows), np.uint64)
            piece, w, more = zip(*(rows[x] for x in h.tolist()))
            self.tables.append((h, np.array(piece, np.int32), np.array(w), np.array(more)))

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_B) + ord(c) + 1) & (2 ** 64 - 1)
        return h

    def edges(self, chars: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
        """(place, characters, log weight, id) of every piece from each place, by place and falling weight.

        ``left``: characters to the end of the word; ``chars`` goes on for a piece's length.
        Id -1 stands for a character's bytes.
        """
        at, h = np.arange(left.size), np.zeros(left.size, np.uint64)
        lone = np.flatnonzero(~np.isin(chars[:left.size], self.known))
        found = [(lone, np.ones(lone.size, np.int64), np.zeros(lone.size), np.full(lone.size, -1, np.int32))]
        for n, (have, piece, w, more) in enumerate(self.tables):
            h = h * _B + chars[at + n] + np.uint64(1)
            k = np.searchsorted(have, h)
            k[k == have.size] = 0
            known = np.flatnonzero(have[k] == h)
            at, h, k = at[known], h[known], k[known]
            hit = piece[k] >= 0
            found.append((at[hit], np.full(int(hit.sum()), n + 1), w[k[hit]], piece[k[hit]]))
            go = more[k] & (left[at] > n + 1)
            at, h = at[go], h[go]
        cat = [np.concatenate(x) for x in zip(*found)]
        rank = np.minimum(-cat[2] * 4096, (1 << 20) - 1).astype(np.int64)
        order = np.argsort(cat[0] << 25 | rank << 5 | np.minimum(cat[1], 31))
        return tuple(x[order] for x in cat)


class Grown:
    """An array that grows at its end."""

    def __init__(self, dtype: type):
        self.room, self.size = np.empty(1 << 12, dtype), 0

    def add(self, x: np.ndarray) -> None:
        if self.size + x.size > self.room.size:
            room = np.empty(max(2 * self.room.size, self.size + x.size), self.room.dtype)
            room[:self.size] = self.room[:self.size]
            self.room = room
        self.room[self.size:self.size + x.size] = x
        self.size += x.size

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.size]


class Lattices:
    """The lattices of different words, kept for the blocks of a task up to about ``MOST_EDGES`` edges.

    Nodes are a word's places and its end, one word after the other; edges are in the order of their nodes.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.hash, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # of the words, by hash
        self.base, self.end = Grown(np.int64), Grown(np.int64)  # nodes of each word
        self.char, self.first_edge = Grown(np.uint64), Grown(np.int64)  # of each node
        self.first_edge.add(np.zeros(1, np.int64))
        self.node, self.step, self.ids = Grown(np.int32), Grown(np.int16), Grown(np.int32)  # of each edge
        self.share, self.part = Grown(np.float64), Grown(np.float64)

    def numbers(self, h: np.ndarray, data: np.ndarray, at: np.ndarray, until: np.ndarray) -> np.ndarray:
        """The numbers of words, given by their sorted different hashes and their bytes; new ones are added."""
        if self.node.size > MOST_EDGES:
            self.clear()
        k = np.minimum(np.searchsorted(self.hash, h), max(self.hash.size - 1, 0))
        known = self.hash[k] == h if self.hash.size else np.zeros(h.size, bool)
        new = np.flatnonzero(~known)
        if new.size:
            first = self.base.size
            self._add(data, at[new], until[new])
            place = np.searchsorted(self.hash, h[new])
            self.hash = np.insert(self.hash, place, h[new])
            self.number = np.insert(self.number, place, np.arange(first, first + new.size))
        return self.number[np.searchsorted(self.hash, h)]

    def _add(self, data: np.ndarray, at: np.ndarray, until: np.ndarray) -> None:
        # the characters of the words
        n_bytes = until - at
        raw_until = np.cumsum(n_bytes)
        source = np.arange(int(n_bytes.sum())) + np.repeat(at - raw_until + n_bytes, n_bytes)
        raw = data[source]
        size = np.add.reduceat((raw & 0xC0) != 0x80, raw_until - n_bytes, dtype=np.int64)
        chars = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        chars[chars == 32] = ord(SPACE)
        base = np.cumsum(size + 1) - size - 1
        end = base + size
        n_nodes = int(size.sum() + size.size)
        inner = np.ones(n_nodes, bool)
        inner[end] = False
        node = np.flatnonzero(inner)
        left = np.repeat(end, size) - node
        char = np.zeros(n_nodes, np.uint64)
        char[node] = chars
        of, step, weight, ids = self.v.edges(np.r_[chars, np.zeros(self.v.longest, np.uint64)], left)
        start = node[of]  # of each edge, in order
        first_edge = np.searchsorted(start, np.arange(n_nodes + 1))
        # log of the summed weight from a node to its word's end, from the ends back
        total = np.full(n_nodes, -np.inf)
        total[end] = 0.0
        share = weight  # becomes the log share of an edge among all ways on
        order = np.argsort(_small(left[of]), kind="stable")
        size = np.bincount(left[of], minlength=1)
        until = np.cumsum(size)
        for r in np.flatnonzero(size):
            e = order[until[r] - size[r]:until[r]]
            x = start[e]
            w = weight[e] + total[x + step[e]]
            first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            n_ways = np.diff(np.r_[first, x.size])
            top = np.maximum.reduceat(w, first)
            here = top + np.log(np.add.reduceat(np.exp(w - np.repeat(top, n_ways)), first))
            total[x[first]] = here
            share[e] = w - np.repeat(here, n_ways)
        # a node's edges share the interval from 0 to 1: where each one's part ends
        each = np.exp(share)
        part = np.cumsum(each)
        at_first = first_edge[start]
        part = part - part[at_first] + each[at_first]
        if start.size:
            part[np.r_[start[1:] != start[:-1], True]] = 1.0
        n, n_edges = self.char.size, self.node.size
        self.base.add(base + n)
        self.end.add(end + n)
        self.char.add(char)
        self.first_edge.size -= 1  # its last stands for the end
        self.first_edge.add(first_edge + n_edges)
        self.node.add(start + n)
        for kept, x in ((self.step, step), (self.ids, ids), (self.share, share), (self.part, part)):
            kept.add(x)


class Block:
    """Some texts as chains of words, whose lattices are those of ``lattices``."""

    def __init__(self, vocabulary: Vocabulary, texts: list[str], lattices: Lattices | None = None):
        self.v = vocabulary
        self.n = len(texts)
        raw = [(" " + t.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
        start = np.zeros(data.size + 1, bool)
        if data.size:
            alone = vocabulary.alone[data]
            start[1:-1] = ((data[1:] == 32) & (data[:-1] != 32)) | alone[1:] | alone[:-1]
            start[offsets] = True
        at = np.flatnonzero(start[:-1])
        until = np.r_[at[1:], data.size].astype(np.int64)
        self.doc = np.searchsorted(offsets, at, "right") - 1  # of each word
        self.n_words = np.bincount(self.doc, minlength=self.n)
        self.first_word = np.cumsum(self.n_words) - self.n_words
        h = hashes(data, at, until) if at.size else np.zeros(0, np.uint64)
        h, one, kind = np.unique(h, return_index=True, return_inverse=True)
        own = lattices or Lattices(vocabulary)
        self.kind = own.numbers(h, data, at[one], until[one])[kind]
        self.base, self.end, self.char, self.first_edge, self.node, self.step, self.ids, self.share, self.part = (
            x.all for x in (own.base, own.end, own.char, own.first_edge, own.node, own.step, own.ids, own.share, own.part))

    def draw(self, seed: np.ndarray, serial: np.ndarray, word: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
        """Complete words from given nodes: (word, edge) of each piece, by word and place."""
        out, k = [], 0
        on = node < self.end[self.kind[word]]
        word, node = word[on], node[on]
        while word.size:
            d = self.doc[word]
            u = uniform(seed[d], 1, serial[d], word - self.first_word[d], k)
            edge = self.first_edge[node]
            low = np.flatnonzero(self.part[edge] < u)
            while low.size:  # likely edges come first
                edge[low] += 1
                low = low[self.part[edge[low]] < u[low]]
            out.append((word, edge))
            node = node + self.step[edge]
            on = node < self.end[self.kind[word]]
            word, node, k = word[on], node[on], k + 1
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(2))
        cat = [np.concatenate(x) for x in zip(*out)]
        order = np.argsort(cat[0], kind="stable")
        return tuple(x[order] for x in cat)

    def piece_ids(self, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces, how many of them each edge gives): one, or a character's bytes."""
        ids = self.ids[edge]
        n = np.ones(ids.size, np.int64)
        raw = np.flatnonzero(ids < 0)
        if not raw.size:
            return ids, n
        text = [chr(int(c)).encode("utf-8", "surrogatepass") for c in self.char[self.node[edge[raw]]]]
        n[raw] = [len(b) for b in text]
        out = np.repeat(ids, n)
        out[out < 0] = self.v.byte_ids[np.frombuffer(b"".join(text), np.uint8)]
        return out, n


def search(block: Block, seed: np.ndarray, k: int, reach: float = REACH) -> Iterator[tuple]:
    """Draw up to k segmentations of each text: yields (texts, sample number, path, log p, perturbed, by piece) and last a threshold.

    The last item is (None, threshold of each text).
    """
    n = block.n
    best = -np.log(-np.log(uniform(seed, 0)))  # the largest perturbed value of all segmentations
    made = np.zeros(n, np.int64)  # samples of each text
    serial = np.zeros(n, np.int64)  # of a text's draws and splits, for noise of their own
    paths: list[tuple[np.ndarray, ...]] = []  # by round: word, edge, log share before
    # edge -1 - x: all that departs from the path at node x or later
    front = {name: np.zeros(0, kind) for name, kind in (
        ("doc", np.int64), ("bound", float), ("turn", np.int64), ("word", np.int64), ("edge", np.int64), ("before", float))}

    def split(path, sub, whole, spread):
        """What departs from ``path`` at its rows ``sub``; by text, ``whole``: log p of the path, ``spread``: where the reach begins."""
        word, edge, before = (x[sub] for x in path)
        d = block.doc[word]
        near = before >= spread[d] - reach
        node = block.node[edge[near]]
        n_ways = block.first_edge[node + 1] - block.first_edge[node]
        i = np.repeat(np.arange(node.size), n_ways)
        other = np.arange(i.size) + np.repeat(block.first_edge[node] - np.cumsum(n_ways) + n_ways, n_ways)
        off = other != edge[near][i]
        i, other = i[off], other[off]
        rows = {"doc": d[near][i], "word": word[near][i], "edge": other, "before": before[near][i],
                "place": block.share[other] + before[near][i]}
        far = np.flatnonzero(~near)  # the first row beyond reach stands for all after it
        if far.size:
            far = far[np.r_[True, d[far][1:] != d[far][:-1]]]
            rest = whole[d[far]] - before[far]
            with np.errstate(divide="ignore"):
                place = before[far] + np.log(-np.expm1(np.minimum(rest, 0)))
            some = place > -np.inf
            far, place = far[some], place[some]
            add = {"doc": d[far], "word": word[far], "edge": -1 - block.node[edge[far]], "before": before[far], "place": place}
            rows = {name: np.concatenate([rows[name], add[name]]) for name in rows}
        one = rows["edge"] >= 0
        at = np.where(one, block.node[rows["edge"]], -1 - rows["edge"])
        rows["u"] = uniform(seed[rows["doc"]], 2, serial[rows["doc"]], rows["word"] - block.first_word[rows["doc"]],
                            at - block.base[block.kind[rows["word"]]], np.where(one, block.step[rows["edge"]], 0))
        return rows

    def push(rows, bound, turn):
        more = rows | {"bound": bound, "turn": turn}
        for name in front:
            front[name] = np.concatenate([front[name], more[name]])

    def parents(docs, turns):
        """Rows of the paths of the given texts, each of its own round."""
        of = np.full(n, -1)
        of[docs] = turns
        parts = []
        for t in np.unique(turns):
            keep = of[block.doc[paths[t][0]]] == t
            parts.append(tuple(x[keep] for x in paths[t]))
        cat = [np.concatenate(x) for x in zip(*parts)]
        order = np.argsort(cat[0], kind="stable")
        return tuple(x[order] for x in cat)

    turn, docs = 0, np.arange(n)
    branch = None
    while True:
        # the path of each text of ``docs``: what its parent has before the branch, the branch, and the rest drawn
        if branch is None:
            word = np.arange(block.doc.size)
            w, e = block.draw(seed, serial, word, block.base[block.kind])
            new = np.ones(w.size, bool)
        else:
            to_word, to_edge = np.full(n, -1), np.full(n, -1)
            to_word[docs], to_edge[docs] = branch["word"], branch["edge"]
            pw, pe, _ = parents(docs, branch["turn"])
            d = block.doc[pw]
            keep = (pw < to_word[d]) | ((pw == to_word[d]) & (block.node[pe] < block.node[to_edge[d]]))
            mine = np.zeros(n, bool)
            mine[docs] = True
            word = np.flatnonzero(mine[block.doc])
            word = word[word >= to_word[block.doc[word]]]
            d = block.doc[word]
            after = block.node[to_edge[d]] + block.step[to_edge[d]]
            w, e = block.draw(seed, serial, word, np.where(word == to_word[d], after, block.base[block.kind[word]]))
            new = np.r_[np.zeros(keep.sum() + docs.size, bool), np.ones(w.size, bool)]
            w = np.concatenate([pw[keep], branch["word"], w])
            e = np.concatenate([pe[keep], branch["edge"], e])
            order = np.argsort(w << 32 | e)  # edges are in the order of their nodes
            w, e, new = w[order], e[order], new[order]
        d = block.doc[w]
        share = block.share[e]
        upto = np.cumsum(share)
        lead = np.zeros(n)
        if w.size:
            first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
            lead[d[first]] = upto[first] - share[first]
        before = np.minimum(upto - share - lead[d], 0)
        whole = np.bincount(d, share, n) if w.size else np.zeros(n)
        paths.append((w, e, before))
        yield docs, made[docs].copy(), (w, e), whole[docs], best[docs]
        made[docs] += 1
        sub = np.flatnonzero(new)
        spread = np.zeros(n)
        if branch is not None:
            spread[docs] = branch["before"]
        rows = split(paths[-1], sub, whole, spread)
        push(rows, truncated(rows["place"], best[rows["doc"]], rows["u"]), np.full(rows["doc"].size, turn))
        # the best entry of each text; entries that stand for several departures are split until one is a branch
        while True:
            want = front["doc"][made[front["doc"]] < k]
            order = np.argsort(-front["bound"])
            order = order[np.argsort(_small(front["doc"][order]), kind="stable")]
            top = order[np.r_[True, front["doc"][order][1:] != front["doc"][order][:-1]]] if order.size else order
            if not want.size:
                threshold = np.full(n, -np.inf)
                threshold[front["doc"][top]] = front["bound"][top]
                yield None, threshold
                return
            pick = top[made[front["doc"][top]] < k]
            taken = {name: front[name][pick] for name in front}
            several = taken["edge"] < 0
            if not several.any():
                break
            drop = pick[several]
            for name in front:
                front[name] = np.delete(front[name], drop)
            turn += 1
            owner = taken["turn"][several]
            path = parents(taken["doc"][several], owner)
            paths.append(path)  # a round of its own, so that its noise is new
            from_word, from_node = np.full(n, -1), np.full(n, -1)
            from_word[taken["doc"][several]], from_node[taken["doc"][several]] = taken["word"][several], -1 - taken["edge"][several]
            pd = block.doc[path[0]]
            sub = np.flatnonzero((path[0] > from_word[pd]) | ((path[0] == from_word[pd]) & (block.node[path[1]] >= from_node[pd])))
            whole = np.bincount(pd, block.share[path[1]], n)
            spread = np.zeros(n)
            spread[taken["doc"][several]] = taken["before"][several]
            serial[taken["doc"][several]] += 1
            rows = split(path, sub, whole, spread)
            # their largest is the entry's bound: noise as drawn, moved so that the largest meets it
            g = rows["place"] - np.log(-np.log(rows["u"]))
            z, bound = np.full(n, -np.inf), np.zeros(n)
            np.maximum.at(z, rows["doc"], g)
            bound[taken["doc"][several]] = taken["bound"][several]
            z, bound = z[rows["doc"]], bound[rows["doc"]]
            with np.errstate(over="ignore", divide="ignore"):
                moved = bound - np.log1p(np.exp(bound - g) - np.exp(bound - z))
            push(rows, np.where(g == z, bound, moved), np.full(rows["doc"].size, turn))
        docs, branch = taken["doc"], taken
        best[docs] = taken["bound"]
        serial[docs] += 1
        for name in front:
            front[name] = np.delete(front[name], pick)
        turn += 1


def log_inclusion(log_p: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(log p - threshold)))."""
    x = np.minimum(log_p - threshold, 700)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.isneginf(threshold), 0.0, np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.maximum(x, -40))))))


def row_seeds(keys: list, seed: int = SEED) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest("" if k is None else f"={k}", seed) for k in keys], np.uint64)


def sampled(vocabulary: Vocabulary, keys: list, texts: list[str | None], k: int = SAMPLES, seed: int = SEED,
            reach: float = REACH, lattices: Lattices | None = None) -> list[tuple]:
    """(text index, sample, ids as bytes, number of ids, log p, perturbed, log inclusion) of a block of texts."""
    block = Block(vocabulary, [t or "" for t in texts], lattices)
    found = []
    for item in search(block, row_seeds(keys, seed), k, reach):
        if item[0] is None:
            threshold = item[1]
            break
        docs, number, (word, edge), log_p, bound = item
        ids, each = block.piece_ids(edge)
        size = np.bincount(block.doc[word], each, block.n).astype(np.int64)
        until = np.cumsum(size)
        raw = ids.astype("<u4")
        for d, j, lp, g in zip(docs.tolist(), number.tolist(), log_p.tolist(), bound.tolist()):
            found.append((d, j, raw[until[d] - size[d]:until[d]].tobytes(), int(size[d]), lp, g))
    found.sort(key=lambda r: r[:2])
    inc = log_inclusion(np.array([r[4] for r in found]), threshold[[r[0] for r in found]]) if found else []
    return [(*r, float(i)) for r, i in zip(found, inc)]


class Decoder:
    """Texts of rows of ids, by gathering the bytes of all pieces at once; odd rows are left to the model's own decoder."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        raw = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        self.size = np.array([len(r) for r in raw])
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.odd = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
        self.opens = np.array([sp.id_to_piece(i).startswith(SPACE) for i in range(n)])

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of the rows ids[offsets[i]:offsets[i + 1]]."""
        out = []
        for lo, hi in row_blocks(offsets, DECODE_IDS):
            own, edge = ids[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            if own.size and (own.min() < 0 or own.max() >= self.size.size):
                raise ValueError("ids beyond the model's pieces")
            size = self.size[own]
            until = np.r_[0, np.cumsum(size)]
            raw = self.data[np.arange(until[-1]) + np.repeat(self.at[own] - until[:-1], size)].tobytes()
            odd = np.r_[0, np.cumsum(self.odd[own])]
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                text = raw[until[a] + 1:until[b]] if a < b else b""  # without the space that opens every text
                plain = a == b or (self.opens[own[a]] and odd[a] == odd[b])
                if plain:
                    try:
                        text.decode()
                    except UnicodeDecodeError:
                        plain = False
                out.append(text if plain else self.sp.decode(own[a:b].tolist()).encode())
        return out


def sample(docs: DataFrame, model: str, id_col: str = "doc_id", text: str = "text", k: int = SAMPLES, alpha: float = ALPHA,
           seed: int = SEED, with_ids: bool = True, with_decoded: bool = False) -> DataFrame:
    """(id, sample, n_pieces, ids_crc32, log_p, perturbed, log_inclusion, and ids) of each drawn segmentation.

    ``with_decoded``: also decoded_crc32, of the UTF-8 of the text that the ids decode to.

    ``model``: path of a SentencePiece model, the same on every worker.  Samples
    of a row are numbered from 0 by falling perturbed log-probability.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField(id_col, given.schema["id"].dataType), T.StructField("sample", T.IntegerType()), T.StructField("n_pieces", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("log_p", T.DoubleType()), T.StructField("perturbed", T.DoubleType()),
        T.StructField("log_inclusion", T.DoubleType()), *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
        *([T.StructField("decoded_crc32", T.LongType())] if with_decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = lattices = decoder = None
        for batch in batches:
            vocabulary = vocabulary or Vocabulary(model, alpha)
            lattices = lattices or Lattices(vocabulary)
            decoder = decoder or (Decoder(model) if with_decoded else None)
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lo, held = 0, 0
            for hi in range(1, len(texts) + 1):
                held += len(texts[hi - 1] or "")
                if held >= BLOCK_CHARS or hi == len(texts):
                    rows = sampled(vocabulary, keys[lo:hi], texts[lo:hi], k, seed, lattices=lattices)
                    i, number, raw, size, log_p, bound, inc = zip(*rows)
                    made = [pa.array([keys[lo + x] for x in i], batch.schema.field(0).type), pa.array(number, pa.int32()), pa.array(size, pa.int64()),
                            pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array(log_p), pa.array(bound), pa.array(inc)]
                    flat, at = np.frombuffer(b"".join(raw), "<i4"), np.r_[0, np.cumsum(size)]
                    if with_ids:
                        made.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)))
                    if with_decoded:
                        made.append(pa.array([zlib.crc32(t) for t in decoder.texts(flat, at)], pa.int64()))
                    yield pa.RecordBatch.from_arrays(made, schema.names)
                    lo, held = hi, 0

    return given.mapInArrow(run, schema)


def decode(samples: DataFrame, model: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """All columns and the text that the ids in ``ids`` stand for (null ids: null)."""
    fields = [f for f in samples.schema.fields if f.name.lower() != out.lower()]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(model)
            column = batch.column(names.index(ids))
            size = np.array([len(x.values) if x.is_valid else 0 for x in column], np.int64)
            texts = decoder.texts(column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(size)])
            texts = [t.decode() if x else None for t, x in zip(texts, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, out])

    return samples.select(*names).mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StringType())]))
