"""Sampled SentencePiece encoding, and decoding that gives the text back.

Method: all ways to cut a text into pieces form a lattice. Forward filtering sums the weights of the paths
to each position; backward sampling then draws one path, so a segmentation comes with the probability of
its pieces. The random number of a position follows from the row's key, so any run, batch or retry draws
the same. A piece's weight is 1 / (rank + ``OFFSET``) to the power ``theta``: ranks are all that a byte-pair
vocabulary publishes, and word pieces follow such a law.

No piece has a word mark after another character, nor a line break: the lattice splits there into chunks.
Chunks that occur often share one forward pass. Chunks above ``LONG`` characters are handled one by one, in
logarithms. Each text is encoded whole by one task; nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quayside.llm.blocks import U, forget_powers, mix
from quayside.llm.texts import release

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA, SEED, OFFSET, LONG = 1.0, 2, 10, 40
MARK = "▁"
#: A mark that the text itself has; chunks from the pattern never look like this.
OWN_MARK = "\n" + MARK
CHUNK = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
#: Characters encoded at once; four times as many take 41 MB instead of 27 and save no time.
BLOCK_CHARS = 1 << 15


@dataclass(frozen=True)
class Vocabulary:
    """``pieces`` by id; ``kinds``: p for a piece, b for a byte, x for others; all shipped to the tasks."""

    pieces: tuple[str, ...]
    kinds: str

    @property
    def bytes_at(self) -> np.ndarray:
        at = np.full(256, -1, np.int64)
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if k == "b":
                at[int(p[3:5], 16)] = i
        return at


def vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model file. It must have all 256 bytes; pieces with a line break or an inner mark are an error."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kind = lambda i: "b" if model.is_byte(i) else "x" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "p"
    found = Vocabulary(tuple(model.id_to_piece(i) for i in ids), "".join(map(kind, ids)))
    if (found.bytes_at < 0).any():
        raise ValueError("the model has no byte fallback")
    if any(k == "p" and not re.fullmatch(f"{MARK}*[^{MARK}\n]*", p) for p, k in zip(found.pieces, found.kinds, strict=True)):
        raise ValueError("a piece crosses a word")
    return found


class Trie:
    """All pieces that begin at each place of a text, for all places at a time."""

    _SLOTS = 1 << 20

    def __init__(self, pieces: list[tuple[str, int]]):
        nodes, value = {"": 0}, [-1]
        steps = []
        for piece, number in pieces:
            for i in range(1, len(piece) + 1):
                if piece[:i] not in nodes:
                    nodes[piece[:i]] = len(value)
                    steps.append((nodes[piece[: i - 1]] << 21 | ord(piece[i - 1]), len(value)))
                    value.append(-1)
            value[nodes[piece]] = number
        self.value = np.array(value, np.int64)
        if 2 * len(steps) > self._SLOTS:
            raise ValueError("the vocabulary is too large for the trie's table")
        key, child = (np.array(x, np.int64) for x in zip(*steps, strict=True))
        self.key, self.child = np.full(self._SLOTS, -1, np.int64), np.full(self._SLOTS, -1, np.int32)
        slot = self._slot(key)
        while len(key):  # each round, one of the keys that want a free slot gets it
            slot = np.where(self.key[slot] >= 0, (slot + 1) % self._SLOTS, slot)
            free = self.key[slot] < 0
            first = np.unique(slot[free], return_index=True)[1]
            got = np.flatnonzero(free)[first]
            self.key[slot[got]], self.child[slot[got]] = key[got], child[got]
            rest = np.ones(len(key), bool)
            rest[got] = False
            key, child, slot = key[rest], child[rest], slot[rest]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * U(0x9E3779B97F4A7C15) >> U(44)).astype(np.int64)

    def _step(self, key: np.ndarray) -> np.ndarray:
        slot = self._slot(key)
        seen = self.key[slot]
        out = np.where(seen == key, self.child[slot], -1)
        open_ = np.flatnonzero((seen != key) & (seen >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % self._SLOTS
            seen = self.key[slot[open_]]
            hit = seen == key[open_]
            out[open_[hit]] = self.child[slot[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out

    def matches(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and number of every piece in the text of these code points."""
        begins, ends, pieces = [], [], []
        at, node, depth = np.arange(len(points)), np.zeros(len(points), np.int64), 0
        while len(at):
            node = self._step(node << 21 | points[at + depth]).astype(np.int64)
            depth += 1
            on = node >= 0
            at, node = at[on], node[on]
            value = self.value[node]
            some = value >= 0
            begins.append(at[some])
            ends.append(at[some] + depth)
            pieces.append(value[some])
            on = at + depth < len(points)
            at, node = at[on], node[on]
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate([empty, *x]) for x in (begins, ends, pieces))


class Sampler:
    """Encodes the texts of one task."""

    def __init__(self, words: Vocabulary, theta: float, seed: int):
        self.size = len(words.pieces)
        self.byte = words.bytes_at
        rank = np.cumsum([k == "p" for k in words.kinds])
        self.weight = (1.0 / (rank + OFFSET)) ** theta
        self.unknown = float((1.0 / (self.size + OFFSET)) ** theta)
        self.seed = seed
        self.trie = Trie([(p, i) for i, (p, k) in enumerate(zip(words.pieces, words.kinds, strict=True)) if k == "p"])
        self.raw = [
            bytes([int(p[3:5], 16)]) if k == "b" else b"" if k == "x" else p.replace(MARK, " ").encode()
            for p, k in zip(words.pieces, words.kinds, strict=True)
        ]

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and id of all pieces in ``text``, by end; a character without a piece gets the id size + code point."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        begin, end, piece = self.trie.matches(points)
        alone = points != 10
        alone[begin[end - begin == 1]] = False
        lone = np.flatnonzero(alone)
        begin, end = np.concatenate([begin, lone]), np.concatenate([end, lone + 1])
        piece = np.concatenate([piece, self.size + points[lone]])
        order = np.argsort(end, kind="stable")
        return begin[order], end[order], piece[order]

    def weights(self, piece: np.ndarray) -> np.ndarray:
        return np.where(piece < self.size, self.weight[np.minimum(piece, self.size - 1)], self.unknown)

    def draws(self, seed: np.ndarray, place: np.ndarray) -> np.ndarray:
        """32 random bits for a place in a text."""
        with np.errstate(over="ignore"):
            return mix(seed + place.astype(np.uint64) * U(0x9E3779B97F4A7C15)) >> U(32)

    def sample(self, chunks: list[str], which: np.ndarray, seed: np.ndarray, offset: np.ndarray):
        """Pieces of all chunk occurrences in order, and their number for each.

        ``which`` is each occurrence's chunk, ``seed`` its text's, ``offset`` its place there. At most ``LONG`` characters.
        """
        text = "\n".join(chunks)
        begin, end, piece = self.edges(text)
        length = np.array([len(c) for c in chunks], np.int64)
        base = np.cumsum(length + 1) - length - 1
        chunk = np.repeat(np.arange(len(chunks)), length + 1)[end]
        weight = self.weights(piece)
        # forward, one character further in all chunks at a time
        alpha = np.zeros(len(text) + 1)
        alpha[base] = 1
        level = end - base[chunk]
        order = np.argsort(level, kind="stable")
        bounds = np.searchsorted(level[order], np.arange(1, LONG + 2))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if low < high:
                at = order[low:high]
                first = np.flatnonzero(np.concatenate([[True], end[at][1:] != end[at][:-1]]))
                alpha[end[at][first]] = np.add.reduceat(alpha[begin[at]] * weight[at], first)
        share = alpha[begin] * weight / alpha[end]
        new = np.concatenate([[True], end[1:] != end[:-1]])
        segment = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        place = np.arange(len(end)) - start[segment]
        for k in range(1, int(place.max(initial=0)) + 1):
            at = np.flatnonzero(place == k)
            share[at] += share[at - 1]
        upto = (np.minimum(share, 1) * 4294967296.0).astype(np.uint64)
        upto[np.concatenate([start[1:], [len(end)]]) - 1] = U(1 << 32)
        key = (segment.astype(np.uint64) << U(32)) + upto
        of_node = np.zeros(len(text) + 1, np.uint64)
        of_node[end[start]] = np.arange(len(start), dtype=np.uint64)
        # backward, one piece of all occurrences at a time
        node, origin = base[which] + length[which], base[which]
        active = np.arange(len(which))
        count = np.zeros(len(which), np.int64)
        taken = []
        while len(active):
            here = node[active]
            bits = self.draws(seed[active], offset[active] + here - origin[active])
            at = np.searchsorted(key, (of_node[here] << U(32)) + bits, side="right")
            taken.append((active, piece[at]))
            count[active] += 1
            node[active] = begin[at]
            active = active[begin[at] > origin[active]]
        out = np.empty(int(count.sum()), np.int64)
        last = np.cumsum(count) - 1
        for step, (occurrence, ids) in enumerate(taken):
            out[last[occurrence] - step] = ids
        return out, count

    def sample_long(self, chunk: str, seed: int, offset: int) -> list[int]:
        """The same for one chunk of any length, in logarithms."""
        begin, end, piece = self.edges(chunk)
        cost = np.log(self.weights(piece)).tolist()
        cut = np.searchsorted(end, np.arange(len(chunk) + 2)).tolist()
        begin, piece = begin.tolist(), piece.tolist()
        alpha = [0.0] + [-math.inf] * len(chunk)
        for e in range(1, len(chunk) + 1):
            terms = [alpha[begin[k]] + cost[k] for k in range(cut[e], cut[e + 1])]
            top = max(terms)
            alpha[e] = top + math.log(sum(math.exp(t - top) for t in terms))
        places = np.arange(len(chunk) + 1, dtype=np.int64) + offset
        bits = self.draws(np.full(len(places), seed, np.uint64), places).tolist()
        at, out = len(chunk), []
        while at:
            left = bits[at] / 4294967296.0
            for k in range(cut[at], cut[at + 1]):
                left -= math.exp(alpha[begin[k]] + cost[k] - alpha[at])
                if left < 0:
                    break
            out.append(piece[k])
            at = begin[k]
        return out[::-1]

    def encode(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """Ids of each text."""
        index: dict[str, int] = defaultdict()
        index.default_factory = index.__len__
        which, per_text, lengths = [], [], []
        for text in texts:
            parts = text.split(MARK) if text else []
            chunks: list[str] = []
            for i, part in enumerate(parts):
                chunks += [OWN_MARK] * (i > 0)
                chunks += CHUNK.findall((MARK if i == 0 else "") + part.replace(" ", MARK))
            which.append(np.fromiter(map(index.__getitem__, chunks), np.int64, len(chunks)))
            per_text.append(len(chunks))
        index.default_factory = None  # it held the index in a cycle, with all chunks, until Python's rare collection of such
        chunks = list(index)
        which = np.concatenate(which) if which else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(texts)), per_text)
        lengths = np.array([1 if c == OWN_MARK else len(c) for c in chunks], np.int64)
        before = np.cumsum(lengths[which]) - lengths[which]
        first = np.searchsorted(owner, np.arange(len(texts)))
        offset = before - before[np.minimum(first, max(0, len(before) - 1))][owner] if len(before) else before
        fixed = np.array([c == "\n" or c == OWN_MARK for c in chunks], bool)
        long = (lengths > LONG) & ~fixed
        short = np.flatnonzero(~fixed & ~long)
        count = np.ones(len(which), np.int64)
        parts = {}
        usual = np.flatnonzero(~(fixed | long)[which]) if len(which) else which
        if len(usual):
            renumber = np.zeros(len(chunks), np.int64)
            renumber[short] = np.arange(len(short))
            ids, n = self.sample([chunks[i] for i in short], renumber[which[usual]], seeds[owner[usual]], offset[usual])
            count[usual] = n
        for k in np.flatnonzero(long[which]) if len(which) else ():
            parts[k] = self.sample_long(chunks[which[k]], int(seeds[owner[k]]), int(offset[k]))
            count[k] = len(parts[k])
        out = np.empty(int(count.sum()), np.int64)
        begin = np.cumsum(count) - count
        if len(usual):
            out[np.repeat(begin[usual] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        for k, part in parts.items():
            out[begin[k] : begin[k] + len(part)] = part
        if len(which):
            forced = np.flatnonzero(fixed[which])
            points = np.array([ord(c[-1]) for c in chunks], np.int64)
            out[begin[forced]] = self.size + points[which[forced]]
        ends = np.concatenate([[0], np.cumsum(count)])[np.concatenate([first, [len(which)]])]
        return self._bytes(out, ends)

    def _bytes(self, ids: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Spell characters without a piece as bytes; cut at ``ends``."""
        lone = np.flatnonzero(ids >= self.size)
        if len(lone):
            spelled = [self.byte[list(chr(p).encode())] for p in (ids[lone] - self.size).tolist()]
            width = np.ones(len(ids), np.int64)
            width[lone] = [len(s) for s in spelled]
            shift = np.concatenate([[0], np.cumsum(width)])
            out = np.repeat(ids, width)
            at = np.repeat(shift[lone], width[lone])
            inside = np.arange(len(at)) - np.repeat(np.cumsum(width[lone]) - width[lone], width[lone])
            out[at + inside] = np.concatenate(spelled)
            ids, ends = out, shift[ends]
        ids = ids.astype(np.int32)
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, ids) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode()[1:]


_HELD: dict = {}


def _sampler(words: Vocabulary, theta: float, seed: int) -> Sampler:
    key = (hash(words.pieces), theta, seed)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Sampler(words, theta, seed)
        release()  # what the trie was built from
    return _HELD[key]


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, theta: float = THETA, seed: int = SEED,
    out: str = "encoded",
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_tokens``, ``ids``, and ``lossless`` (decoding gave the text back).

    The draw depends on the key, ``seed`` and the text alone: rows equal in both are cut alike; null keys share one
    draw. A null text has null fields; an empty one has no ids. Marks, line breaks and characters without a piece
    are spelled in bytes, so every text comes back as it was. ``out`` replaces a column of that name; other columns
    stay as they are.
    """
    words = vocabulary(model)

    def run(keys: pa.Array, texts: pa.Array) -> pa.Array:
        forget_powers()
        release()  # what this worker's earlier tasks have left
        tool = _sampler(words, theta, seed)
        seeds = mix(keys.to_numpy(zero_copy_only=False).view(np.uint64) + U(seed))
        done, at = [], 0
        while at < len(texts):  # some texts at a time, so that little memory is held
            values, size = [], 0
            while at + len(values) < len(texts) and (not values or size < BLOCK_CHARS):
                values.append(texts[at + len(values)].as_py())
                size += len(values[-1] or "")
            ids = tool.encode([v or "" for v in values], seeds[at : at + len(values)])
            good = [tool.decode(i.tolist()) == (v or "") for i, v in zip(ids, values, strict=True)]
            nothing = np.array([v is None for v in values], bool)
            count = np.array([len(i) for i in ids], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32(), mask=np.append(nothing, False))
            columns = [
                pa.array(count, mask=nothing), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))),
                pa.array(np.array(good, bool), mask=nothing),
            ]
            done.append(pa.StructArray.from_arrays(columns, [f.name for f in kind]))
            at += len(values)
        return pa.concat_arrays(done) if done else pa.array([], kind)

    kind = pa.struct([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("lossless", pa.bool_())])
    tool = arrow_udf(run, "struct<n_tokens:long,ids:array<int>,lossless:boolean>").asNondeterministic()
    return docs.withColumn(out, tool(F.coalesce(F.xxhash64(F.col(key)), F.lit(0)), F.col(text)))


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL, out: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids`` as ``out``; null ids give null."""
    words = vocabulary(model)

    def run(lists: pa.Array) -> pa.Array:
        tool = _sampler(words, THETA, SEED)
        return pa.array([None if i is None else tool.decode(i) for i in lists.to_pylist()], pa.string())

    return rows.withColumn(out, arrow_udf(run, "string").asNondeterministic()(F.col(ids)))


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs).select("doc_id", "encoded.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document the mix takes; its copies are cut alike, as they share a key."""
    return encode(docs.select("doc_id", "lang", "source", "text")).select("doc_id", "lang", "source", "encoded.*")
