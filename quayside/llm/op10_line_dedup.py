"""Line dedup: an exact set-similarity join of lines, keeping the first of similar ones.

Method: a line is the set of its words. Words are ordered by rarity; a prefix of a set's rarest words
must meet the prefix of every similar set, so sets shuffle on their prefix words only. In such a group
the length filter, the positional filter and a parity bitmap (the words that differ flip bits) leave
few pairs, whose Jaccard similarity is then verified on all words. A line goes if it is similar to a
line before it, in order of (id, line); all is judged on the input.

* Rarity is counted over all words in ``BUCKETS`` hashed counters, a fixed table of 2 MB; within a
  counter the word's hash decides. Any such order gives the same result; this one keeps groups small.
* Equal sets are one, at their first place, before anything is paired; a task drops those of its own
  rows before they travel, so copies are never expanded and a line that is everywhere is no hot group.
* Rows travel as compressed columns, one block for each task and target, half the bytes of rows.
* A group is sorted by length: a set meets only those up to 1 / similarity times as long, and of two sets
  the shorter one only needs the shorter prefix that the length of the other allows.
* A prefix word in over ``SPLIT`` sets is cut into blocks of sets; every pair of blocks is a group of its own.
  Words are counted exactly; the list of cut words is joined to the blocks of sets that have them.
* A line needs one match only. The likeliest candidate of each line is verified first; if it fails and there were
  others, all of those are verified in a second round, so nothing is lost.
"""

from __future__ import annotations

import pickle
from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quayside.functions.durable import settled
from quayside.llm.blocks import Block, U, blocks, mix
from quayside.llm.texts import released, small_batches

SIMILARITY = Fraction(4, 5)
_BITS = 18
BUCKETS, SLICES, SLOTS = 1 << _BITS, 64, 1 << 24
SPLIT, NEAREST, HELD_ROWS, HELD_PAIRS = 8192, 1, 1 << 17, 1 << 20
SCAN_BYTES = 1 << 17  # numpy's arrays for a larger block go back to the system each time, which takes longer than the work
LAST = (1 << 63) - 1
_FRAG = 16
_SET, _GONE = 0, 1


def _key(name: str, text: str):
    """The id; a null id becomes a number from 2^62 on that follows from the text."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST) - F.pmod(F.xxhash64(text), F.lit(1 << 62)))


def rarity(docs: DataFrame, text: str) -> np.ndarray:
    """How many words fall to each counter, over all texts."""

    def count(batches):
        yield _slices(_counted(block for batch in batches for block in blocks(batch.column(0), SCAN_BYTES)))

    def add(batches):
        total = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[i] = total.get(i, 0) + np.frombuffer(counts, np.int64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()])], ["slice", "counts"]
            )

    kind = "slice int, counts binary"
    rows = docs.select(text).mapInArrow(count, kind).repartition(SLICES, "slice").mapInArrow(add, kind).collect()
    out = np.zeros((SLICES, BUCKETS // SLICES), np.int64)
    for row in rows:
        out[row[0]] = np.frombuffer(row[1], np.int64)
    return out.reshape(-1)


def _counted(blocks_) -> np.ndarray:
    """How many words fall to each counter; the table, larger than a block, is gone through once for many blocks."""
    total = np.zeros(BUCKETS, np.int64)
    held, size = [], 0
    for block in blocks_:
        held.append((block.at_point(0, *block.words()) & U(BUCKETS - 1)).astype(np.uint32))
        size += len(held[-1])
        if size > HELD_PAIRS:
            total += np.bincount(np.concatenate(held), minlength=BUCKETS)
            held, size = [], 0
    return total + np.bincount(np.concatenate(held), minlength=BUCKETS) if held else total


def _slices(total: np.ndarray) -> pa.RecordBatch:
    parts = [p.tobytes() for p in total.reshape(SLICES, -1)]
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts)], ["slice", "counts"])


def ranks(counts: np.ndarray) -> np.ndarray:
    rank = np.empty(BUCKETS, np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)
    return rank


class Lines:
    """The lines with words of a block: text number, line number, and their words in order of rarity."""

    def __init__(self, block: Block, rank: np.ndarray):
        starts, ends = block.words()
        one, other = block.at_point(0, starts, ends), block.at_point(1, starts, ends)
        # a one-to-one map of the two 31-bit numbers to one that ascends with frequency; the first alone picks the counter
        tokens = rank[(one & U(BUCKETS - 1)).astype(np.int64)] << U(64 - _BITS) | one >> U(_BITS) << U(31) | other
        begins, _ = block.lines()
        line = np.repeat(np.arange(len(begins)), np.diff(np.searchsorted(starts, begins), append=len(starts)))
        order = _by_line(line, tokens)
        tokens, line = tokens[order], line[order]
        new = np.ones(len(line), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (line[1:] != line[:-1])
        self.tokens, line = tokens[new], line[new]
        first = np.ones(len(line), bool)
        first[1:] = line[1:] != line[:-1]
        self.begin = np.flatnonzero(first)
        self.size = np.diff(np.append(self.begin, len(line)))
        which = line[self.begin]
        self.text, self.number = _numbered(block, which)
        self.mixed = mixed = mix(self.tokens)
        self.node = mix(np.add.reduceat(mix(mixed), self.begin) + self.size.astype(np.uint64)) if len(which) else mixed

    def bitmaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Parity bitmaps, one after another, and their words: a power of two from 1 for each 64 words of a line."""
        width = _width(self.size)
        begin = np.cumsum(width) - width
        flat = np.zeros(int(width.sum()), np.uint64)
        if len(width):
            flat[begin] = np.bitwise_xor.reduceat(U(1) << (self.mixed & U(63)), self.begin)  # right for one word of bits
        wide = np.flatnonzero(width > 1)
        if len(wide):
            flat[_spread(width, wide)] = 0
            bit = self.mixed[_spread(self.size, wide)] & (np.repeat(64 * width[wide], self.size[wide]).astype(np.uint64) - U(1))
            word = np.repeat(begin[wide], self.size[wide]) + (bit >> U(6)).astype(np.int64)
            np.bitwise_xor.at(flat, word, U(1) << (bit & U(63)))
        return flat, width


def _by_line(line: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Order by line, then token."""
    bits = int(line[-1]).bit_length() if len(line) else 0
    if not bits:
        return np.argsort(tokens, kind="stable")
    key = line.astype(np.uint64) << U(64 - bits) | tokens >> U(bits)
    order = np.argsort(key)
    near = np.flatnonzero(key[order][1:] == key[order][:-1])
    # the bits cut off decide only between words that agree in all the others; that is rare
    if (tokens[order[near]] != tokens[order[near + 1]]).any():
        return np.lexsort((tokens, line))
    return order


def _width(n: np.ndarray) -> np.ndarray:
    return 1 << np.ceil(np.log2(np.maximum(n, 64) / 64)).astype(np.int64)


def _numbered(block: Block, which: np.ndarray):
    """Text number of the lines ``which``, and their numbers inside it."""
    breaks = np.flatnonzero(block.data == 10)
    lines = np.bincount(block.text_of(breaks), minlength=block.n) + 1
    first = np.cumsum(lines) - lines
    text = np.searchsorted(first, which, side="right") - 1
    return text, which - first[text]


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))


def _spread(size: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Where the items of the rows ``some`` stand, if all rows' items, ``size`` of each, stand one after another."""
    begin, size = (np.cumsum(size) - size)[some], size[some]
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _pieces(rows: list[np.ndarray], flat: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray):
    """Rows cut before each of ``first``, with the items that belong to them: ``flat`` has all items and the size of each row's."""
    begins = [np.append(0, np.cumsum(size)) for _, size in flat]
    for low, high in zip(first.tolist(), [*first[1:].tolist(), len(rows[0])], strict=True):
        yield [c[low:high] for c in rows] + [items[b[low] : b[high]] for (items, _), b in zip(flat, begins, strict=True)]


def _prefix_size(n: np.ndarray, similarity: Fraction) -> np.ndarray:
    """How many of ``n`` words meet those of every similar set: n - ceil(n t) + 1."""
    return n + (-n * similarity.numerator) // similarity.denominator + 1


def _packed(columns: list[np.ndarray], tool) -> bytes:
    """Columns byte by byte, so that the bytes that are always 0 vanish."""
    flat = [c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return tool.compress(pickle.dumps([(c.dtype.str, f) for c, f in zip(columns, flat, strict=True)], 5))


def _columns(pack: bytes, tool) -> list[np.ndarray]:
    out = []
    for kind, flat in pickle.loads(tool.decompress(pack)):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(size, -1).T).view(kind).reshape(-1))
    return out


def _joined(packs: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*packs, strict=True)]


class Sets:
    """Sets of words as columns: node, key, line, n, and one after another their prefix words and bitmaps."""

    def __init__(self, columns: list[np.ndarray], similarity: Fraction):
        self.columns, self.similarity = columns, similarity
        self.node, self.key, self.line, self.n, self.prefix, self.bits = columns
        size = self.n.astype(np.int64)
        self.long, self.width = _prefix_size(size, similarity), _width(size)

    def take(self, some: np.ndarray) -> Sets:
        flat = [self.prefix[_spread(self.long, some)], self.bits[_spread(self.width, some)]]
        return Sets([c[some] for c in self.columns[:4]] + flat, self.similarity)

    def firsts(self) -> tuple[Sets, list[np.ndarray]]:
        """Each different set at its first place, and the other places."""
        order = np.lexsort((self.line, self.key, self.node))
        node, key, line = self.node[order], self.key[order], self.line[order]
        new = np.ones(len(order), bool)
        new[1:] = node[1:] != node[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        other = (key != key[first]) | (line != line[first])  # rows of one id may hold the same line at the same place
        return self.take(order[new]), [key[other], line[other]]


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def line_sets(docs: DataFrame, key: str, text: str, rank: np.ndarray, similarity: Fraction) -> DataFrame:
    """(row, pack, kind): the different sets of words of all lines at their first places, and the places of the others."""
    buckets = 4 * _partitions(docs)

    def made(batches):
        tool = zstandard.ZstdCompressor(level=1)
        held, size = [], 0

        def flush():
            sets, gone = Sets(_joined(held), similarity).firsts()
            bucket = (mix(sets.node) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            targets, first = np.unique(bucket[order], return_index=True)
            sets = sets.take(order)
            pieces = _pieces(sets.columns[:4], [(sets.prefix, sets.long), (sets.bits, sets.width)], first)
            packs = [_packed(piece, tool) for piece in pieces]
            kinds = [_SET] * len(packs)
            if len(gone[0]):  # they only pass through, anywhere
                targets = np.append(targets, int(mix(gone[0][:1].astype(np.uint64))[0] % U(buckets)))
                packs, kinds = [*packs, _packed(gone, tool)], [*kinds, _GONE]
            return pa.RecordBatch.from_arrays([pa.array(targets.astype(np.int32)), pa.array(kinds, pa.int32()), pa.array(packs, pa.binary())], ["row", "kind", "pack"])

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1), SCAN_BYTES):
                lines = Lines(block, rank)
                n = lines.size
                flat, _ = lines.bitmaps()
                long = _prefix_size(n, similarity)
                at = np.repeat(lines.begin - (np.cumsum(long) - long), long) + np.arange(long.sum())
                held.append([
                    lines.node, keys[block.first + lines.text].astype(np.int64), lines.number.astype(np.int32), n.astype(np.int32),
                    (lines.mixed[at] >> U(32)).astype(np.uint32), flat,
                ])
                size += len(n)
                if size > HELD_ROWS >> 2:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def merged(batches):
        pack_tool, tool = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        bucket, held, size, gone = None, [], 0, []

        def done():
            rows = []
            if held:
                sets, others = Sets(_joined(held), similarity).firsts()
                rows.append((bucket, _SET, _packed(sets.columns, pack_tool)))
                gone.append(others)
            if gone:
                rows.append((bucket, _GONE, _packed(_joined(gone), pack_tool)))
            row, kind, packs = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(row, pa.int32()), pa.array(packs, pa.binary()), pa.array(kind, pa.int32())], ["row", "pack", "kind"])

        for batch in batches:
            for b, kind, pack in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket and bucket is not None:
                    yield done()
                    held, size, gone = [], 0, []
                bucket = b
                columns = _columns(pack, tool)
                if kind == _GONE:
                    gone.append(columns)
                    continue
                held.append(columns)
                size += len(columns[0])
                if size > HELD_ROWS and len(held) > 1:
                    sets, others = Sets(_joined(held), similarity).firsts()
                    held, gone = [sets.columns], [*gone, others]
                    size = len(sets.n) // 2  # half of it, else a large bucket would be merged again with each pack
        if bucket is not None:
            yield done()

    rows = docs.select(_key(key, text).alias("key"), text).mapInArrow(released(made), "row int, kind int, pack binary")
    rows = rows.repartition(_partitions(docs), "row").sortWithinPartitions("row")
    return rows.mapInArrow(released(merged), "row int, pack binary, kind int")


def places(gone: DataFrame) -> DataFrame:
    """(key, line) from packs of places."""

    def run(batches):
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for pack in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _columns(pack, tool)], ["key", "line"])

    return gone.select("pack").mapInArrow(run, "key long, line int")


def frequent(found: DataFrame, similarity: Fraction) -> DataFrame:
    """(token, n): prefix words in more than ``SPLIT`` sets, with their exact number of sets."""
    buckets = 4 * _partitions(found)

    def count(batches):
        tool, pack_tool = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        held, size = [], 0

        def flush():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            bucket = (mix(tokens.astype(np.uint64)) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            targets, first = np.unique(bucket[order], return_index=True)
            packs = [_packed([tokens[some], n[some]], pack_tool) for some in np.split(order, first[1:])]
            return pa.RecordBatch.from_arrays([pa.array(targets.astype(np.int32)), pa.array(packs, pa.binary())], ["bucket", "pack"])

        for batch in batches:
            for pack in batch.column(0).to_pylist():
                held.append(_columns(pack, tool)[4])
                size += len(held[-1])
                if size > 8 * HELD_ROWS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def add(batches):
        tool = zstandard.ZstdDecompressor()
        bucket, held, size = None, [], 0

        def summed(parts):
            tokens, n = _joined(parts)
            order = np.argsort(tokens, kind="stable")
            tokens, n = tokens[order], n[order]
            at = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            return [tokens[at], np.add.reduceat(n, at)]

        def done():
            tokens, n = summed(held)
            often = n > SPLIT
            return pa.RecordBatch.from_arrays([pa.array(tokens[often].astype(np.int64)), pa.array(n[often])], ["token", "n"])

        for batch in batches:
            for b, pack in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket and held:
                    yield done()
                    held, size = [], 0
                bucket = b
                held.append(_columns(pack, tool))
                size += len(held[-1][0])
                if size > 8 * HELD_ROWS and len(held) > 1:
                    held = [summed(held)]
                    size = len(held[0][0]) // 2
        if held:
            yield done()

    packs = found.select("pack").mapInArrow(released(count), "bucket int, pack binary")
    packs = packs.repartition(_partitions(found), "bucket").sortWithinPartitions("bucket")
    return packs.mapInArrow(released(add), "token long, n long")


def with_cuts(found: DataFrame, often: DataFrame) -> DataFrame:
    """``found`` with ``cuts``: which words of a row's sets are cut, and into how many blocks."""

    def run(batches):
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for row, pack in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = np.unique(_columns(pack, tool)[4]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), row, np.int32)), pa.array(tokens)], ["row", "token"])

    held = found.select("row", "pack").mapInArrow(run, "row int, token long").join(often, "token")
    cut = F.struct("token", F.expr(f"(n + {SPLIT} - 1) div {SPLIT}").alias("blocks"))
    cuts = held.groupBy("row").agg(F.collect_list(cut).alias("cuts"))  # at most the words of one row's sets
    return found.join(cuts, "row", "left")


#: Columns of a prefix row as they travel, before the bitmaps.
_TYPES = {
    "token": np.uint32, "ij": np.uint32, "part": np.uint16, "pos": np.uint32, "n": np.uint32, "key": np.int64,
    "line": np.int32, "frag": np.uint16, "asks": np.uint8,
}


def dealt(found: DataFrame, parts: int, similarity: Fraction, asked: np.ndarray | None) -> DataFrame:
    """(bucket, pack): the prefix rows of all sets. With ``asked``, only those of words it may hold; ``asks`` then lists
    the sets of a row that ask."""

    def run(batches):
        tool, reader = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        held, size = [], 0

        def rows(sets, asks, cuts):
            n, long = sets.n.astype(np.int64), sets.long
            owner = np.repeat(np.arange(len(n)), long)
            pos = np.arange(len(owner)) - np.repeat(np.cumsum(long) - long, long)
            token = sets.prefix
            keep = np.arange(len(owner)) if asked is None else np.flatnonzero(asked[token >> np.uint32(8)])
            blocks_ = np.ones(len(keep), np.int64)
            if cuts:
                heavy = np.array(sorted(cuts), np.uint32)
                cut = np.array([cuts[x] for x in heavy.tolist()], np.int64)
                where = np.minimum(np.searchsorted(heavy, token[keep]), len(heavy) - 1)
                blocks_ = np.where(heavy[where] == token[keep], cut[where], 1)
            own = owner[keep]
            salt = mix(sets.key[own].astype(np.uint64) + mix(sets.line[own].astype(np.uint64) + U(1)))
            part = (salt % blocks_.astype(np.uint64)).astype(np.int64)
            again = np.repeat(np.arange(len(keep)), blocks_)
            other = np.arange(len(again)) - np.repeat(np.cumsum(blocks_) - blocks_, blocks_)
            part = part[again]
            ij = np.minimum(part, other) << 16 | np.maximum(part, other)
            row = keep[again]
            own = owner[row]
            frag = sets.node[own] & U(0xFFFF)
            cols = [token[row], ij, part, pos[row], n[own], sets.key[own], sets.line[own], frag, asks[own]]
            cols = [c.astype(t) for c, t in zip(cols, _TYPES.values(), strict=True)]
            return [*cols, sets.bits[_spread(sets.width, own)]]

        def packs():
            cols = _joined(held)
            width = _width(cols[4].astype(np.int64))
            bucket = (mix(cols[0].astype(np.uint64) << U(32) | cols[1]) % U(parts)).astype(np.int64)
            order = np.lexsort((cols[4], cols[0], bucket))
            targets, first = np.unique(bucket[order], return_index=True)
            bits = cols[-1][_spread(width, order)]
            out = [_packed(piece, tool) for piece in _pieces([c[order] for c in cols[:-1]], [(bits, width[order])], first)]
            return pa.RecordBatch.from_arrays([pa.array(targets.astype(np.int32)), pa.array(out, pa.binary())], ["bucket", "pack"])

        for batch in batches:
            names = batch.schema.names
            lists = {c: batch.column(c).to_pylist() if c in names else [None] * batch.num_rows for c in ("cuts", "asks")}
            for pack, cuts, wanted in zip(batch.column("pack").to_pylist(), lists["cuts"], lists["asks"], strict=True):
                sets = Sets(_columns(pack, reader), similarity)
                asks = np.ones(len(sets.n), np.uint8)
                if asked is not None:
                    want = {(w["key"], w["line"], w["size"]) for w in wanted or ()}
                    size_of = sets.n.astype(np.int64) << _FRAG | (sets.node & U(0xFFFF)).astype(np.int64)
                    all_ = zip(sets.key.tolist(), sets.line.tolist(), size_of.tolist(), strict=True)
                    asks = np.fromiter((s in want for s in all_), np.uint8, len(sets.n))
                for some in np.array_split(np.arange(len(sets.n)), max(1, len(sets.prefix) * 8 // HELD_ROWS)):
                    held.append(rows(sets.take(some), asks[some], {c["token"]: c["blocks"] for c in cuts or ()}))
                    size += len(held[-1][0])
                    if size > HELD_ROWS:
                        yield packs()
                        held, size = [], 0
        if size:
            yield packs()

    columns = ["pack", *[c for c in ("cuts", "asks") if c in found.columns]]
    return found.select(*columns).mapInArrow(released(run), "bucket int, pack binary")


def _fold(flat: np.ndarray, begin: np.ndarray, have: int, want: int) -> np.ndarray:
    """Bitmaps of ``have`` words made ``want`` wide."""
    return np.bitwise_xor.reduce(flat[begin[:, None] + np.arange(have)].reshape(len(begin), have // want, want), axis=1)


def _differ(cols: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least so many words are in only one of the two sets."""
    out = np.bitwise_count(cols["fold"][a] ^ cols["fold"][b]).astype(np.int64)
    pair = cols["width"][a] << 32 | cols["width"][b]
    for kind in np.unique(pair[pair != (1 << 32 | 1)]):
        at = np.flatnonzero(pair == kind)
        x, y = int(kind >> 32), int(kind & 0xFFFFFFFF)
        w = min(x, y)
        for some in np.array_split(at, max(1, len(at) * max(x, y) >> 21)):
            left = _fold(cols["bits"], cols["begin"][a[some]], x, w)
            out[some] = np.bitwise_count(left ^ _fold(cols["bits"], cols["begin"][b[some]], y, w)).sum(axis=1)
    return out


def _pairs(cols: dict[str, np.ndarray], similarity: Fraction, nearest: int | None):
    """(later, earlier, differing words, candidates of later) among rows sorted by group and length, as row numbers."""
    p, q = similarity.numerator, similarity.denominator
    n, group = cols["n"].astype(np.int64), cols["group"]
    # a set meets longer ones up to n / similarity, and of its prefix the part that those can share
    stop = np.searchsorted(group << 32 | n, group << 32 | n * q // p, side="right")
    rest = n - cols["pos"]
    same_part = (cols["ij"] >> 16) == (cols["ij"] & 0xFFFF)
    asks = cols["asks"].astype(bool)
    kept: list[np.ndarray] = []
    held, step = 0, 1
    at = np.flatnonzero(cols["pos"] <= n + (-2 * p * n) // (p + q))

    def reduced(parts):
        pairs = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), np.int64)
        pairs = pairs[:, np.lexsort((pairs[2], pairs[0]))]
        begin = np.searchsorted(pairs[0], pairs[0])
        total = np.add.reduceat(pairs[3], np.unique(begin)) if pairs.shape[1] else np.zeros(0, np.int64)
        place = np.arange(pairs.shape[1]) - begin
        pairs[3] = 0
        pairs[3, place == 0] = total
        return pairs if nearest is None else pairs[:, place < nearest]

    while len(at := at[at + step < stop[at]]):
        a, b = at, at + step
        step += 1
        most = (n[a] + n[b]) * (q - p) // (p + q)  # words that may differ
        need = (n[a] + n[b] - most + 1) // 2
        good = np.minimum(rest[a], rest[b]) >= need
        good &= np.bitwise_count(cols["fold"][a] ^ cols["fold"][b]) <= most
        good &= same_part[a] | (cols["part"][a] != cols["part"][b])
        a, b, most = a[good], b[good], most[good]
        differ = _differ(cols, a, b)
        good = differ <= most
        a, b, differ = a[good], b[good], differ[good]
        before = np.zeros(len(a), bool)
        for c in ("frag", "n", "line", "key"):
            x, y = cols[c][a], cols[c][b]
            before = (x < y) | ((x == y) & before)
        later, earlier = np.where(before, b, a), np.where(before, a, b)
        asked = asks[later]
        if asked.any():
            kept.append(np.stack([later[asked], earlier[asked], differ[asked], np.ones(int(asked.sum()), np.int64)]))
            held += kept[-1].shape[1]
            if held > HELD_PAIRS and nearest is not None:
                kept = [reduced(kept)]
                held = 0
    return reduced(kept)


def candidates(packs: DataFrame, similarity: Fraction, nearest: int | None) -> DataFrame:
    """(key, line, size, key2, line2, size2, differ, more): candidate earlier lines of a line, how many words differ at
    least, and how many candidates were left out."""

    def run(batches):
        tool = zstandard.ZstdDecompressor()
        bucket, held = None, []

        def solve():
            all_ = _joined([_columns(h, tool) for h in held])
            held.clear()
            order = np.lexsort((all_[4], all_[1], all_[0]))
            width = _width(all_[4].astype(np.int64))
            begin = np.cumsum(width) - width
            whole = {c: x[order] for c, x in zip(_TYPES, all_, strict=False)}
            whole |= {"width": width[order], "begin": begin[order], "bits": all_[-1], "fold": np.bitwise_xor.reduceat(all_[-1], begin)[order]}
            new = np.concatenate([[True], (np.diff(whole["token"].astype(np.int64)) != 0) | (np.diff(whole["ij"].astype(np.int64)) != 0)])
            whole["group"] = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            low = 0
            while low < len(order):
                at = int(np.searchsorted(first, low + (HELD_ROWS >> 2)))
                high = int(first[at]) if at < len(first) else len(order)
                yield one({k: v if k == "bits" else v[low:high] for k, v in whole.items()})
                low = high

        def one(cols):
            later, earlier, differ, total = _pairs(cols, similarity, nearest)
            given = np.bincount(later, minlength=len(cols["n"]))
            every = np.bincount(later, weights=total, minlength=len(cols["n"])).astype(np.int64)
            size = cols["n"].astype(np.int64) << _FRAG | cols["frag"]
            out = [cols["key"][later], cols["line"][later], size[later], cols["key"][earlier], cols["line"][earlier], size[earlier]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in [*out, differ, (every - given)[later]]], names)

        for batch in batches:
            for b, pack in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket and held:
                    yield from solve()
                bucket = b
                held.append(pack)
        if held:
            yield from solve()

    names = ["key", "line", "size", "key2", "line2", "size2", "differ", "more"]
    packs = packs.repartition(_partitions(packs), "bucket").sortWithinPartitions("bucket")
    kind = "key long, line int, size long, key2 long, line2 int, size2 long, differ long, more long"
    return packs.mapInArrow(released(run), kind)


def slots(key: np.ndarray, line: np.ndarray) -> np.ndarray:
    return (mix(key.astype(np.int64).view(np.uint64) + mix(line.astype(np.uint64) + U(1))) % U(SLOTS)).astype(np.int64)


def lookup(lines: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which the slots of all rows (key, line) are set; put together slice by slice."""
    width = SLOTS // SLICES

    def run(batches):
        held = np.zeros(SLOTS, bool)
        for batch in batches:
            held[slots(batch.column(0).to_numpy(), batch.column(1).to_numpy())] = True
        some = np.flatnonzero(held.reshape(SLICES, -1).any(axis=1))
        parts = [np.packbits(held[i * width : (i + 1) * width]).tobytes() for i in some]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(parts, pa.binary())], ["slice", "bits"])

    def add(batches):
        total = {}
        for batch in batches:
            for i, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[i] = total.get(i, 0) | np.frombuffer(bits, np.uint8)
        columns = [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["slice", "bits"])

    kind = "slice int, bits binary"
    out = np.zeros(SLOTS, bool)
    for i, bits in lines.select("key", "line").mapInArrow(released(run), kind).repartition(SLICES, "slice").mapInArrow(add, kind).collect():
        out[i * width : (i + 1) * width] = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    return out


def _chosen(block: Block, keys: np.ndarray, wanted: np.ndarray) -> tuple[Block, np.ndarray, np.ndarray]:
    """The lines whose slots are set, each as a text of its own, with their keys and numbers."""
    starts, ends = block.lines()
    count = np.bincount(block.text_of(np.flatnonzero(block.data == 10)), minlength=block.n) + 1
    text = np.repeat(np.arange(block.n), count)
    number = np.arange(len(starts)) - np.repeat(np.cumsum(count) - count, count)
    some = np.flatnonzero(wanted[slots(keys[text], number)] & (ends > starts))
    size = ends[some] - starts[some]
    bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = block.data[np.repeat(starts[some] - bounds[:-1], size) + np.arange(bounds[-1])]
    return Block(data, bounds, 0), keys[text[some]], number[some]


def verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, rank: np.ndarray, similarity: Fraction) -> DataFrame:
    """The pairs whose full word sets are similar.

    Texts stay where they are: they are read again, and only lines whose slot is asked for give their words.
    """
    second = [F.col(c).alias(c.removesuffix("2")) for c in ("key2", "line2")]
    wanted = docs.sparkSession.sparkContext.broadcast(lookup(pairs.select("key", "line").unionByName(pairs.select(*second))))

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for block in blocks(batch.column(1), SCAN_BYTES):
                some, key_of, number = _chosen(block, keys[block.first : block.first + block.n], wanted.value)
                lines = Lines(some, rank)
                size = lines.size.astype(np.int64) << _FRAG | (lines.node & U((1 << _FRAG) - 1)).astype(np.int64)
                columns = [
                    pa.array(key_of[lines.text]), pa.array(number[lines.text].astype(np.int32)), pa.array(size),
                    _lists(lines.mixed.view(np.int64), lines.size),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "line", "size", "words"])

    rows = docs.select(_key(key, text).alias("key"), text)
    words = rows.mapInArrow(released(run), "key long, line int, size long, words array<long>").dropDuplicates(["key", "line", "size"])
    words = settled(words, "line-words")
    second = words.select(
        F.col("key").alias("key2"), F.col("line").alias("line2"), F.col("size").alias("size2"), F.col("words").alias("words2")
    )
    both = pairs.join(words, ["key", "line", "size"]).join(second, ["key2", "line2", "size2"])
    common = F.size(F.array_intersect("words", "words2"))
    union = F.size("words") + F.size("words2") - common
    return both.where(common * similarity.denominator >= union * similarity.numerator).select(pairs.columns)


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: Fraction = SIMILARITY) -> DataFrame:
    """(key, line): the lines to remove, counted from 0.

    A line goes if the set of its words has a Jaccard similarity of at least ``similarity`` with that of a line
    before it, in order of (id, line), nulls last. Lines are split at ``\\n``; one without words never goes. Ids are
    integers that tell texts apart: rows of one id are one document, and a line number that goes from one of them goes
    from all. A null text has no words. A null id is replaced by a number from 2^62 on that follows from the text.
    Columns beside the two are not read.
    """
    with small_batches(docs.sparkSession):
        return _repeated(docs, key, text, similarity)


def _repeated(docs: DataFrame, key: str, text: str, similarity: Fraction) -> DataFrame:
    rank = ranks(rarity(docs, text))
    found = settled(line_sets(docs, key, text, rank, similarity), "line-sets", "kind")
    again = settled(places(found.where(F.col("kind") == _GONE)), "repeated-lines")
    found = found.where(F.col("kind") == _SET)
    often = settled(frequent(found, similarity), "frequent-words")
    if not often.isEmpty():
        found = with_cuts(found, often)
    parts = 4 * _partitions(docs)
    ask, other = ["key", "line", "size"], ["key2", "line2", "size2"]
    met = candidates(dealt(found, parts, similarity, None), similarity, NEAREST)
    met = met.groupBy(*ask).agg(
        F.min(F.struct("differ", *other)).alias("best"), F.min(F.struct(*other)).alias("low"), F.max(F.struct(*other)).alias("high"),
        F.sum("more").alias("more"),
    )
    met = settled(met.select(*ask, *[F.col(f"best.{c}") for c in other], ((F.col("more") > 0) | (F.col("low") != F.col("high"))).alias("others")), "candidates")
    pairs = met.drop("others")
    hits = settled(verified(pairs, docs, key, text, rank, similarity).select(ask).distinct(), "similar")
    open_ = settled(met.where("others").select(ask).join(hits, ask, "left_anti"), "open")
    if not open_.isEmpty():
        row = _asking(found, open_, similarity)
        asked = np.zeros(1 << 24, bool)  # a filter of fixed size; what it lets through beyond the asked does no harm
        asked[row.select(F.explode("words")).distinct().toArrow().column(0).to_numpy()] = True
        marked = found.join(row.groupBy("row").agg(F.collect_list(F.struct(*ask)).alias("asks")), "row", "left")
        others = candidates(dealt(marked, parts, similarity, asked), similarity, None).select(pairs.columns).distinct()
        more = settled(others.join(pairs, pairs.columns, "left_anti"), "others")
        hits = hits.unionByName(verified(more, docs, key, text, rank, similarity).select(ask).distinct())
    return again.unionByName(hits.select("key", "line")).distinct()


def _asking(found: DataFrame, open_: DataFrame, similarity: Fraction) -> DataFrame:
    """(row, key, line, size, words): where the asking sets lie, and the slots of their prefix words."""

    def run(batches):
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for row, pack in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sets = Sets(_columns(pack, tool), similarity)
                size = sets.n.astype(np.int64) << _FRAG | (sets.node & U(0xFFFF)).astype(np.int64)
                words = _lists((sets.prefix >> np.uint32(8)).astype(np.int32), sets.long)
                columns = [pa.array(np.full(len(size), row, np.int32)), pa.array(sets.key), pa.array(sets.line), pa.array(size), words]
                yield pa.RecordBatch.from_arrays(columns, ["row", "key", "line", "size", "words"])

    rows = found.select("row", "pack").mapInArrow(run, "row int, key long, line int, size long, words array<int>")
    return settled(rows.join(open_, ["key", "line", "size"], "left_semi"), "asking")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: Fraction = SIMILARITY, out: str = "lines") -> DataFrame:
    """``docs`` with the remaining lines as text and a struct column ``out``: ``n_lines``, ``removed`` (line numbers).

    See ``repeated_lines``. A null text stays null. ``out`` replaces a column of that name.
    """
    gone = repeated_lines(docs, key, text, similarity).groupBy("key").agg(F.sort_array(F.collect_list("line")).alias("__gone"))

    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        left, total = [], []
        for t, numbers in zip(texts.to_pylist(), gone.to_pylist(), strict=True):
            lines = t.split("\n") if t is not None else []
            drop = set(numbers or ())
            left.append(t if not drop or t is None else "\n".join(x for i, x in enumerate(lines) if i not in drop))
            total.append(len(lines))
        parts = [pa.array(left, pa.string()), pa.array(total, pa.int64())]
        return pa.StructArray.from_arrays(parts, ["text", "n_lines"])

    cutter = arrow_udf(cut, "struct<text:string,n_lines:long>").asNondeterministic()
    joined = docs.withColumn("__key", _key(key, text)).join(gone.withColumnRenamed("key", "__key"), "__key", "left")
    joined = joined.withColumn("__cut", cutter(F.col(text), F.col("__gone")))
    removed = F.coalesce("__gone", F.array().cast("array<int>"))
    joined = joined.withColumn(out, F.struct(F.col("__cut.n_lines").alias("n_lines"), removed.alias("removed")))
    return joined.withColumn(text, F.col("__cut.text")).drop("__key", "__gone", "__cut")


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, and the numbers of its lines that go, rising, as text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    gone = repeated_lines(docs).groupBy("key").agg(F.sort_array(F.collect_list("line")).alias("removed_lines"))
    keys = docs.select("doc_id", _key("doc_id", "text").alias("key"))
    found = keys.join(gone, "key", "left").drop("key")
    numbers = F.coalesce("removed_lines", F.array().cast("array<int>"))
    return found.withColumns({"n_removed": F.size(numbers).cast("long"), "removed_lines": F.array_join(numbers, ",")})


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their first lines only; one that loses every line with words goes."""
    found = deduplicate(docs, out="__lines")
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    found = found.where((F.size("__lines.removed") == 0) | words).drop("__lines")
    return found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)
