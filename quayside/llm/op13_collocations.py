"""Phrase collocation mining: frequent phrases, scored at their weakest joint.

Method: direct-address tiling. Words get ids by falling frequency, so frequent ones have small ids. A pair of ids lies
in a tile of ``TILE`` x ``TILE`` counters; a task counts a well-filled tile near the origin with one dense bincount,
and all other tiles as sorted coordinate lists with counts. Counts of tasks are summed by Spark's shuffle, dealt by
a hash of the pair, so no tile is a hot group. Frequent pairs are ranked again and become the ids of the next round:
two neighbouring pairs that overlap are a phrase of three words, and so on up to ``MAX_WORDS``.

* The corpus is written once as ids (some 2 bytes a word), with a break wherever a piece ends or a word is too rare
  to be in any phrase. Each round reads the ids of the round before and writes fewer.
* The ``HEAD`` most frequent words or phrases of a round have ranks; that table is what tasks are sent, so its size is
  fixed. All others stay whole: they are recognised by a bitmap of fixed size and go by a 63-bit hash of themselves. What the
  bitmap lets through beyond them is counted too, found too rare, and dropped.
* The occurrences of a phrase are at most those of its parts, so a phrase of ``min_count`` is found from parts that
  have as many; and one inside a longer phrase is also inside one that is longer by one word only.

Words are told apart by hashes of 63 bits until the counts are exact, and spelled by their text afterwards.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.durable import settled
from quayside.llm.blocks import Block, U, blocks, mix
from quayside.llm.texts import released, small_batches

MIN_COUNT, MAX_WORDS, TOP, COVERED_PERCENT = 100, 5, 2000, 100
HEAD, TILE, DENSE, SLOTS = 1 << 20, 1 << 10, 1 << 13, 1 << 22
#: Pairs or words that a task holds before it hands on what it has counted.
HELD = 1 << 19
NO_LANG = "und"
_HASHED, _BREAK, _STEP = U(1 << 63), U((1 << 64) - 1), U(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The characters that end a piece, and those between words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _ENDS.copy()
_GAP[[0x20, 9]] = True


def _salts(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in langs], np.uint64)


def pieces(block: Block, salts: np.ndarray):
    """The words of a block's texts: lower-cased bytes, starts, ends, hash of language and word, and whether the next
    word goes on in the same piece."""
    low = Block(_LOWER[block.data], block.bounds, block.first)
    starts, ends = low.runs(_GAP[low.data])
    owner = low.text_of(starts)
    ident = mix(low.hashes(starts, ends) ^ salts[owner]) | _HASHED
    broken = np.concatenate([[0], np.cumsum(_ENDS[low.data])])
    goes_on = np.zeros(len(starts), bool)
    goes_on[:-1] = (owner[1:] == owner[:-1]) & (broken[starts[1:]] == broken[ends[:-1]])
    return low.data, starts, ends, ident, goes_on, owner


def word_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, word, ident, n): every word of every language with its number of occurrences."""

    def run(batches):
        held = {}

        def flush():
            rows = [(lang_, word, key, n) for key, (lang_, word, n) in held.items()]
            columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            langs = batch.column(0).fill_null(NO_LANG).to_pylist()
            for block in blocks(batch.column(1)):
                here = langs[block.first : block.first + block.n]
                data, starts, ends, ident, _, owner = pieces(block, _salts(here))
                keys, first, n = np.unique(ident, return_index=True, return_counts=True)
                for key, i, k in zip(keys.view(np.int64).tolist(), first.tolist(), n.tolist(), strict=True):
                    if key in held:
                        held[key][2] += k
                    else:
                        held[key] = [here[owner[i]], data[starts[i] : ends[i]].tobytes().decode(errors="replace"), k]
                if len(held) > HELD >> 2:
                    yield flush()
        yield flush()

    names = ["lang", "word", "ident", "n"]
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    found = rows.mapInArrow(released(run), "lang string, word string, ident long, n long")
    return found.groupBy("lang", "word", "ident").agg(F.sum("n").alias("n"))


def _ident(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What tells a pair of codes from others: both ranks side by side, or a hash if one of them is a hash."""
    return np.where((left | right) < _HASHED, left << U(32) | right, mix(mix(left) * _STEP + right) | _HASHED)


@dataclass(frozen=True)
class Ranks:
    """Codes of frequent words or pairs: a rank for those of ``idents`` (ascending), a hash for those of the bitmap."""

    idents: np.ndarray
    rank: np.ndarray
    rest: np.ndarray | None

    def codes(self, ident: np.ndarray) -> np.ndarray:
        out = np.full(len(ident), _BREAK)
        if len(self.idents):
            at = np.minimum(np.searchsorted(self.idents, ident), len(self.idents) - 1)
            out = np.where(self.idents[at] == ident, self.rank[at], out)
        if self.rest is not None:
            open_ = np.flatnonzero(out == _BREAK)
            open_ = open_[self.rest[_slot(ident[open_])]]
            out[open_] = (mix(ident[open_]) | _HASHED) - (mix(ident[open_]) == U((1 << 63) - 1))
        return out


def _slot(ident: np.ndarray) -> np.ndarray:
    return (mix(ident + U(1)) % U(SLOTS)).astype(np.int64)


def ranks_of(frequent: DataFrame) -> Ranks:
    """The ranks of the ``HEAD`` most frequent rows of (ident, n), and the bitmap of all others."""
    top = frequent.select("ident", "n").orderBy(F.desc("n"), "ident").limit(HEAD).toArrow()
    head, last = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    order = np.argsort(head)
    rest = None
    if len(head) == HEAD and frequent.count() > HEAD:

        def run(batches):
            for batch in batches:
                slots = np.unique(_slot(batch.column(0).to_numpy().view(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32))], ["slot"])

        # rows as frequent as the last ranked one may be ranked too; then the bitmap names them for nothing
        slots = frequent.where(F.col("n") <= int(last[-1])).select("ident").mapInArrow(run, "slot int").distinct().toArrow()
        rest = np.zeros(SLOTS, bool)
        rest[slots.column(0).to_numpy()] = True
    return Ranks(head[order], order.astype(np.uint64), rest)


def coded(frequent: DataFrame, ranks) -> DataFrame:
    """``frequent`` with the code of its ``ident``."""

    def run(batches):
        for batch in batches:
            codes = ranks.value.codes(batch.column("ident").to_numpy().view(np.uint64))
            yield batch.append_column("code", pa.array(codes.view(np.int64)))

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frequent.schema.fields)
    return frequent.mapInArrow(released(run), f"{kind}, code long")


def _packed(*columns: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, so that the bytes that are always 0 vanish."""
    flat = np.concatenate(columns).astype(np.uint64).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(flat.T.tobytes())


def _unpacked(pack: bytes, columns: int = 1) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(pack), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(flat.T).view(np.uint64).reshape(columns, -1)


def _sequence(codes: np.ndarray) -> pa.RecordBatch:
    """Codes with at most one break between two of them."""
    gone = codes == _BREAK
    keep = ~gone
    keep[1:] |= ~gone[:-1]
    return pa.RecordBatch.from_arrays([pa.array([_packed(codes[keep])], pa.binary())], ["codes"])


def encoded(docs: DataFrame, lang: str, text: str, ranks) -> DataFrame:
    """(codes): the words of a block of texts as codes, with breaks where no phrase goes on."""

    def run(batches):
        for batch in batches:
            langs = batch.column(0).fill_null(NO_LANG).to_pylist()
            for block in blocks(batch.column(1)):
                *_, ident, goes_on, _ = pieces(block, _salts(langs[block.first : block.first + block.n]))
                codes = ranks.value.codes(ident)
                out = np.full(2 * len(codes), _BREAK)
                out[::2] = codes
                keep = np.ones(len(out), bool)
                keep[1::2] = ~goes_on
                yield _sequence(out[keep])

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(released(run), "codes binary")


def _neighbours(pack: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All codes but the last, all but the first, and where both stand for something."""
    codes = _unpacked(pack)[0]
    left, right = codes[:-1], codes[1:]
    return left, right, (left != _BREAK) & (right != _BREAK)


def reencoded(sequences: DataFrame, ranks) -> DataFrame:
    """The codes of the phrases longer by one word."""

    def run(batches):
        for batch in batches:
            for pack in batch.column(0).to_pylist():
                left, right, both = _neighbours(pack)
                codes = np.full(len(left), _BREAK)
                codes[both] = ranks.value.codes(_ident(left[both], right[both]))
                if (codes != _BREAK).any():
                    yield _sequence(codes)

    return sequences.mapInArrow(released(run), "codes binary")


def tally(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Different pairs and their numbers, as three rows: dense tiles by bincount, the others as sorted lists."""
    near = (left < U(DENSE)) & (right < U(DENSE))
    x, y = left[near].astype(np.int64), right[near].astype(np.int64)
    side = DENSE // TILE
    tile = (x // TILE) * side + y // TILE
    order = np.argsort(tile.astype(np.uint16), kind="stable")
    x, y, tile = x[order], y[order], tile[order]
    first = np.searchsorted(tile, np.arange(side * side + 1))
    out, sparse = [], [left[~near], right[~near]]
    for t in np.flatnonzero(first[1:] > first[:-1]):
        some = slice(first[t], first[t + 1])
        if first[t + 1] - first[t] < TILE * TILE // 16:  # too empty for a counter for each pair
            sparse += [x[some].astype(np.uint64), y[some].astype(np.uint64)]
            continue
        local = (x[some] % TILE) * TILE + y[some] % TILE
        count = np.bincount(local, minlength=TILE * TILE)
        at = np.flatnonzero(count)
        out.append(np.stack([(t // side) * TILE + at // TILE, (t % side) * TILE + at % TILE, count[at]]).astype(np.uint64))
    x, y = np.concatenate(sparse[::2]), np.concatenate(sparse[1::2])
    out.append(summed([np.stack([x, y, np.ones(len(x), np.uint64)])]))
    return np.concatenate(out, axis=1)


def summed(parts: list[np.ndarray]) -> np.ndarray:
    """Coordinate lists (left, right, n) merged into one, sorted, with the numbers of equal pairs added."""
    left, right, n = np.concatenate(parts, axis=1)
    if len(left) and (left | right).max() < _HASHED:
        order = np.argsort(left << U(32) | right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right, n = left[order], right[order], n[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    at = np.flatnonzero(new)
    return np.stack([left[at], right[at], np.add.reduceat(n, at)]) if len(at) else np.zeros((3, 0), np.uint64)


def pair_counts(sequences: DataFrame, min_count: int) -> DataFrame:
    """(left, right, ident, n): neighbouring codes found ``min_count`` times or more."""
    partitions = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * partitions

    def count(batches):
        held, size = [], 0

        def flush():
            pairs = tally(*np.concatenate(held, axis=1))
            bucket = (mix(mix(pairs[0]) + pairs[1]) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            pairs, bucket = pairs[:, order], bucket[order]
            targets, first = np.unique(bucket, return_index=True)
            packs = [_packed(*p) for p in np.split(pairs, first[1:], axis=1)] if len(targets) else []
            return pa.RecordBatch.from_arrays([pa.array(targets.astype(np.int32)), pa.array(packs, pa.binary())], ["bucket", "pack"])

        for batch in batches:
            for pack in batch.column(0).to_pylist():
                left, right, both = _neighbours(pack)
                held.append(np.stack([left[both], right[both]]))
                size += held[-1].shape[1]
                if size > HELD:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def add(batches):
        bucket, held, size = None, [], 0

        def done():
            left, right, n = summed(held)
            often = n >= U(min_count)
            left, right, n = left[often], right[often], n[often]
            columns = [left, right, _ident(left, right), n]
            return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["left", "right", "ident", "n"])

        for batch in batches:
            for b, pack in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket and held:
                    yield done()
                    held, size = [], 0
                bucket = b
                held.append(_unpacked(pack, 3))
                size += held[-1].shape[1]
                if size > HELD and len(held) > 1:
                    held = [summed(held)]
                    size = held[0].shape[1] // 2  # half of it, else a large sum would be made again with each pack
        if held:
            yield done()

    packs = sequences.mapInArrow(released(count), "bucket int, pack binary")
    packs = packs.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return packs.mapInArrow(released(add), "left long, right long, ident long, n long")


def phrases(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS):
    """All phrases of 1 to ``max_words`` words that occur ``min_count`` times or more, a table for each length, and the
    number of words of each language (lang, total).

    Columns: code, lang, words, n, heads (occurrences of its first 1, 2, .. words), tails (of its last, from the longest
    on), and for two words or more left and right, the codes of the phrases without the last and the first word.
    """
    context = docs.sparkSession.sparkContext
    words = settled(word_counts(docs, lang, text), "words")
    totals = settled(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    frequent = words.where(F.col("n") >= min_count)
    ranks = context.broadcast(ranks_of(frequent))
    none = F.array().cast("array<long>")
    level = coded(frequent, ranks).select("code", "lang", F.array("word").alias("words"), "n", none.alias("heads"), none.alias("tails"))
    levels = [settled(level, "phrases-1")]
    sequences = settled(encoded(docs, lang, text, ranks), "codes-1")
    for k in range(2, max_words + 1):
        found = settled(pair_counts(sequences, min_count), f"pairs-{k}")
        if found.isEmpty():
            break
        ranks = context.broadcast(ranks_of(found))
        first, last = levels[-1].alias("first"), levels[-1].alias("last")
        level = coded(found, ranks).alias("pair")
        level = level.join(first, F.col("pair.left") == F.col("first.code")).join(last, F.col("pair.right") == F.col("last.code"))
        level = level.select(
            "pair.code", "first.lang", F.concat("first.words", F.slice("last.words", -1, 1)).alias("words"), "pair.n",
            F.concat("first.heads", F.array("first.n")).alias("heads"), F.concat(F.array("last.n"), "last.tails").alias("tails"),
            "pair.left", "pair.right",
        )
        levels.append(settled(level, f"phrases-{k}"))
        if k < max_words:
            sequences = settled(reencoded(sequences, ranks), f"codes-{k}")
    return levels, totals


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
    top: int = TOP, covered_percent: int = COVERED_PERCENT,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase has 2 to ``max_words`` words and ``a`` >= ``min_count`` occurrences. Cut after some word, its parts occur ``l``
    and ``r`` times; with ``n`` words in the language, the cut scores floor(1000 a n / (l r)). The lowest score counts, of ties the
    first cut. A phrase inside a longer one with at least ``covered_percent`` % of its occurrences goes. The order is score and
    ``a`` falling, then phrase rising by byte. Arithmetic is exact up to 38 digits.

    A null text has no words; a null language is ``und``. Texts of any length are read whole, repeated rows count each time. Columns
    beside the two are not read. Too few words, or no rows, give no rows.
    """
    with small_batches(docs.sparkSession):
        levels, totals = phrases(docs, lang, text, min_count, max_words)
    found = None
    for level, longer in zip(levels[1:], [*levels[2:], None], strict=False):  # without pairs there is no level beside the words
        if longer is not None:
            inside = longer.select(F.explode(F.array("left", "right")).alias("code"), F.col("n").alias("around"))
            level = level.join(inside.groupBy("code").agg(F.max("around").alias("around")), "code", "left")
            level = level.where(F.col("around").isNull() | (100 * F.col("around") < covered_percent * F.col("n")))
        level = level.select("lang", "words", "n", "heads", "tails")
        found = level if found is None else found.unionByName(level)
    if found is None:
        schema = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        return docs.sparkSession.createDataFrame([], schema)
    exact = lambda c: c.cast("decimal(38,0)")
    found = found.withColumnRenamed("n", "a").join(totals.withColumnRenamed("total", "n"), "lang")
    product = exact(F.lit(1000)) * exact(F.col("a")) * exact(F.col("n"))
    score = lambda i: F.call_function("div", product, exact(F.get("heads", i)) * exact(F.get("tails", i)))
    cuts = F.transform(F.sequence(F.lit(0), F.size("heads") - 1), lambda i: F.struct(score(i).alias("score"), i.alias("at")))
    found = found.withColumn("cut", F.array_min(cuts)).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", F.get("heads", F.col("cut.at")).alias("l"),
        F.get("tails", F.col("cut.at")).alias("r"), "n", "cut.score",
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))  # a language may hold most phrases
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return found.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    return collocations(docs)
