"""N-gram Jaccard join: texts whose sets of word n-grams are similar.

Method: MinHash banding. Rows per band are fixed by ``ROWS``; the number of bands follows from the
target recall at the threshold. Texts shuffle on their band hashes; texts that meet in a bucket are
candidates, and every such pair is verified on full n-gram sets, once.

1. Texts with the same words are one node; its copies are counted, never expanded.
2. Buckets with the same nodes are one. A pair that meets in several is judged in the first of them.
3. Families of near copies fill most of their bands with the same nodes again: where all pairs of a connected group are
   fewer than the pairs of its buckets, the group is taken as one bucket. A chain of half similar texts is not.
4. A bucket is verified by one task if it is small, else cut into blocks; every pair of blocks is one
   small task. A task gives each node's links and a spanning forest, so rows stay linear in each block.
5. The forests are joined into classes.

A family of g different texts costs g^2 / 2 comparisons, spread over its block pairs: counting each
text's links exactly needs them. Only candidates' texts travel, compressed, one for each node. Nodes are 64-bit
hashes: some 6 x 10^9 different texts are expected before two share one. Every step is written before the next begins, and what
it shuffled is removed then.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.durable import settled, shuffles_removed
from quayside.llm.blocks import Block, U, blocks, mix
from quayside.llm.components import components
from quayside.llm.op10_line_dedup import lookup, slots
from quayside.llm.texts import released, small_batches, unpacked

WORDS, SIMILARITY, RECALL, ROWS = 5, Fraction(4, 5), 0.9999, 5
#: A block has about so many texts and n-grams at most.
BLOCK_TEXTS, BLOCK_GRAMS = 256, 500_000
_STEP = U(0xD6E8FEB86659FD93)


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` hashes so that a pair at ``similarity`` shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def word_grams(block: Block, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and hash of every word n-gram, and a hash of each text's word sequence (0: no word).

    A text with fewer words than ``words`` has one n-gram of all its words.
    """
    starts, ends = block.words()
    hashed = block.hashes(starts, ends)
    owner = block.text_of(starts)
    count = np.bincount(owner, minlength=block.n)
    stop = np.cumsum(count)[owner]
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    at = np.flatnonzero((np.arange(len(owner)) + words <= stop) | (first & (count[owner] < words)))
    total = np.zeros(len(at), np.uint64)
    for i in range(words):
        here = at + i
        inside = here < stop[at]
        total = mix(total * _STEP + np.where(inside, hashed[np.minimum(here, len(hashed) - 1)], U(1)))
    nodes = np.zeros(block.n, np.uint64)
    place = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
    some = np.flatnonzero(count)
    if len(some):
        sequence = mix(hashed + mix(place.astype(np.uint64) * _STEP))
        nodes[some] = mix(np.add.reduceat(sequence, (np.cumsum(count) - count)[some])) | U(1)
    return owner[at], total, nodes


def band_hashes(owner: np.ndarray, grams: np.ndarray, n: int, bands: int, rows: int) -> list:
    """The band hashes of each text with n-grams, else an empty array."""
    texts, begin = np.unique(owner, return_index=True)
    seeds = np.random.default_rng(4).integers(0, 1 << 32, (2, bands * rows), np.uint64).astype(np.uint32)
    short = (grams >> U(32)).astype(np.uint32)
    out = np.zeros((len(texts), bands), np.uint64)
    for i in range(bands if len(texts) else 0):
        band = np.full(len(texts), i + 1, np.uint64)
        for j in range(i * rows, (i + 1) * rows):
            least = np.minimum.reduceat((short ^ seeds[0, j]) * (seeds[1, j] | np.uint32(1)), begin)
            band = mix(band * _STEP + least)
        out[:, i] = band
    offsets = np.zeros(n + 1, np.int32)
    offsets[texts + 1] = bands
    return pa.ListArray.from_arrays(pa.array(np.cumsum(offsets), pa.int32()), pa.array(out.reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, key: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """(key, row, node, n, bands, pack) for each row; ``node`` is null for a text without words, ``row`` a hash of key and
    text, ``pack`` the compressed text."""

    def sign(batches):
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(2)
            for block in blocks(texts):
                owner, grams, nodes = word_grams(block, words)
                raw = block.data.tobytes()
                packs = [tool.compress(raw[low:high]) for low, high in zip(block.bounds[:-1], block.bounds[1:], strict=True)]
                columns = [
                    batch.column(0).slice(block.first, block.n), batch.column(1).slice(block.first, block.n),
                    pa.array(nodes.view(np.int64), mask=nodes == 0),
                    pa.array(np.bincount(owner, minlength=block.n)),
                    band_hashes(owner, grams, block.n, bands, rows), pa.array(packs, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "row", "node", "n", "bands", "pack"])

    kind = docs.schema[key].dataType.simpleString()
    rows_in = docs.select(F.col(key).alias("key"), F.xxhash64(key, text).alias("row"), F.col(text).alias("text"))
    return rows_in.mapInArrow(released(sign), f"key {kind}, row long, node long, n long, bands array<long>, pack binary")


def _elsewhere(seen: list[np.ndarray], bucket: int) -> np.ndarray | None:
    """Which pairs of nodes already met in a bucket before this one; None: none did. ``seen``: the buckets of each node."""
    owner = np.repeat(np.arange(len(seen)), [len(s) for s in seen])
    flat = np.concatenate(seen)
    owner, flat = owner[flat < bucket], flat[flat < bucket]
    if not len(flat):
        return None
    _, column = np.unique(flat, return_inverse=True)
    has = np.zeros((len(seen), int(column.max()) + 1), np.float32)
    has[owner, column] = 1
    return has @ has.T > 0


def _verify(nodes, copies, part, sets, similarity: Fraction, across: bool, done: np.ndarray | None = None):
    """Links (copies counted) and root (smallest node reached) of the nodes of one pair of blocks, but for pairs ``done``."""
    m = len(nodes)
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    common = np.zeros((m, m), np.float32)
    width = max(1, min(int(shared.sum()), (1 << 22) // m))
    edges = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        if low < high:
            has = np.zeros((m, width), np.float32)
            has[owner[low:high], column[low:high] % width] = 1
            common += has @ has.T
    common = np.rint(common).astype(np.int64)
    union = size[:, None] + size[None, :] - common
    linked = common * similarity.denominator >= union * similarity.numerator
    np.fill_diagonal(linked, False)
    if across:
        linked &= part[:, None] != part[None, :]
    if done is not None:
        linked &= ~done
    links = linked @ copies
    root = nodes.copy()
    while True:
        lower = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lower == root).all():
            return links, root
        root = lower


def _verifier(words: int, similarity: Fraction):
    def run(batches):
        group, held = None, {}

        def flush():
            if len(held) < 2:
                return None
            nodes = np.array(list(held), np.int64)
            copies, part, seen, sets = zip(*held.values(), strict=True)
            done = _elsewhere([np.array(s, np.int64) for s in seen], group[0])
            links, root = _verify(nodes, np.array(copies), np.array(part), sets, similarity, group[1] != group[2], done)
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(root), pa.array(links)], ["node", "root", "links"])

        for batch in batches:
            rows = batch.drop_columns(["pack"]).to_pylist()
            for block in blocks(unpacked(batch.column("pack"))):
                owner, grams, _ = word_grams(block, words)
                cut = np.searchsorted(owner, np.arange(block.n + 1))
                for i in range(block.n):
                    row = rows[block.first + i]
                    at = row["bucket"], row["i"], row["j"]
                    if at != group:
                        if done := flush():
                            yield done
                        group, held = at, {}
                    held[row["node"]] = (row["copies"], row["part"], row["buckets"], np.unique(grams[cut[i] : cut[i + 1]]))
        if done := flush():
            yield done

    return released(run)


def _sifted(packs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose node may be wanted, by a bitmap of fixed size: other texts need not travel to the join."""
    bits = packs.sparkSession.sparkContext.broadcast(lookup(wanted.select(F.col("node").alias("key"), F.lit(0).alias("line"))))

    def run(batches):
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            yield batch.filter(pa.array(bits.value[slots(nodes, np.zeros(len(nodes), np.int64))]))

    return packs.mapInArrow(released(run), "node long, pack binary")


def meetings(nodes: DataFrame) -> DataFrame:
    """(bucket, node): which nodes are to be compared with which; see the module's points 2 and 3."""
    banded = nodes.select("node", F.explode("bands").alias("band"))
    same = ["m", "lead", "last", "x", "y"]
    buckets = banded.groupBy("band").agg(
        F.count("*").alias("m"), F.min("node").alias("lead"), F.max("node").alias("last"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    ).where("m > 1")
    buckets = settled(buckets.groupBy(*same).agg(F.min("band").alias("band")).select("band", "m", "lead"), "buckets")
    members = settled(banded.join(buckets.select("band", "lead"), "band"), "members")
    groups = settled(components(members, "lead", "node"), "candidates")
    pairs = F.sum(F.col("m").cast("double") * F.col("m"))
    cost = buckets.join(groups, F.col("lead") == F.col("node")).groupBy("label").agg(pairs.alias("by_bucket"))
    size = groups.groupBy("label").agg(F.count("*").alias("g"))
    whole = F.col("g").cast("double") * F.col("g") <= F.col("by_bucket")
    chosen = groups.join(size.join(cost, "label").select("label", whole.alias("whole")), "label")
    chosen = settled(chosen.select("node", "label", "whole"), "groups")
    apart = members.join(chosen.where(~F.col("whole")).select("node"), "node").select(F.col("band").alias("bucket"), "node")
    return apart.unionByName(chosen.where("whole").select(F.col("label").alias("bucket"), "node"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similarity: Fraction = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``node``, ``class_id``, ``keeper``, ``n_links``.

    ``n_links`` is the number of other rows whose n-gram sets have a Jaccard similarity of at least
    ``similarity`` with this one's. Rows linked directly or through others are one class; ``class_id`` is its
    smallest key, ``keeper`` says whether the row has that key and, among equal keys, the lowest node.

    A null text, or one without words, links to nothing: its class is its own key. Texts below ``words`` words
    have one n-gram. Repeated rows link to each other. A null key is the highest. Other columns are not read;
    no rows give no rows.
    """
    with small_batches(docs.sparkSession), shuffles_removed(docs.sparkSession):
        rows = _classified(docs, key, text, words, similarity, recall)
    return rows.select(F.col("key").alias(key), "node", "class_id", "keeper", "n_links")


def _classified(docs: DataFrame, key: str, text: str, words: int, similarity: Fraction, recall: float) -> DataFrame:
    """The rows of ``near_duplicates`` with ``row``, the hash of key and text."""
    bands = bands_for(float(similarity), recall, ROWS)
    signed = settled(signatures(docs, key, text, words, bands, ROWS), "signatures")
    nodes = signed.where("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("key").alias("key"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands")
    )
    nodes = settled(nodes, "nodes")
    met = settled(meetings(nodes), "meetings")
    facts = met.join(nodes.select("node", "n"), "node").groupBy("bucket").agg(F.count("*").alias("m"), F.sum("n").alias("grams"))
    parts = F.greatest(F.ceil(F.col("m") / BLOCK_TEXTS), F.ceil(F.col("grams") / BLOCK_GRAMS)).alias("parts")
    # of each node at most as many buckets as bands
    seen = met.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))
    # one text for each node: an id may be missing or shared by many texts, and copies vanish before they travel
    sifted = _sifted(signed.where("node is not null").select("node", "pack"), seen)
    texts = sifted.join(seen.select("node"), "node", "left_semi").groupBy("node").agg(F.any_value("pack").alias("pack"))
    texts = settled(texts.join(seen, "node").join(nodes.select("node", "copies"), "node"), "texts")
    found = met.join(facts.select("bucket", parts), "bucket").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    found = found.join(texts, "node").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    found = found.select(
        "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "copies", "part", "buckets", "pack"
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.repartition(partitions, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    verified = settled(found.mapInArrow(_verifier(words, similarity), "node long, root long, links long"), "verified")

    classes = components(verified, "root", "node")
    facts = nodes.join(verified.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(
        classes, "node", "left"
    )
    facts = facts.select(
        "node", "key", F.coalesce("label", "node").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    first = facts.groupBy("label").agg(F.min(F.struct(F.col("key").isNull(), "key", "node")).alias("first"))
    facts = facts.join(first, "label").select("node", "n_links", F.col("first.key").alias("class_id"), F.col("first.node").alias("best"))
    return signed.select("key", "row", "node").join(facts, "node", "left").select(
        "key", "row", "node",
        F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("n_links").isNull(), True).otherwise((F.col("best") == F.col("node")) & F.col("key").eqNullSafe(F.col("class_id"))).alias("keeper"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "n_links")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that with the smallest id. Of rows with equal id and words one stays."""
    with small_batches(spark), shuffles_removed(spark):
        found = _classified(docs, "doc_id", "text", WORDS, SIMILARITY, RECALL)
    kept = found.where("keeper").groupBy("key", F.coalesce("node", F.lit(0).cast("long")).alias("node")).agg(F.min("row").alias("__row"))
    tagged = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    return tagged.join(settled(kept.select("__row"), "kept"), "__row", "left_semi").dropDuplicates(["__row"]).select(docs.columns)
