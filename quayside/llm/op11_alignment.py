"""Cross-tokenizer alignment: where the tokens of two tokenizers end together.

Method: lockstep vectorised merging. All documents of a block are merged at once: one state vector holds each
document's pointers into its A and its B tokens. In each step every pointer whose token ends first moves on; where
both end at the same byte, a link is emitted, the text is cut there and both move. Finished documents are
compacted away. A long document runs as several lanes, cut where tokens were seen to end together, so the number of
steps follows from ``LANE`` and not from the longest text.

Tokens linked end at the same byte, so the shorter one is a suffix of the longer. The pairs that can ever be linked
are therefore known from the two vocabularies (``linkable``), some hundred thousand whatever the corpus: their
corpus-wide counts are one vector, summed by tasks, and small enough to hand back to them. Nothing else is shuffled.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.durable import settled
from quayside.llm.blocks import blocks
from quayside.llm.texts import released

A_MODEL, B_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Tokens of A that a lane has about; bytes of text merged at once.
LANE, BLOCK_BYTES = 256, 1 << 20
MARK = "▁"


def _byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others,
    in order, for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Fixed value: how a byte-level tokenizer of this kind cuts a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below, all versions of Unicode agree which characters are letters, digits and blanks.
_SETTLED = 0x250


@dataclass(frozen=True)
class ByteLevel:
    """A byte-level BPE file of the tokenizers library; texts get a leading space.

    The ids of such a vocabulary rise in the order of its merges, so the faster encoder that only knows ranks gives the same
    ids. It is used for texts whose characters are cut alike by both libraries, the file's own library for all others.
    """

    path: str = A_MODEL

    def vocabulary(self) -> list[bytes]:
        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)
        at = _byte_characters()
        ids = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
        special = {t["id"] for t in model["added_tokens"]}
        out = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            out[i] = b"" if i in special else bytes(at[c] for c in token)
        return out

    def encoder(self):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tool = Tokenizer.from_file(self.path)
        tool.encode_special_tokens = True
        fast = self._by_rank()

        def encode(texts: list[str]) -> list[list[int]]:
            plain = [fast is not None and (t.isascii() or max(t) < chr(_SETTLED)) for t in texts]
            others = iter(tool.encode_batch_fast([" " + t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
            return [fast.encode_ordinary(" " + t) if p else next(others).ids for t, p in zip(texts, plain, strict=True)]

        return encode

    def _by_rank(self):
        """The encoder by ranks, if the file is of the kind that it knows: each merge made the next id, texts are cut by ``PATTERN``."""
        import tiktoken

        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        cut = model["pre_tokenizer"]
        known = model["normalizer"] is None and cut["type"] == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
        if not known or [vocabulary[m] for m in made] != list(range(256, 256 + len(made))) or len(set(made)) != len(made):
            return None
        special = {t["id"] for t in model["added_tokens"]}
        ranks = {w: i for i, w in enumerate(self.vocabulary()) if i not in special}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@dataclass(frozen=True)
class Pieces:
    """A SentencePiece model; it adds the leading space itself."""

    path: str = B_MODEL

    def _model(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.path)

    def vocabulary(self) -> list[bytes]:
        model = self._model()

        def raw(i: int) -> bytes:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                return bytes([int(piece[3:5], 16)])
            return b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(MARK, " ").encode()

        return [raw(i) for i in range(model.get_piece_size())]

    def encoder(self):
        model = self._model()
        return lambda texts: model.encode(texts, num_threads=1)


@cache
def _loaded(side):
    """Encoder, token bytes and their lengths; once for each Python worker."""
    words = side.vocabulary()
    return side.encoder(), words, np.array([len(w) for w in words], np.int64)


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """All pairs of ids that can end together, as ``a * len(b) + b``, ascending.

    Each token has at most as many suffixes as bytes, so there are at most (ids of A + ids of B) x (bytes of the longest
    token) pairs, but for ids that stand for equal bytes.
    """

    def by_bytes(words):
        out: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w:
                out.setdefault(w, []).append(i)
        return out

    of_a, of_b = by_bytes(a), by_bytes(b)
    keys = {i * len(b) + j for w, some in of_a.items() for k in range(len(w)) for j in of_b.get(w[k:], ()) for i in some}
    keys |= {i * len(b) + j for w, some in of_b.items() for k in range(1, len(w)) for i in of_a.get(w[k:], ()) for j in some}
    return np.array(sorted(keys), np.int64)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, begin_a: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the A and B tokens that end together, ascending.

    ``ends_*``: the byte at which each token ends, ascending over all documents one after another; every document's
    last tokens end together. ``begin_a``: first A token of each document. Tokens have at least one byte.
    """
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tries = np.arange(lane, len(ends_a), lane)
    at = np.searchsorted(ends_b, ends_a[tries])
    tries = tries[ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a[tries]] + 1
    pa_ = np.unique(np.concatenate([begin_a, tries]))
    pa_ = pa_[pa_ < len(ends_a)]
    stop = np.append(pa_[1:], len(ends_a))
    before = np.where(pa_ > 0, ends_a[pa_ - 1], -1)
    pb_ = np.searchsorted(ends_b, before, side="right")
    links_a, links_b = [], []
    while len(pa_):
        x, y = ends_a[pa_], ends_b[pb_]
        same = x == y
        links_a.append(pa_[same])
        links_b.append(pb_[same])
        pa_ = pa_ + (x <= y)
        pb_ = pb_ + (y <= x)
        alive = pa_ < stop
        if not alive.all():
            pa_, pb_, stop = pa_[alive], pb_[alive], stop[alive]
    return np.sort(np.concatenate(links_a)), np.sort(np.concatenate(links_b))


class Aligned:
    """The texts of a block, encoded twice and merged.

    ``a``, ``b``: ids of all texts; ``begin_a``, ``begin_b``: where each text's begin, with the total at the end;
    ``cut_a``, ``cut_b``: the tokens that end a group.
    """

    def __init__(self, texts: list[str], left, right, lane: int = LANE):
        (encode_a, words_a, len_a), (encode_b, words_b, len_b) = _loaded(left), _loaded(right)
        lists_a, lists_b = [[] for _ in texts], [[] for _ in texts]
        some = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in some]
        for i, x, y in zip(some, encode_a(given), encode_b(given), strict=True) if given else ():
            whole = b" " + texts[i].encode()
            if b"".join([words_a[t] for t in x]) == whole and b"".join([words_b[t] for t in y]) == whole:
                lists_a[i], lists_b[i] = x, y
        self.a, self.begin_a = _flat(lists_a)
        self.b, self.begin_b = _flat(lists_b)
        ends_a, ends_b = np.cumsum(len_a[self.a]), np.cumsum(len_b[self.b])
        self.cut_a, self.cut_b = lockstep(ends_a, ends_b, self.begin_a[:-1], lane)
        self.n_cuts = np.diff(np.searchsorted(self.cut_a, self.begin_a))

    def spelled(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each text: ids by group."""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.cut_a], last_b[self.cut_b] = 1, 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        last_b[self.begin_b[1:][self.begin_b[1:] > self.begin_b[:-1]] - 1] = 2
        # a group's A tokens stand after all groups before it, its B tokens after its A tokens
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.append(0, self.cut_b + 1)[group_a]] = self.a << 3 | last_a
        codes[np.arange(len(self.b)) + (self.cut_a + 1)[group_b]] = self.b << 3 | last_b + 2
        spell, begin = _spelling(), self.begin_a + self.begin_b
        return [b"".join([spell[c] for c in codes[low:high].tolist()]) for low, high in zip(begin[:-1], begin[1:], strict=True)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    begin = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.fromiter((t for x in lists for t in x), np.int64, int(begin[-1])), begin


class _Spelling(dict):
    """An id and what follows it, as text: inside a group's A or B tokens, at their end, or at the end of the text."""

    def __missing__(self, code: int) -> bytes:
        self[code] = str(code >> 3).encode() + (b",", b"|", b",", b";", b"")[code & 7]
        return self[code]


@cache
def _spelling() -> _Spelling:
    return _Spelling()


def _merged(docs: DataFrame, key: str, text: str, left, right, emit, kind: str) -> DataFrame:
    """(key, what ``emit`` makes of each block)."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK_BYTES):
                texts = batch.column(1).slice(block.first, block.n).fill_null("").to_pylist()
                columns = emit(Aligned(texts, left, right))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), *columns.values()], ["key", *columns])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(released(run), f"key {rows.schema['key'].dataType.simpleString()}, {kind}")


def _lists(flat: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(flat, pa.int32()))


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", left=ByteLevel(), right=Pieces()) -> DataFrame:
    """(key, a, b, a_cuts, b_cuts): ids of each text by both tokenizers, and where its groups end.

    Group g has the tokens after cut g - 1 up to cut g, counted from 0 inside the text; its last tokens are a link. A text
    that is null, empty, or that either tokenizer does not give back byte for byte has no tokens. Equal texts have equal results;
    rows of one id, or without one, are judged each; other columns are not read. A text is merged whole by one task, at some
    400 bytes a byte while the first tokenizer holds its own records. No rows give no rows.
    """

    def emit(found: Aligned) -> dict[str, pa.Array]:
        cuts = np.concatenate([[0], np.cumsum(found.n_cuts)])
        inside = lambda cut, begin: cut - np.repeat(begin[:-1], found.n_cuts)
        return {
            "a": _lists(found.a, found.begin_a), "b": _lists(found.b, found.begin_b),
            "a_cuts": _lists(inside(found.cut_a, found.begin_a), cuts), "b_cuts": _lists(inside(found.cut_b, found.begin_b), cuts),
        }

    kind = "a array<int>, b array<int>, a_cuts array<int>, b_cuts array<int>"
    return _merged(docs, key, text, left, right, emit, kind).withColumnRenamed("key", key)


def digests(docs: DataFrame, key: str, text: str, left, right, keys) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, pairs): ``pairs`` packs each link's place in ``keys``, a
    broadcast of ``linkable``."""

    def emit(found: Aligned) -> dict[str, pa.Array]:
        tool = zstandard.ZstdCompressor(level=1)
        width = len(_loaded(right)[1])
        link = np.searchsorted(keys.value, found.a[found.cut_a] * width + found.b[found.cut_b]).astype(np.int32)
        at = np.concatenate([[0], np.cumsum(found.n_cuts)])
        packs = [tool.compress(link[low:high].tobytes()) for low, high in zip(at[:-1], at[1:], strict=True)]
        return {
            "n_a": pa.array(np.diff(found.begin_a)), "n_b": pa.array(np.diff(found.begin_b)),
            "n_groups": pa.array(found.n_cuts), "n_links": pa.array(found.n_cuts),
            "groups_sha256": pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in found.spelled()]),
            "pairs": pa.array(packs, pa.binary()),
        }

    kind = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
    return _merged(docs, key, text, left, right, emit, kind)


def _unpacked(packs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all packs, one after another, and where each begins."""
    tool = zstandard.ZstdDecompressor()
    parts = [np.frombuffer(tool.decompress(p), np.int32) for p in packs.to_pylist()]
    begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), begin


def pair_counts(pairs: DataFrame, size: int) -> DataFrame:
    """(pair, n): how many links of all documents hold each pair, from a column of packs."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column(0))[0], minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["pair", "n"])

    return pairs.mapInArrow(released(run), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def link_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", left=ByteLevel(), right=Pieces()) -> DataFrame:
    """One row for each row of ``docs``: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A pair's count is the number of links of all documents that hold it. ``n_best``: links whose count is the highest of
    their B id's pairs, ties included; ``count_sum``: over links. Odd rows as in ``align``: their counts are 0 and their hash ''.
    """
    context = docs.sparkSession.sparkContext
    words_a, words_b = left.vocabulary(), right.vocabulary()
    pairs = linkable(words_a, words_b)
    keys = context.broadcast(pairs)
    found = settled(digests(docs, key, text, left, right, keys), "aligned")
    counted = pair_counts(found.select("pairs"), len(pairs)).toArrow()  # at most one row for each pair that can be linked
    count = np.zeros(len(pairs), np.int64)
    count[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    most = np.zeros(len(words_b), np.int64)
    np.maximum.at(most, pairs % len(words_b), count)
    known = context.broadcast((count, count == most[pairs % len(words_b)]))

    def run(batches):
        count, best = known.value
        for batch in batches:
            link, begin = _unpacked(batch.column("pairs"))
            sums = [np.concatenate([[0], np.cumsum(v[link], dtype=np.int64)]) for v in (best, count)]
            columns = [pa.array(s[begin[1:]] - s[begin[:-1]]) for s in sums]
            batch = batch.drop_columns(["pairs"])
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "n_best", "count_sum"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields if f.name != "pairs")
    out = found.mapInArrow(released(run), f"{kind}, n_best long, count_sum long")
    order = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return out.select(F.col("key").alias(key), *order)


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return link_statistics(docs)
