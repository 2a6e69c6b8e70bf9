"""Language identification of mixed texts.

Method: every language is a distribution over hashed byte 4-grams, counted over all training texts. A
text is a mixture of languages; expectation-maximisation estimates the shares. The set of languages
grows one at a time: a language comes in if its gain in likelihood exceeds the Bayesian information
penalty of one more share. Neighbouring 4-grams overlap, so the likelihood is divided by 4.

The model has one fixed row of ``BUCKETS`` numbers for each language, whatever the corpus' size; with at
most ``MAX_LANGUAGES`` it stays below 105 MB. Counts are summed per task before the only shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quayside.llm.blocks import Block, blocks

BUCKETS = 1 << 16
MAX_LANGUAGES = 200
GRAM = 4
UNKNOWN = "und"
ROUNDS = 40

_FOLD = np.full(256, 32, np.uint8)  # other bytes count as a gap
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LATIN = (_FOLD != 32) & (np.arange(256) < 0x80)


def grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every 4-gram whose second byte belongs to a letter; texts are padded with gaps."""
    owner = np.repeat(np.arange(block.n), np.diff(block.bounds))
    padded = np.full(len(block.data) + 3 * block.n + GRAM, 32, np.uint32)
    at = np.arange(len(block.data)) + 3 * owner + 1
    folded = _FOLD[block.data]
    padded[at] = folded
    begin = at[folded != 32] - 1
    code = padded[begin] | padded[begin + 1] << 8 | padded[begin + 2] << 16 | padded[begin + 3] << 24
    return owner[folded != 32], (code * np.uint32(0x9E3779B1)) >> np.uint32(16)


def lettered(block: Block) -> np.ndarray:
    """Whether each text has a letter of any script."""
    seen = np.concatenate([[0], np.cumsum(_LATIN[block.data])])
    found = seen[block.bounds[1:]] > seen[block.bounds[:-1]]
    for i in np.flatnonzero(~found & (np.diff(block.bounds) > 0)):
        raw = block.data[block.bounds[i] : block.bounds[i + 1]].tobytes()
        found[i] = any(map(str.isalpha, raw.decode("utf-8", "replace")))
    return found


@dataclass(frozen=True)
class Model:
    """``odds[l, b]``: probability of bucket ``b`` in language ``languages[l]``."""

    languages: tuple[str, ...]
    odds: np.ndarray


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count the 4-grams of all rows with a text and a language.

    Without such rows the model knows no language. More than ``MAX_LANGUAGES`` is an error.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                owner, bucket = grams(block)
                ends = np.searchsorted(owner, np.arange(block.n), side="right")
                begin = 0
                for i, end in enumerate(ends):
                    name = langs[block.first + i]
                    if name not in held:
                        held[name] = np.zeros(BUCKETS, np.int64)
                    np.add.at(held[name], bucket[begin:end], 1)
                    begin = end
        for name, counts in held.items():
            some = np.flatnonzero(counts)
            some = some if len(some) else np.zeros(1, np.int64)
            columns = [pa.array([name] * len(some)), pa.array(some), pa.array(counts[some])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    counted = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket")
    counted = counted.agg(F.sum("n").alias("n"))
    names = [r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(names)  # code point order
    table = counted.toArrow()
    odds = np.full((len(names), BUCKETS), 0.5)
    place = {name: i for i, name in enumerate(names)}
    which = np.array([place[x] for x in table.column(0).to_pylist()], np.int64)
    np.add.at(odds, (which, table.column(1).to_numpy()), table.column(2).to_numpy())
    odds /= odds.sum(axis=1, keepdims=True) if len(names) else 1
    return Model(tuple(names), odds)


def shares(owner: np.ndarray, bucket: np.ndarray, n: int, odds: np.ndarray) -> np.ndarray:
    """Language shares of ``n`` texts, one row each; a text without 4-grams has zeros.

    Each text's result depends on that text alone.
    """
    k = len(odds)
    pi = np.zeros((n, k))
    if not len(owner) or not k:
        return pi
    key, weight = np.unique(owner.astype(np.int64) * BUCKETS + bucket, return_counts=True)
    owner, bucket, weight = key // BUCKETS, key % BUCKETS, weight / GRAM
    texts, begin = np.unique(owner, return_index=True)
    total = np.add.reduceat(weight, begin)
    single = np.stack([np.add.reduceat(weight * np.log(odds[i][bucket]), begin) for i in range(k)], axis=1)
    best = single.argmax(axis=1)
    weights = np.zeros((len(texts), k))
    weights[np.arange(len(texts)), best] = 1
    reached = single[np.arange(len(texts)), best]
    open_, size = np.arange(len(texts)), np.diff(np.append(begin, len(owner)))
    while len(open_):
        # only the texts that may still gain a language
        row = np.repeat(np.arange(len(open_)), size[open_])
        start = np.concatenate([[0], np.cumsum(size[open_])[:-1]])
        at = np.repeat(begin[open_] - start, size[open_]) + np.arange(len(row))
        w, b, now, n_open = weight[at], bucket[at], weights[open_], total[open_]
        mixed = sum(now[row, i] * odds[i][b] for i in range(k))
        slope = np.stack([np.add.reduceat(w * odds[i][b] / mixed, start) for i in range(k)], axis=1) - n_open[:, None]
        slope[now > 0] = -np.inf
        penalty = 0.5 * np.log(np.maximum(n_open * GRAM, 2))
        add = slope.argmax(axis=1)
        hope = slope[np.arange(len(open_)), add] > penalty  # the gain is never above the slope
        if not hope.any():
            break
        keep = hope[row]
        row, w, b = (np.cumsum(hope) - 1)[row[keep]], w[keep], b[keep]
        open_, now, add, penalty, n_open = open_[hope], now[hope], add[hope], penalty[hope], n_open[hope]
        start = np.searchsorted(row, np.arange(len(open_)))
        now = now * 0.8
        now[np.arange(len(open_)), add] = 0.2
        for _ in range(ROUNDS):
            parts = np.stack([now[row, i] * odds[i][b] for i in range(k)])
            mixed = parts.sum(axis=0)
            now = np.stack([np.add.reduceat(w * parts[i] / mixed, start) for i in range(k)], axis=1) / n_open[:, None]
        mixed = sum(now[row, i] * odds[i][b] for i in range(k))
        now_reached = np.add.reduceat(w * np.log(mixed), start)
        better = now_reached - reached[open_] > penalty
        weights[open_[better]], reached[open_[better]] = now[better], now_reached[better]
        open_ = open_[better & ((now > 0).sum(axis=1) < k)]
    pi[texts] = weights / weights.sum(axis=1, keepdims=True)
    return pi


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out``: ``lang``, ``score`` (its share), ``mixture`` (languages by falling share).

    A text that is null or has no letter gets ``und`` and score 0, as do all texts if the model knows no language.
    Equal shares go to the language lower in code point order. Only the text counts; a column named ``out`` is
    replaced and no other is read.
    """
    kind = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    @arrow_udf("struct<lang:string,score:double,mixture:array<struct<lang:string,share:double>>>")
    def predict(texts: pa.Array) -> pa.Array:
        names, score, mixture = [], [], []
        for block in blocks(texts):
            found = lettered(block)
            pi = shares(*grams(block), block.n, model.odds)
            for some, letter in zip(pi, found, strict=True):
                best = int(some.argmax()) if letter and len(some) else -1
                names.append(model.languages[best] if best >= 0 else UNKNOWN)
                score.append(float(some[best]) if best >= 0 else 0.0)
                by_share = np.argsort(-some, kind="stable") if best >= 0 else []
                mixture.append([{"lang": model.languages[i], "share": float(some[i])} for i in by_share if some[i] > 0])
        arrays = [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(mixture, pa.list_(kind))]
        return pa.StructArray.from_arrays(arrays, ["lang", "score", "mixture"])

    return docs.withColumn(out, predict.asNondeterministic()(F.col(text)))


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of the key as text is a multiple of 5. A null key is held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.where(~F.col("held_out")))
    found = identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), "language.score", "language.mixture")
