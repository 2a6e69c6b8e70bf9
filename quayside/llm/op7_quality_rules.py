"""Quality rules with a suffix array: repetition inside a text, beside plain counts.

Method: the words of each text form a suffix array, built by doubling ranks over a whole block of
texts at once. The longest common prefix of neighbours tells, for every word position, the longest
passage that starts there and also starts elsewhere in the same text; neighbours bound the
longest-common-prefix intervals, whose members are the occurrences of maximal repeats. The union of
the occurrences gives the covered words, the longest one the longest repeat.

Each text is judged alone, so nothing is shuffled. A text must fit one task's memory, at some 150
bytes for each byte of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quayside.llm.blocks import Block, U, blocks, mix, sums

#: The symbols that are counted.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

FIELDS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "n_covered_words": "long", "longest_repeat": "long", "base_failed": "boolean", "kept": "boolean",
}
TYPE = "struct<" + ",".join(f"{k}:{v}" for k, v in FIELDS.items()) + ">"


def longest_repeats(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each word, how many words the longest passage has that starts at it and also starts elsewhere in its text.

    ``words`` are word hashes, ``owner`` the ascending number of each word's text.
    """
    n = len(words)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    last = np.searchsorted(owner, owner, side="right")  # end of each word's text
    order = np.argsort(mix(words + mix(owner.astype(np.uint64) + U(1))), kind="stable")
    key = (words + mix(owner.astype(np.uint64) + U(1)))[order]
    rank = np.empty(n, np.int64)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = group
    levels, step = [rank], 1
    size = np.diff(np.append(np.flatnonzero(new), n))
    active = order[np.repeat(size, size) > 1]  # in order of rank
    while len(active):
        after = active + step
        follow = np.where(after < last[active], rank[np.minimum(after, n - 1)], -1)
        here = rank[active]
        order = np.lexsort((follow, here))
        active, here, follow = active[order], here[order], follow[order]
        new = np.concatenate([[True], (here[1:] != here[:-1]) | (follow[1:] != follow[:-1])])
        begin = np.concatenate([[True], here[1:] != here[:-1]])
        at = np.arange(len(active))
        offset = at - np.maximum.accumulate(np.where(begin, at, 0))
        start = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = here + offset[start]
        levels.append(rank)
        step *= 2
        size = np.diff(np.append(np.flatnonzero(new), len(active)))
        active = active[np.repeat(size, size) > 1]
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    left, right = array[:-1], array[1:]
    near = levels[0][left] == levels[0][right]
    left, right = left[near], right[near]
    common = np.zeros(len(left), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        inside = (a < last[left]) & (b < last[right])
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        # a rank of level j stands for 2^j words only if that many are left
        same = inside & (levels[j][a] == levels[j][b]) & (a + (1 << j) <= last[left]) & (b + (1 << j) <= last[right])
        common += np.where(same, 1 << j, 0)
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeated passage of ``least`` words or more."""
    reach = np.where(longest >= least, np.arange(len(longest)) + longest, 0)
    return np.maximum.accumulate(reach) > np.arange(len(longest)) if len(longest) else np.zeros(0, bool)


def measure(block: Block, least: int) -> dict[str, np.ndarray]:
    starts, ends = block.words()
    owner = block.text_of(starts)
    whole = lambda mark: np.concatenate([[0], np.cumsum(mark)])
    points = whole((block.data & 0xC0) != 0x80)
    symbols = whole(_SYMBOL[block.data])
    longest = longest_repeats(block.hashes(starts, ends), owner)
    line_starts, line_ends = block.lines()
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_owner = block.text_of(line_starts)
    same = block.hashes(line_starts, line_ends) + mix(line_owner.astype(np.uint64) + U(1))
    first = np.zeros(len(same), bool)
    first[np.unique(same, return_index=True)[1]] = True
    top = np.zeros(block.n, np.int64)
    np.maximum.at(top, owner, longest)
    return {
        "n_words": np.bincount(owner, minlength=block.n),
        "word_chars": sums(points[ends] - points[starts], owner, block.n),
        "n_symbols": symbols[block.bounds[1:]] - symbols[block.bounds[:-1]],
        "n_dup_lines": sums(~first, line_owner, block.n),
        "n_repeat_words": sums(covered(longest, 5), owner, block.n),
        "n_covered_words": sums(covered(longest, least), owner, block.n),
        "longest_repeat": top,
    }


def quality(
    docs: DataFrame, text: str = "text", out: str = "quality", least_repeat: int = 10, max_covered_percent: int = 20,
    max_longest: int = 60,
) -> DataFrame:
    """``docs`` with a struct column ``out`` of counts and two verdicts for the whole text.

    ``base_failed``: below 10 words, or over 20 % of the words lie in 5-word windows found twice or more.
    ``kept``: not ``base_failed``, at most ``max_covered_percent`` % of the words lie in repeats of
    ``least_repeat`` words or more, and no repeat has over ``max_longest`` words.

    A null or empty text has no words: all counts are 0, and it fails. Equal rows get equal results. Columns
    of ``docs`` named like a measure are untouched; one named ``out`` is replaced. No rows give no rows.
    """

    @arrow_udf(TYPE)
    def judge(texts: pa.Array) -> pa.Array:
        parts = [measure(b, least_repeat) for b in blocks(texts)]
        got = {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in list(FIELDS)[:7]}
        words = got["n_words"]
        got["base_failed"] = (words < 10) | (100 * got["n_repeat_words"] > 20 * words)
        got["kept"] = (
            ~got["base_failed"]
            & (100 * got["n_covered_words"] <= max_covered_percent * words)
            & (got["longest_repeat"] <= max_longest)
        )
        types = {"long": pa.int64(), "boolean": pa.bool_()}
        return pa.StructArray.from_arrays([pa.array(got[k], types[v]) for k, v in FIELDS.items()], list(FIELDS))

    return docs.withColumn(out, judge.asNondeterministic()(F.col(text)))  # else evaluated again in a filter


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality(docs).select("doc_id", "quality.*").drop("n_covered_words", "longest_repeat")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with their columns."""
    return quality(docs, out="__quality").where("__quality.kept").drop("__quality")
