"""What a worker holds while it goes through texts, and that faster steps give the same numbers."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm import op10_line_dedup as lines
from quayside.llm.blocks import _POINTS, _PRIME, SPACE, Block, U, blocks, mix


def some_texts(n, seed=1):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(500)]
    return [" ".join(words[i] for i in rng.integers(0, 500, 300)) + "\n" + words[int(rng.integers(500))] for _ in range(n)]


def test_lines_are_read_in_blocks_that_stay_in_memory():
    texts = pa.array(some_texts(1000))
    rank = lines.ranks(np.ones(lines.BUCKETS, np.int64))
    tracemalloc.start()
    for block in blocks(texts, lines.SCAN_BYTES):
        lines.Lines(block, rank).bitmaps()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12e6


@pytest.mark.parametrize("n", [1, 63, 64, 65, 200])
def test_faster_steps_give_the_same_numbers(n):
    rng = np.random.default_rng(n)
    texts = ["", "\n\n", " ".join(f"w{i}" for i in range(n)), "a\x0bb\n \nc" * 3, bytes(rng.integers(1, 128, 300).astype(np.uint8)).decode()]
    (block,) = blocks(pa.array(texts))
    starts, ends = block.words()
    assert [tuple(x) for x in block.runs(SPACE[block.data])] == [tuple(starts), tuple(ends)]

    def hashed(data):
        return [sum((int(b) + 1) * pow(p, i, _PRIME) for i, b in enumerate(data)) % _PRIME for p in _POINTS]

    expected = [a << 32 | b for a, b in (hashed(block.data[s:e]) for s, e in zip(starts, ends, strict=True))]
    assert (block.hashes(starts, ends) == mix(np.array(expected, np.uint64))).all()
    made = lines.Lines(Block(block.data, block.bounds, 0), lines.ranks(np.ones(lines.BUCKETS, np.int64)))
    flat, width = made.bitmaps()
    at = 0
    for begin, size, w in zip(made.begin, made.size, width, strict=True):
        bits = 0
        for m in made.mixed[begin : begin + size].tolist():
            bits ^= 1 << (m & (64 * int(w) - 1))
        assert [bits >> 64 * i & (1 << 64) - 1 for i in range(int(w))] == flat[at : at + int(w)].tolist()
        at += int(w)
