"""Line dedup deals rows to targets: what that takes does not grow with rows times targets."""

from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard

from quayside.llm import op10_line_dedup as op10


class _Rows:
    """Stands in for a DataFrame: gives back the function that a task would run."""

    columns = ("pack",)

    def select(self, *names):
        return self

    def mapInArrow(self, run, kind):
        return run


def _sets(n):
    rng = np.random.default_rng(1)
    size = rng.integers(5, 90, n).astype(np.int32)
    node = rng.integers(0, 1 << 62, n).astype(np.uint64)
    similarity = Fraction(op10.SIMILARITY)
    long, width = op10._prefix_size(size.astype(np.int64), similarity), op10._width(size.astype(np.int64))
    prefix = rng.integers(0, 1 << 32, int(long.sum())).astype(np.uint32)
    bits = rng.integers(0, 1 << 62, int(width.sum())).astype(np.uint64)
    columns = [node, np.arange(n, dtype=np.int64), np.zeros(n, np.int32), size, prefix, bits]
    return op10.Sets(columns, similarity), similarity


def test_rows_are_dealt_in_one_go(monkeypatch):
    sets, similarity = _sets(600)
    pack = op10._packed(sets.columns, zstandard.ZstdCompressor(level=1))
    seen, spread = [], op10._spread
    monkeypatch.setattr(op10, "_spread", lambda size, some: seen.append(len(size)) or spread(size, some))
    batch = pa.RecordBatch.from_arrays([pa.array([pack], pa.binary())], ["pack"])
    out = list(op10.dealt(_Rows(), 500, similarity, None)(iter([batch])))
    tool = zstandard.ZstdDecompressor()
    packs = [op10._columns(p, tool) for b in out for p in b.column(1).to_pylist()]
    assert len(packs) > 400 and sum(seen) < 20 * len(sets.prefix)
    # each row has the word, the set and the bitmap that it had
    owner = np.repeat(np.arange(len(sets.n)), sets.long)
    ends = np.cumsum(sets.width)
    want = sorted((int(w), int(o), tuple(sets.bits[ends[o] - sets.width[o] : ends[o]].tolist())) for w, o in zip(sets.prefix, owner, strict=True))
    got = []
    for columns in packs:
        width = op10._width(columns[4].astype(np.int64))
        stop = np.cumsum(width)
        got += [(int(w), int(k), tuple(columns[-1][e - x : e].tolist())) for w, k, e, x in zip(columns[0], columns[5], stop, width, strict=True)]
    assert sorted(got) == want
