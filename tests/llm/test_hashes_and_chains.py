"""Texts made to make hashes collide, and chains of half similar texts."""

import numpy as np
import pytest

from quayside.llm import op4_jaccard_join as near
from quayside.llm import op6_suffix_dedup as suffix
from quayside.llm import op7_quality_rules as rules
from quayside.llm import op10_line_dedup as lines
from quayside.llm.blocks import Block
from tests.llm.test_corpus_operators import frame


def thue_morse(n, flip=False):
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_spans_made_to_collide(n):
    data = np.frombuffer((thue_morse(n) + thue_morse(n, True)).encode(), np.uint8)
    block = Block(data, np.array([0, len(data)]), 0)
    a, b = block.hashes(np.array([0, n]), np.array([n, 2 * n]))
    assert a != b


def test_hashes_follow_the_bytes_only():
    rng = np.random.default_rng(3)
    word = rng.integers(0, 256, 40).astype(np.uint8)
    data = np.concatenate([rng.integers(0, 256, 70).astype(np.uint8), word, rng.integers(0, 256, 33).astype(np.uint8), word])
    block = Block(data, np.array([0, len(data)]), 0)
    a, b = block.hashes(np.array([70, 143]), np.array([110, 183]))
    (c,) = Block(word, np.array([0, 40]), 0).hashes(np.array([0]), np.array([40]))
    assert a == b == c
    at = np.arange(100)
    assert len(np.unique(block.hashes(at, at + 1))) == len(np.unique(data[:100]))


@pytest.mark.parametrize("n", [1024, 4096])
def test_operators_on_colliding_texts(spark, n):
    a, b = thue_morse(n), thue_morse(n, True)
    two = f"{a}\n{b}"
    found = rules.quality(frame(spark, [two])).first().quality
    assert (found.n_dup_lines, found.longest_repeat, found.n_repeat_words) == (0, 0, 0)
    assert lines.repeated_lines(frame(spark, [two, a])).collect() == [(1, 0)]
    tail = " one two three four"
    assert {r.n_links for r in near.near_duplicates(frame(spark, [a + tail, b + tail])).collect()} == {0}


@pytest.mark.parametrize("n", [1024, 4096])
def test_bytes_of_colliding_texts(spark, tmp_path, n):
    import duckdb

    from checks.compare import differences
    from quayside.llm.oracles import OP6

    a, b = thue_morse(n), thue_morse(n, True)
    frame(spark, [a, b, a + "x" + b]).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(suffix.op6_suffix_dedup(spark, str(tmp_path)), con, OP6) == []


def brute_links(texts, similarity):
    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [grams(t) for t in texts]
    return [sum(len(a & b) * 5 >= 4 * len(a | b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]


def test_a_chain_is_judged_by_bucket(spark, monkeypatch):
    """Each text shares most words with its neighbours only; one group, but few pairs are compared."""
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(words[12 * i : 12 * i + 60]) for i in range(300)]
    texts += [" ".join([*words[:200], f"x{i}"]) for i in range(40)]  # a family, taken as one bucket
    compared = spark.sparkContext.accumulator(0)
    verify = near._verify

    def counting(nodes, copies, part, sets, similarity, across, done=None):
        m = len(nodes)
        compared.add(m * (m - 1) // 2 - (0 if done is None else int(done.sum() - done.trace()) // 2))
        return verify(nodes, copies, part, sets, similarity, across, done)

    monkeypatch.setattr(near, "_verify", counting)
    got = {r.doc_id: r.n_links for r in near.near_duplicates(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_links(texts, 0.8)


def test_buckets_with_the_same_nodes_are_one(spark):
    rows = [(1, [10, 11, 12]), (2, [10, 11, 13]), (3, [14, 15, 13]), (4, [16, 17, 18])]
    nodes = spark.createDataFrame(rows, "node long, bands array<long>")
    met = {}
    for r in near.meetings(nodes).collect():
        met.setdefault(r.bucket, set()).add(r.node)
    assert sorted(map(sorted, met.values())) == [[1, 2], [2, 3]]


def test_hash_tables_do_not_pile_up():
    """Blocks of many sizes leave one table for each point, and a long text none."""
    import tracemalloc

    tracemalloc.start()
    try:
        for bits in (17, 18, 19, 20, 22):
            data = np.full(1 << bits, 97, np.uint8)
            Block(data, np.array([0, len(data)]), 0).hashes(np.array([0]), np.array([len(data)]))
            del data
        assert tracemalloc.get_traced_memory()[0] < 40 << 20
    finally:
        tracemalloc.stop()


def test_steps_leave_no_shuffle_files(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join([*words[5 * i : 5 * i + 200], f"x{k}"]) for i in range(4) for k in range(3)]
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    docs = frame(spark, texts)
    before = disk.getAllFiles().size()
    found = near.near_duplicates(docs)
    left = disk.getAllFiles().size() - before
    assert left < 10, left  # 48 if Spark keeps them
    assert min(r.n_links for r in found.collect()) >= 2
