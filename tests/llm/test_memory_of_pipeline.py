"""What the workers of the pipeline hold."""

import numpy as np
import pyarrow as pa

import corpus_pipeline
from quayside.llm import op2_sentencepiece as pieces
from quayside.llm.blocks import U, mix
from quayside.llm.texts import BATCH_ROWS
from tests.llm.test_memory_of_blocks import some_texts


def test_pieces_are_drawn_in_blocks_that_fit():
    texts = some_texts(600)
    tool = pieces.Sampler(pieces.vocabulary(), pieces.THETA, pieces.SEED)
    seeds = mix(np.arange(len(texts)).astype(U))
    whole = tool.encode(texts, seeds)
    size = np.cumsum([len(t) for t in texts])
    parts, at = [], 0
    while at < len(texts):
        last = int(np.searchsorted(size, (size[at - 1] if at else 0) + pieces.BLOCK_CHARS)) + 1
        parts += tool.encode(texts[at:last], seeds[at:last])
        at = last
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert pieces.BLOCK_CHARS <= 1 << 17


def test_the_pipeline_hands_small_batches_to_python(spark, tmp_path, monkeypatch):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    spark.range(3 * BATCH_ROWS).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", lambda s, docs, d: docs.mapInArrow(sizes, "n long"))])
    assert max(r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) <= BATCH_ROWS


def test_a_block_of_pieces_takes_little_memory():
    import tracemalloc

    texts = some_texts(600)
    size = np.cumsum([len(t) for t in texts])
    assert size[-1] > 1 << 17
    block = texts[: int(np.searchsorted(size, pieces.BLOCK_CHARS)) + 1]
    tool = pieces.Sampler(pieces.vocabulary(), pieces.THETA, pieces.SEED)
    tracemalloc.start()
    try:
        tool.encode(block, mix(np.arange(len(block)).astype(U)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 3 << 20, peak  # 4.8 MB with blocks of four times as many characters


def test_an_encoded_block_is_freed_without_the_garbage_collector():
    import gc
    import tracemalloc

    tool = pieces.Sampler(pieces.vocabulary(), pieces.THETA, pieces.SEED)
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        for k in range(10):
            tool.encode([" ".join(f"w{i}x{k}" for i in range(5000))], np.array([k], U))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
        gc.enable()
    assert held < 1 << 20, held  # with the index in a cycle, all words of the ten blocks
