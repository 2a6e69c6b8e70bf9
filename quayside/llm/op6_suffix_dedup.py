"""Suffix dedup: remove every byte covered by a passage that also starts anywhere else.

Method: suffixes are range-partitioned by sampled splitters on their leading bytes, each range is sorted by
one task, and ranges that share a leading token are compared across their boundary. All suffixes of 100 TB
would be shuffled with ``LENGTH`` bytes each, so the suffix array is sparse: it holds one suffix, its anchor,
for each run of neighbouring windows. A window is ``LENGTH`` bytes; its anchor is the position of its least
hashed ``GRAM``-byte gram, rightmost of ties. Equal windows have their anchor at the same place, so they meet
in the range of its leading bytes, and no window is missed.

1. A run is halved: a window holds at least ``(LENGTH - GRAM) / 2`` bytes after its gram or before it. So each half has a
   longer string in common, the gram with that side. Its order key is the leading bytes and that string's
   hash. Ranges are sorted by it and by a hash of all bytes. Equal halves cover all their bytes. Those whose
   string occurs once are dropped here, so a short line that is everywhere stays cheap.
2. Only the different runs of an anchor send their bytes; their windows are sorted and neighbours compared.
3. A hot anchor, whose splitter repeats, is dealt over several ranges; so is one that a task can't hold. There
   each range also gives one window of each kind, and these meet by their hash across the boundaries.

Windows are compared by 64-bit hashes together with their anchor's 64-bit hash and place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.durable import settled
from quayside.llm.blocks import Block, U, blocks, mix
from quayside.llm.texts import released, small_batches, unpacked

LENGTH, GRAM = 200, 32
SAMPLE_TEXTS = 2000
HELD_ROWS, HELD_BYTES = 1 << 18, 1 << 20
#: Bytes of text handled at once; a window takes some 100 bytes of memory.
SCAN_BYTES = 1 << 18
#: Texts cut at once.
CUT_ROWS = 256
_LOW = U(0xFFFFFFFF)


def runs(block: Block, length: int, gram: int) -> dict[str, np.ndarray]:
    """Half runs of neighbouring windows with one anchor: ``text``, ``start``, ``n`` windows, ``off`` of the anchor,
    ``order`` (4 leading bytes and the hash of the common string), ``anchor`` and ``all`` (hashes of that string and of
    the whole half)."""
    n, width = len(block.data), length - gram + 1
    empty = np.zeros(0, np.int64)
    if n < length:
        return {k: empty if k in ("text", "start", "n", "off") else empty.view(np.uint64) for k in ("text", "start", "n", "off", "order", "anchor", "all")}
    at = np.arange(n - gram + 1)
    value = (block.hashes(at, at + gram) & ~_LOW) | (_LOW - at.astype(np.uint64))
    padded = np.full(-(-len(value) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(value)] = value
    cells = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(cells, axis=1).reshape(-1)
    starts = np.arange(n - length + 1)
    anchor = (_LOW - (np.minimum(ahead[starts], behind[starts + width - 1]) & _LOW)).astype(np.int64)
    text = np.repeat(np.arange(block.n), np.diff(block.bounds))[starts]
    valid = starts + length <= block.bounds[1:][text]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    stop = np.flatnonzero(valid & np.concatenate([new[1:] | ~valid[1:], [True]])) + 1
    anchor = anchor[begin]
    reach = (length - gram) // 2
    middle = np.clip(anchor - reach, begin, stop)  # windows from here have the gram and ``reach`` bytes after it
    begin, stop = np.stack([begin, middle], axis=1).reshape(-1), np.stack([middle, stop], axis=1).reshape(-1)
    some = np.flatnonzero(begin < stop)
    begin, stop, anchor, after = begin[some], stop[some], anchor[some >> 1], (some & 1).astype(bool)
    text = text[begin]
    low = np.where(after, anchor, anchor - reach - 1)
    hashed = block.hashes(low, np.where(after, anchor + gram + reach, anchor + gram))
    lead = sum(block.data[low + i].astype(np.uint64) << U(56 - 8 * i) for i in range(4))
    off = anchor - begin
    whole = mix(block.hashes(begin, stop + length - 1) + off.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    return {
        "text": text, "start": begin - block.bounds[text], "n": stop - begin, "off": off,
        "order": lead | hashed >> U(32), "anchor": hashed, "all": whole,
    }


def splitters(docs: DataFrame, text: str, parts: int, length: int, gram: int) -> np.ndarray:
    """Order keys that cut the suffixes into ``parts`` like ranges, from a sample of ``SAMPLE_TEXTS`` texts, or of some for
    each range if those are more.

    They decide who sorts what, not what is found.
    """

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(0), SCAN_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array(runs(block, length, gram)["order"].view(np.int64))], ["order"])

    total = docs.count()
    some = docs.select(text).sample(min(1.0, max(SAMPLE_TEXTS, 4 * parts) / max(total, 1)), seed=6).where(F.col(text).isNotNull())
    keys = some.mapInArrow(released(run), "order long").toArrow().column(0).to_numpy().view(np.uint64)
    keys = np.sort(keys)
    return keys[(np.arange(1, parts) * len(keys)) // parts] if len(keys) else keys


def deal(order: np.ndarray, salt: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of each suffix, and whether its leading token is dealt over several ranges."""
    low, high = np.searchsorted(cuts, order, side="left"), np.searchsorted(cuts, order, side="right")
    hot = high - low > 1
    spread = low + (salt % np.maximum(high - low + 1, 1).astype(np.uint64)).astype(np.int64)
    return np.where(hot, spread, high), hot


def _identity(block: Block) -> np.ndarray:
    """Tells texts of one key apart."""
    return (block.hashes(block.bounds[:-1], block.bounds[1:]) >> U(32)).astype(np.uint32).view(np.int32)


def suffixes(docs: DataFrame, key: str, text: str, cuts: np.ndarray, length: int, gram: int) -> DataFrame:
    """One row for each anchor; ``at`` packs start, windows and offset."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            for block in blocks(batch.column(1), SCAN_BYTES):
                got = runs(block, length, gram)
                bucket, hot = deal(got["order"], mix(got["all"] + got["start"].astype(np.uint64) + U(block.first)), cuts)
                columns = [
                    pa.array((bucket << 1 | hot).astype(np.int32)), pa.array(got["anchor"].view(np.int64)),
                    pa.array(got["all"].view(np.int64)), keys.take(pa.array(block.first + got["text"])),
                    pa.array(_identity(block)[got["text"]]), pa.array(got["start"] << 16 | got["n"] << 8 | got["off"]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "anchor", "whole", "key", "tid", "at"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"bucket int, anchor long, whole long, key {kind}, tid int, at long")


def _whole_groups(batches, columns, limit):
    """Tables of whole groups of equal ``columns``, and whether the group had to be cut for memory."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows if limit == HELD_ROWS else batch.nbytes
        if size < limit:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        same = np.ones(table.num_rows, bool)
        for c in columns:
            x = table.column(c).to_numpy()
            same &= x == x[-1]
        last = int(np.flatnonzero(same)[0])
        if last:
            yield table.slice(0, last).combine_chunks(), False
            held = table.slice(last).combine_chunks().to_batches()
        else:  # one group fills the memory: what is left goes across the boundary
            yield table, True
            held = []
        size = sum(b.num_rows if limit == HELD_ROWS else b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks(), False


def _groups_cut(batches, columns, limit):
    """As above; all pieces of a group that was cut are marked, its last one included."""
    mark = None
    for table, cut in _whole_groups(batches, columns, limit):
        head = tuple(table.column(c)[0].as_py() for c in columns)
        again = np.zeros(table.num_rows, bool)
        if mark == head:
            same = np.ones(table.num_rows, bool)
            for c, v in zip(columns, head, strict=True):
                same &= table.column(c).to_numpy() == v
            again = same
        mark = head if cut else None
        yield table, again | cut


def sorted_ranges(rows: DataFrame, length: int) -> DataFrame:
    """Passages (key, tid, begin, end) that equal runs cover, and the runs that must still be compared (bucket not null)."""

    def run(batches):
        for table, cut in _groups_cut(batches, ["bucket", "anchor"], HELD_ROWS):
            bucket, anchor, whole, at = (table.column(c).to_numpy() for c in ("bucket", "anchor", "whole", "at"))
            size = len(at)
            new_a = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (bucket[1:] != bucket[:-1])])
            new_c = new_a | np.concatenate([[True], whole[1:] != whole[:-1]])
            first = np.flatnonzero(new_c)
            times = np.diff(np.append(first, size))
            kinds = np.add.reduceat(new_c.astype(np.int64), np.flatnonzero(new_a))[np.cumsum(new_a) - 1]
            again = np.repeat(times, times) > 1
            hot = (bucket & 1).astype(bool) | cut
            compare = new_c & ((kinds > 1) | hot)
            covered, asked = np.flatnonzero(again), np.flatnonzero(compare)
            start, n = at >> 16, at >> 8 & 255
            nothing = np.full(len(covered), -1)
            columns = [
                table.column("key").take(pa.array(np.concatenate([covered, asked]))).combine_chunks(),
                table.column("tid").take(pa.array(np.concatenate([covered, asked]))).combine_chunks(),
                pa.array(np.concatenate([start[covered], at[asked]])),
                pa.array(np.concatenate([(start + n + length - 1)[covered], anchor[asked]])),
                pa.array(np.concatenate([nothing, bucket[asked]]).astype(np.int32)),
                pa.array(np.concatenate([nothing, again[asked] << 1 | hot[asked]]).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "tid", "begin", "end", "bucket", "flags"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"key {kind}, tid int, begin long, end long, bucket int, flags int")


def _packs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, tid, pack, n_bytes)"""
    import zstandard

    def run(batches):
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.binary())
            tid = [_identity(b) for b in blocks(texts)]
            packs = pa.array([tool.compress(t) for t in texts.to_pylist()], pa.binary())
            tid = pa.array(np.concatenate(tid) if tid else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), tid, packs], ["key", "tid", "pack"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(released(run), f"key {rows.schema['key'].dataType.simpleString()}, tid int, pack binary")


def passages(asked: DataFrame, docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """The runs to compare with their bytes."""

    def run(batches):
        names = ["bucket", "anchor", "key", "tid", "at", "flags", "bytes"]
        for batch in batches:
            wanted = batch.column("wanted")
            sizes = np.diff(wanted.offsets.to_numpy())
            flat = wanted.flatten()
            at = flat.field("at").to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            texts = unpacked(batch.column("pack"))
            _, offsets, data = texts.buffers()
            offsets = np.frombuffer(offsets, np.int64)
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            long = (at >> 8 & 255) + length - 1
            for low in range(0, len(at), 4096):
                part = slice(low, low + 4096)
                ends = np.cumsum(long[part])
                source = np.repeat(offsets[owner[part]] + (at[part] >> 16) - (ends - long[part]), long[part]) + np.arange(ends[-1])
                cut = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(data[source])]
                )
                rows = pa.array(owner[part])
                columns = [
                    flat.field("bucket").slice(low, 4096), flat.field("anchor").slice(low, 4096), batch.column("key").take(rows),
                    batch.column("tid").take(rows), flat.field("at").slice(low, 4096), flat.field("flags").slice(low, 4096), cut.cast(pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    wanted = asked.groupBy("key", "tid").agg(
        F.collect_list(F.struct("bucket", F.col("end").alias("anchor"), F.col("begin").alias("at"), "flags")).alias("wanted")
    )  # as many as a text has anchors
    texts = _packs(docs, key, text).dropDuplicates(["key", "tid"])
    same = F.col("k").eqNullSafe(F.col("key")) & (F.col("t") == F.col("tid"))
    both = wanted.select(F.col("key").alias("k"), F.col("tid").alias("t"), "wanted").join(texts, same)
    kind = docs.schema[key].dataType.simpleString()
    return both.select("key", "tid", "wanted", "pack").mapInArrow(
        released(run), f"bucket int, anchor long, key {kind}, tid int, at long, flags int, bytes binary"
    )


def compared(rows: DataFrame, length: int) -> DataFrame:
    """(key, tid, begin, end, window): covered passages, and where ``window`` is not null, one window of each kind in a range."""

    def solve(table: pa.Table, cut: np.ndarray):
        block = Block(*_flat(table.column("bytes")))
        at, bucket = table.column("at").to_numpy(), table.column("bucket").to_numpy()
        anchor = table.column("anchor").to_numpy().view(np.uint64)
        n = at >> 8 & 255
        row = np.repeat(np.arange(len(at)), n)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        begin = block.bounds[:-1][row] + inside
        place = ((at & 255)[row] - inside).astype(np.uint64)  # of the anchor in the window
        window = mix(block.hashes(begin, begin + length) + mix(anchor[row] + place))
        key = mix(window + bucket[row].astype(np.uint64) * U(0xD6E8FEB86659FD93))  # a range judges its own
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        times = np.diff(np.append(np.flatnonzero(new), len(order)))
        again = np.zeros(len(order), bool)
        again[order] = np.repeat(times, times) > 1
        flags = table.column("flags").to_numpy()
        decided = (flags >> 1).astype(bool)
        begin_at = (at >> 16)[row] + inside
        flag = again & ~decided[row]
        edge = np.flatnonzero(flag)
        starts = edge[np.concatenate([[True], (edge[1:] != edge[:-1] + 1) | (row[edge[1:]] != row[edge[:-1]])])] if len(edge) else edge
        stops = edge[np.concatenate([(edge[1:] != edge[:-1] + 1) | (row[edge[1:]] != row[edge[:-1]]), [True]])] if len(edge) else edge
        hot = (flags & 1).astype(bool) | cut
        one = order[new]
        one = one[hot[row[one]]]
        rows = pa.array(row[np.concatenate([starts, one])])
        columns = [
            table.column("key").take(rows).combine_chunks(), table.column("tid").take(rows).combine_chunks(),
            pa.array(np.concatenate([begin_at[starts], begin_at[one]])),
            pa.array(np.concatenate([begin_at[stops], begin_at[one]]) + length),
            pa.array(np.concatenate([np.zeros(len(starts), np.int64), window[one].view(np.int64)]),
                     mask=np.arange(len(rows)) < len(starts)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "tid", "begin", "end", "window"])

    def run(batches):
        for table, cut in _groups_cut(batches, ["bucket", "anchor"], HELD_BYTES):
            yield solve(table, cut)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"key {kind}, tid int, begin long, end long, window long")


def _flat(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    bounds = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0], 0


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, tid, begin, end): byte ranges, overlapping or not, that ``length``-byte strings found elsewhere cover.

    Texts are UTF-8 bytes; a null is empty. Matches never cross texts, may overlap in one, and are judged on the
    input. ``tid`` tells rows of one key with different texts apart; equal rows share their spans, and each is the
    other's copy. Columns beside the two are not read. ``length`` is ``gram`` + 223 at most.
    """
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = splitters(docs, text, parts, length, gram)
    rows = suffixes(docs, key, text, cuts, length, gram).repartitionById(parts, F.shiftright("bucket", 1))
    rows = rows.sortWithinPartitions("bucket", "anchor", "whole")
    with small_batches(docs.sparkSession):
        found = settled(sorted_ranges(rows, length), "ranges")
    asked = found.where("bucket >= 0")
    ranges = passages(asked, docs, key, text, length).repartitionById(parts, F.shiftright("bucket", 1))
    ranges = ranges.sortWithinPartitions("bucket", "anchor")
    with small_batches(docs.sparkSession):
        windows = settled(compared(ranges, length), "windows")
    across = windows.where("window is not null").groupBy("window").agg(F.collect_list(F.struct("key", "tid", "begin", "end")).alias("w"))
    across = across.where(F.size("w") > 1).select(F.explode("w").alias("w")).select("w.*")  # one of each range at most
    return (
        found.where("bucket < 0").drop("bucket", "flags")
        .unionByName(windows.where("window is null").drop("window")).unionByName(across)
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the remaining bytes).

    See ``repeated_spans``; a null text counts as empty.
    """

    def without(rows: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds, _ = _flat(unpacked(rows.column("pack")))
        spans = rows.column("spans")
        sizes = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        owner, flat = np.repeat(np.arange(len(sizes)), sizes), spans.flatten()
        begin, end = (bounds[owner] + flat.field(n).to_numpy() for n in ("begin", "end"))
        order = np.lexsort((begin, owner))
        owner, begin, reach = owner[order], begin[order], np.maximum.accumulate(end[order])
        new = np.ones(len(owner), bool)  # a span that touches the one before is one run with it, if their text is one
        new[1:] = (begin[1:] > reach[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        begin, end = begin[first], reach[np.append(first[1:], len(owner))[: len(first)] - 1]
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, begin, 1)
        np.add.at(edge, end, -1)
        stays = np.cumsum(edge[:-1], dtype=np.int32) == 0
        left = np.concatenate([[0], np.cumsum(stays)])[bounds]
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(np.ascontiguousarray(left)), pa.py_buffer(data[stays])]
        )
        size = np.diff(bounds)
        count = np.bincount(owner[first], minlength=len(sizes))
        columns = [rows.column("key"), pa.array(size), pa.array(size - np.diff(left)), pa.array(count), kept.cast(pa.binary())]
        return pa.RecordBatch.from_arrays(columns, [key, "n_bytes", "n_removed", "n_spans", "kept"])

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, CUT_ROWS):
                yield without(batch.slice(low, CUT_ROWS))

    spans = repeated_spans(docs, key, text, length, gram).groupBy("key", "tid")
    spans = spans.agg(F.collect_list(F.struct("begin", "end")).alias("spans"))  # as many as a text has anchors
    spans = spans.select(F.col("key").alias("k"), F.col("tid").alias("t"), "spans")
    same = F.col("k").eqNullSafe(F.col("key")) & (F.col("t") == F.col("tid"))
    rows = _packs(docs, key, text).join(spans, same, "left").select("key", "spans", "pack")
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(released(run), f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
