"""Document fingerprints by winnowing.

Method: hashes of all runs of ``GRAM`` words roll over the text; of every ``WINDOW`` neighbouring hashes the
least is kept, rightmost of ties, with its position. Two texts that share ``GRAM`` + ``WINDOW`` - 1 words in a
row share a hash. Words are runs of anything but space and 0x09-0x0D.

Only DataFrame functions run. A hash has 36 bits and shares a long with 27 bits of position, stored falling so
that the least long is the rightmost of equal hashes; a text may have 2^27 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, WINDOW = 5, 16
_PLACES = (1 << 27) - 1
MAX_RANGES = 1000


def winnowed(rows: DataFrame, text: str, out: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``rows`` with the kept (hash, position) longs of ``text`` as an array ``out``, in order of position.

    A text of fewer than ``gram`` words has one hash of all its words; one without words, or null, has none.
    Equal texts have equal results.
    """
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = rows.withColumn("__words", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("__words")
    hashed = lambda i: F.xxhash64(*[F.get("__words", i + j) for j in range(gram)])
    packed = lambda i: (hashed(i).bitwiseAND((1 << 36) - 1) * (1 << 27)) + (F.lit(_PLACES) - i)
    rows = rows.withColumn(
        "__grams",
        F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - gram, F.lit(0))), packed)).otherwise(F.array().cast("array<long>")),
    )
    m = F.size("__grams")
    least = lambda i: F.array_min(F.slice("__grams", i, window))
    kept = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(m - (window - 1), F.lit(1))), least))
    return rows.withColumn(out, F.when(m > 0, kept).otherwise(F.array().cast("array<long>"))).drop("__words", "__grams")


def shown(kept: Column) -> Column:
    """``hash:position`` of each kept hash, as text."""
    return F.array_join(
        F.transform(kept, lambda x: F.concat_ws(":", F.hex(F.shiftright(x, 27)), F.lit(_PLACES) - x.bitwiseAND(_PLACES))), " "
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; 1 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, F.lit(1.0)).otherwise(common / either)


def _hashes(kept: Column) -> Column:
    return F.array_distinct(F.transform(kept, lambda x: F.shiftright(x, 27)))


def with_next(rows: DataFrame, key: str, text: str, columns: list[str]) -> DataFrame:
    """``rows`` with a struct ``next`` of ``columns`` of the row after it, by (key, text), nulls first; the last is followed
    by the first.

    Rows are cut at quantiles of the key into ranges; a range is one window, and its last row takes the first row of the
    range after it. At most ``MAX_RANGES`` keys reach the driver.
    """
    ranges = min(MAX_RANGES, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx(key, shares, 10 * MAX_RANGES)).first()[0] or []
    cuts = sorted(set(cuts))
    below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(key))) if cuts else F.lit(0)
    at = F.when(F.col(key).isNull(), -1).otherwise(below).cast("int")
    lows = sorted(rows.groupBy(at.alias("at")).agg(F.min(key)).collect(), key=lambda r: r[0])
    after = [(r[0], lows[(i + 1) % len(lows)][0]) for i, r in enumerate(lows)]
    known = [r[1] for r in lows if r[1] is not None]
    first = rows.where(F.col(key).isin(known) | F.col(key).isNull()) if known else rows
    place = F.struct(F.col(key).isNotNull().alias("some"), F.col(key).alias("key"), F.col(text).alias("text"), F.struct(*columns).alias("row"))
    first = first.groupBy(at.alias("to")).agg(F.min(place)["row"].alias("__first"))
    before = F.create_map(*[F.lit(x) for a, to in after for x in (to, a)]) if after else F.create_map(F.lit(0), F.lit(0))
    first = first.select(F.element_at(before, F.col("to")).alias("__at"), "__first")
    order = Window.partitionBy("__at").orderBy(key, text)
    rows = rows.withColumn("__at", at).withColumn("__next", F.lead(F.struct(*columns)).over(order))
    rows = rows.join(first, "__at")
    return rows.withColumn("next", F.coalesce("__next", "__first")).drop("__at", "__next", "__first")


def op9_winnowing(spark, sf_dir: str) -> DataFrame:
    """Each text's fingerprint beside that of its edited text and the next document's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(winnowed(docs, "text", "kept"), "doc_id", "text", ["text", "kept"])
    n = F.char_length("text")
    rows = rows.withColumn("n_chars", n).withColumn("cut", F.floor(F.col("n_chars") / 4).cast("int"))
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars") - F.col("cut")), F.substr("next.text", F.lit(1), F.col("cut")))
    rows = rows.select("doc_id", "kept", F.col("next.kept").alias("next_kept"), "n_chars", edited.alias("edited"))
    rows = winnowed(rows, "edited", "edited_kept")
    rows = rows.withColumns({"h": _hashes(F.col("kept")), "eh": _hashes(F.col("edited_kept")), "nh": _hashes(F.col("next_kept"))})
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        shown(F.col("kept")).alias("fingerprint"), shown(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("h"), F.col("eh")).alias("near_edited"), likeness(F.col("h"), F.col("nh")).alias("near_next"),
    )
