"""Benchmark decontamination: exact phrases and near ones of benchmark items, found by a positional inverted index.

Method: the corpus gets a positional index, a posting (term, document, position) for each of its tokens that any item
uses. A window of an item is looked up from its rarest terms: the postings of the rarest one, less the term's place
in the item, give the shifts at which the item could lie in a document; they are intersected with the list of the
second rarest, adjusted by its own place. What is left is compared word by word. One shift serves all windows of an
item, so a long passage is one candidate, not one for each of its windows.

* A window with a term that the corpus lacks is dropped before any list is read.
* Postings lie in segments, one for each task that read documents; only lists that are asked for are shuffled. A hot
  term travels as (document, position) rows, so it is cut like any other skewed join.
* No side is forced to broadcast: vocabulary and windows grow with the benchmark, so Spark decides by written size.

Words are runs of letters, digits and non-ASCII characters; A-Z are lower-cased, nothing else is. Only DataFrame
functions run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.durable import settled

WINDOW = 10
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for a null."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # then Spark's own lower-casing, the faster one, does the same
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


@dataclass(frozen=True)
class Index:
    """``documents`` (row, key, n, words), ``items`` (item, id, n, words), ``terms`` (item, at, n, word, term) and
    ``postings`` (term, row, pos); a row or item number stands for one row of its table, whatever its id."""

    documents: DataFrame
    items: DataFrame
    terms: DataFrame
    postings: DataFrame


def _tokenized(table: DataFrame, key: str, text: str, row: str, name: str) -> DataFrame:
    rows = table.select(F.col(key).alias("key"), words_of(F.col(text)).alias("words"))
    rows = rows.select(F.monotonically_increasing_id().alias(row), "key", F.size("words").cast("long").alias("n"), "words")
    return settled(rows, name)  # the numbers hold from here on


def positional_index(
    docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> Index:
    """The index of ``docs`` over all words that ``bench`` uses. Columns beside the four are not read."""
    documents = _tokenized(docs, key, text, "row", "tokens")
    items = _tokenized(bench, item, item_text, "item", "items").withColumnRenamed("key", "id")
    terms = items.select("item", "n", F.posexplode("words").alias("at", "word")).withColumn("term", F.xxhash64("word"))
    terms = settled(terms, "terms")
    vocabulary = settled(terms.select("word", "term").distinct(), "vocabulary")
    tokens = documents.select("row", F.posexplode("words").alias("pos", "word"))
    postings = settled(tokens.join(vocabulary, "word").select("term", "row", "pos"), "postings")
    return Index(documents, items, terms, postings)


def rarest(index: Index, window: int = WINDOW) -> DataFrame:
    """(item, start, n, rare): each window that the corpus could hold, its terms as (df, at, term), rarest first.

    A window has ``window`` words, or all of a shorter item. ``df`` counts all postings of a term.
    """
    df = index.postings.groupBy("term").agg(F.count("*").alias("df"))
    width = F.least(F.lit(window), F.col("n")).cast("int")
    low, high = F.greatest(F.col("at") - width + 1, F.lit(0)), F.least(F.col("at"), F.col("n").cast("int") - width)
    placed = index.terms.join(df, "term").select(
        "item", width.alias("n"), F.struct("df", "at", "term").alias("t"), F.explode(F.sequence(low, high)).alias("start")
    )
    found = placed.groupBy("item", "start").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("t")).alias("rare"))
    return found.where(F.size("rare") == F.col("n"))


def shifts(index: Index, windows: DataFrame) -> DataFrame:
    """(item, row, shift): where a document's words could be an item's, by the lists of two terms."""
    second = F.get("rare", F.lit(1))
    anchors = windows.select(
        "item", F.col("rare")[0]["at"].alias("at"), F.col("rare")[0]["term"].alias("term"),
        second["at"].alias("at2"), second["term"].alias("term2"),
    ).distinct()
    anchors = settled(anchors, "anchors")
    first = anchors.join(index.postings, "term").select(
        "item", "row", (F.col("pos") - F.col("at")).alias("shift"), "term2", (F.col("pos") - F.col("at") + F.col("at2")).alias("pos2")
    )
    first = settled(first.distinct(), "first")
    # a written list of known size, so that the postings need not be shuffled to be sifted by it
    wanted = settled(anchors.where("term2 is not null").select("term2").distinct(), "second-terms")
    others = index.postings.select(F.col("term").alias("term2"), "row", F.col("pos").alias("pos2")).join(wanted, "term2")
    both = first.join(others, ["term2", "row", "pos2"]).select("item", "row", "shift")
    found = both.unionByName(first.where("term2 is null").select("item", "row", "shift")).distinct()
    return settled(found, "shifts")


def phrase_matches(index: Index, window: int = WINDOW) -> DataFrame:
    """(item, row, from, to, at): maximal runs of a document's words, counted from 0, that are an item's words from
    ``at`` on, and hold one window at least."""
    # texts meet the written shifts first, whose size is known: a few documents' words need no shuffle
    found = index.documents.select("row", "words").join(shifts(index, rarest(index, window)), "row")
    found = found.join(index.items.select("item", "n", F.col("words").alias("want")), "item")
    place = F.sequence(F.lit(0), F.col("n").cast("int") - 1)
    wrong = F.filter(place, lambda i: ~F.get("words", F.col("shift") + i).eqNullSafe(F.get("want", i)))
    found = found.select("item", "row", "shift", "n", wrong.alias("wrong"))
    # a run lies between two neighbouring places that differ
    lows = F.concat(F.array(F.lit(-1)), "wrong")
    highs = F.concat("wrong", F.array(F.col("n").cast("int")))
    runs = F.zip_with(lows, highs, lambda a, b: F.struct((a + 1).alias("low"), (b - 1).alias("high")))
    runs = F.filter(runs, lambda r: r["high"] - r["low"] + 1 >= F.least(F.lit(window), F.col("n")))
    found = found.select("item", "row", "shift", F.explode(runs).alias("r"))
    return found.select(
        "item", "row", (F.col("shift") + F.col("r.low")).alias("from"), (F.col("shift") + F.col("r.high")).alias("to"),
        F.col("r.low").alias("at"),
    )


def proximity_matches(index: Index, within: int, window: int = WINDOW) -> DataFrame:
    """(item, start, row, from): windows whose different words all occur, in any order, among ``within`` words of a
    document from its word ``from`` on, where a word of the window stands; each such place once.

    The postings of the rarest word are looked up; the other lists are intersected with a band around each.
    """
    # ties of df: equal words of a window stand side by side
    windows = rarest(index, window).select("item", "start", F.array_distinct(F.transform("rare", lambda t: t["term"])).alias("terms"))
    windows = windows.withColumn("all", F.size("terms"))
    spots = windows.withColumn("term", F.col("terms")[0]).join(index.postings, "term").withColumnRenamed("pos", "anchor")
    spots = spots.withColumn("term", F.explode("terms")).drop("terms")
    bands = F.sequence(F.floor(F.col("anchor") / within) - 1, F.floor(F.col("anchor") / within) + 1)
    lists = index.postings.withColumn("band", F.floor(F.col("pos") / within))
    near = spots.withColumn("band", F.explode(bands)).join(lists, ["term", "row", "band"])
    near = near.where(F.abs(F.col("pos") - F.col("anchor")) < within)
    near = near.groupBy("item", "start", "row", "anchor", "all").agg(F.collect_set(F.struct("pos", "term")).alias("near"))
    inside = lambda p: F.filter("near", lambda x: (x["pos"] >= p) & (x["pos"] < p + within))
    full = lambda p: F.size(F.array_distinct(F.transform(inside(p), lambda x: x["term"]))) == F.col("all")
    places = F.filter(F.transform("near", lambda x: x["pos"]), lambda p: (p <= F.col("anchor")) & full(p))
    return near.select("item", "start", "row", F.explode(places).alias("from")).distinct()


def contamination(index: Index, window: int = WINDOW) -> DataFrame:
    """(row, n_hit, item_ids): for every document with a match, its words inside one, and the ids of the items as sorted
    text."""
    found = settled(phrase_matches(index, window), "matches")
    spans = found.select("row", "from", "to").distinct()
    order = Window.partitionBy("row").orderBy("from", "to").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("to") - F.greatest(F.col("from") - 1, F.coalesce(F.max("to").over(order), F.lit(-1)))
    hit = spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = found.select("row", "item").distinct().join(index.items.select("item", F.col("id").cast("string").alias("id")), "item")
    ids = named.groupBy("row").agg(F.sort_array(F.collect_set(F.coalesce("id", F.lit("")))).alias("item_ids"))
    return hit.join(ids, "row")


def decontaminate(
    docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``n_words``, ``n_hit``, ``item_ids``.

    ``n_hit`` counts the words inside any occurrence of ``window`` consecutive words of an item; an item of fewer words,
    but not none, is matched whole. ``item_ids``: different ids of items with an occurrence, as text, ascending by byte; a null
    id is the empty string. A null or empty text has no words and no hits; long texts are read whole. Equal rows get
    equal results, rows of one id are judged each; a repeated item counts once if its id repeats. Without items nothing is
    hit; no rows give no rows.
    """
    index = positional_index(docs, bench, key, text, item, item_text)
    found = index.documents.select("row", "key", "n").join(contamination(index, window), "row", "left")
    return found.select(
        F.col("key").alias(key), F.col("n").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def op12_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate(docs, bench).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
