"""Joins, dedups, mixing, URL rules and fingerprints against brute force, with awkward rows."""

import collections
import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from quayside.llm import op4_jaccard_join as near
from quayside.llm import op5_source_mix as mixing
from quayside.llm import op6_suffix_dedup as suffix
from quayside.llm import op8_url_rules as urls
from quayside.llm import op9_winnowing as winnow
from quayside.llm import op10_line_dedup as lines
from quayside.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class_id string, node string, key string"


def frame(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{i % 3}" for i in range(len(texts))] if sources is None else sources
    rows = [(i, t, "en", s, len(t or ""), "own", "own", "own") for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(seed=5, n=60):
    """Texts with copies, near copies and shared passages."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}é" for i in range(400)]
    texts = []
    for _ in range(n):
        kind = rng.integers(0, 6) if texts else 0
        if kind < 2:
            t = "\n".join(" ".join(rng.choice(words, rng.integers(1, 25))) for _ in range(rng.integers(1, 6)))
        elif kind == 2:
            t = texts[rng.integers(len(texts))]
        else:
            parts = (texts[rng.integers(len(texts))] or "x").split(" ")
            for _ in range(rng.integers(1, 3)):
                parts[rng.integers(len(parts))] = str(rng.choice(words))
            t = " ".join(parts)
        texts.append(t)
    texts += [None, "", " \n ", "a", "a b c", "a b c", "long " * 5000, texts[0] + " " + texts[0]]
    return texts


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_sql_twins(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert differences(queries.queries()[name](spark, sf_dir), con, queries.oracle_sql()[name]) == []


# n-gram Jaccard join


def test_bands_reach_the_recall():
    b = near.bands_for(0.8, 0.9999, 5)
    assert 1 - (1 - 0.8**5) ** b >= 0.9999 > 1 - (1 - 0.8**5) ** (b - 1)


def links_of(texts):
    def grams(t):
        w = (t or "").encode().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [grams(t) for t in texts]
    linked = lambda a, b: bool(a) and bool(b) and 5 * len(a & b) >= 4 * len(a | b)
    return [[j for j in range(len(sets)) if j != i and linked(sets[i], sets[j])] for i in range(len(sets))]


@pytest.mark.parametrize("block", [256, 2])
def test_links_and_classes(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK_TEXTS", block)  # groups cut into blocks give the same
    texts = corpus()
    links = links_of(texts)
    label = list(range(len(texts)))
    for _ in label:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(label))]
    got = {r.doc_id: r for r in near.near_duplicates(frame(spark, texts)).collect()}
    assert [got[i].n_links for i in range(len(texts))] == [len(x) for x in links]
    assert [got[i].class_id for i in range(len(texts))] == label
    assert {i for i in got if got[i].keeper} == {i for i in range(len(texts)) if label[i] == i}


def test_near_stage_with_odd_ids(spark):
    text = " ".join(f"x{i}" for i in range(30))
    docs = frame(spark, [text, text, "other words of its own here", None, "", text, "null id one here"], [5, 5, 7, 8, 9, 6, None])
    kept = near.stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 5), (False, 7), (False, 8), (False, 9), (True, 0)]
    assert near.near_duplicates(docs.limit(0)).count() == 0


# mixing


@pytest.mark.parametrize("doc_id", [7, None])
def test_texts_of_one_id_are_read_once(spark, monkeypatch, doc_id):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words, f"x{i}"]) for i in range(40)] * 2
    read, verifier = spark.sparkContext.accumulator(0), near._verifier

    def counting(*given):
        run = verifier(*given)

        def counted(batches):
            def seen():
                for batch in batches:
                    read.add(batch.num_rows)
                    yield batch

            yield from run(seen())

        return counted

    monkeypatch.setattr(near, "_verifier", counting)
    docs = frame(spark, texts, ids=[doc_id] * len(texts))
    assert {r.n_links for r in near.near_duplicates(docs).collect()} == {79}
    assert read.value == 40


def test_targets_stop_and_share_again():
    got = mixing.targets({"a": 10, "b": 100, "c": 100}, {"a": 5, "b": 2, "c": 1}, 150, 2)
    assert got["a"] == 20 and abs(got["b"] - 130 * 2 / 3) < 1e-9 and abs(sum(got.values()) - 150) < 1e-9


def test_flow_spreads_before_it_repeats():
    flow = mixing.route({("a",): 10, ("a", "b"): 10, ("b",): 30}, {"a": 25, "b": 20}, 2)
    assert sum(f["a"] for f in flow.values() if "a" in f) == 25 and sum(f.get("b", 0) for f in flow.values()) == 20
    used = {p: sum(f.values()) for p, f in flow.items()}
    assert sum(max(0, used[p] - n) for p, n in ((("a",), 10), (("a", "b"), 10))) == 5  # only as much as must be


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(["w"] * int(n)) for n in rng.integers(1, 60, 400)] + [None, "", " "]
    sources = [["s0", "s1", "s2", None][i % 4] for i in range(len(texts))]
    docs = frame(spark, texts, sources=sources)

    def taken(df):
        m = mixing.mixture(df)
        return {r.key: r["__copies"] * r["__size"] for r in mixing.copies(m.sized, m.plan).collect()}, m

    got, m = taken(docs)
    target = {r.source: (r.target, r.source_size) for r in m.sources.collect()}
    assert list(target) == ["s0", "s1", "s2", None]
    total = sum(len((t or "").split()) for t in texts)
    assert abs(sum(t for t, _ in target.values()) - 1.5 * total) < 1e-6 and all(t <= 2 * s for t, s in target.values())
    for s in target:
        ours = sum(got[i] for i in got if sources[i] == s)
        assert abs(ours - target[s][0]) <= 31
    assert all(got[i] <= 2 * len((texts[i] or "").split()) for i in got)
    assert taken(docs.repartition(5))[0] == got
    rows = mixing.stage(spark, docs, "")
    assert rows.columns == docs.columns
    assert collections.Counter(r.doc_id for r in rows.collect()) == {i: n // len(texts[i].split()) for i, n in got.items() if n}
    assert mixing.mixture(docs.limit(0)).sized.count() == 0


def test_sources_with_control_characters_stay(spark):
    names = ["a\x0b", "\x1b", "\x7f\u2028", "a\x00", 'q"\\/', "é🙂", "plain", "", None]
    docs = frame(spark, ["one two three", "four"] * len(names), sources=[n for n in names for _ in range(2)])
    m = mixing.mixture(docs)
    rows = mixing.copies(m.sized, m.plan)
    assert rows.count() == docs.count() and {r.source for r in m.sources.collect()} == set(names)
    assert m.routes.join(m.plan, F.col("pattern") == F.col("__pattern")).count() == len(names)
    taken = collections.Counter()
    for r in mixing.stage(spark, docs, "").collect():
        taken[r.source] += len(r.text.split())
    assert all(abs(taken[r.source] - r.target) <= 3 for r in m.sources.collect())


def test_overlapping_sources(spark):
    docs = frame(spark, ["a b c"] * 6).withColumn("sources", F.expr("CASE WHEN doc_id < 2 THEN array('x') WHEN doc_id < 4 THEN array('x','y') ELSE array('y') END"))
    m = mixing.mixture(docs, members=F.col("sources"))
    routed = m.routes.groupBy("source").agg(F.sum("words")).collect()
    assert sum(r[1] for r in routed) == sum(round(r.target) for r in m.sources.collect())


# suffix dedup


def covered(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        mark = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i + 1 : i + 1 + length] = True
        inside = mark[1:-1] if len(b) else mark[:0]
        out.append((len(b), int(inside.sum()), int((mark[1:] & ~mark[:-1]).sum()), bytes(x for x, m in zip(b, inside, strict=True) if not m)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_repeated_bytes(spark, monkeypatch, small):
    if small:  # every token hot, tasks that can hold little: all goes across the boundaries
        monkeypatch.setattr(suffix, "deal", lambda order, salt, cuts: ((salt % np.uint64(4)).astype(np.int64), np.ones(len(order), bool)))
        monkeypatch.setattr(suffix, "HELD_ROWS", 50)
        monkeypatch.setattr(suffix, "HELD_BYTES", 2000)
    texts = [*corpus(7, 40), "z" * 700, "q" * 199, "é" * 150, "q" * 199]
    got = {r.doc_id: r for r in suffix.remove_repeats(frame(spark, texts)).collect()}
    want = covered(texts, 200)
    assert [(got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) for i in range(len(texts))] == want


def test_repeated_bytes_with_odd_ids(spark):
    text = "".join(f"{i} " for i in range(100))
    docs = frame(spark, [text, text, "other", text + "!", None], [1, 1, 1, None, None])
    rows = suffix.remove_repeats(docs).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in rows) == sorted([(290, 290), (290, 290), (5, 0), (291, 290), (0, 0)])
    assert suffix.remove_repeats(docs.limit(0)).count() == 0


# URL rules


URLS = {
    "http://WWW.Example.ORG/es/1?x": ("www.example.org", "/es/1", "example.org/es/", "block"),
    "https://a.org": ("a.org", "", None, "allow"),
    "https://a.org/": ("a.org", "/", "org/", "allow"),
    "https://example.org/en/17#t": ("example.org", "/en/17", "example.org/en/1", "block"),
    "https://notexample.org/en/17": ("notexample.org", "/en/17", "org/", "allow"),
    "ftp://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
    "x.com/de/": ("", "", None, "allow"),
    "http://É.COM/fr/a?b#c": ("É.com", "/fr/a", "com/fr/", "allow"),
    None: ("", "", None, "allow"),
    "": ("", "", None, "allow"),
}


def test_hosts_paths_and_rules(spark):
    rows = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(rows).collect()}
    assert got == URLS
    assert urls.judge(rows.limit(0)).count() == 0


def test_associations_against_all_combinations(spark):
    import itertools

    rng = np.random.default_rng(2)
    names, rows = list("abcdefg"), []
    for _ in range(400):
        has = {x for x in names if rng.random() < 0.4}
        rows.append((sorted(has), "block" if {"a", "b"} <= has or "g" in has and rng.random() < 0.95 else "allow"))
    found, used = urls.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.05, 0.9)
    want = {}
    for k in range(1, 8):
        for combo in itertools.combinations(names, k):
            n = [v for has, v in rows if set(combo) <= set(has)]
            for verdict in ("allow", "block"):
                both = n.count(verdict)
                if both >= 20 and both / len(n) >= 0.9:
                    want[combo, verdict] = both / len(n)
    minimal = {
        (c, v): p for (c, v), p in want.items()
        if not any((c[:i] + c[i + 1 :], v) in want and want[c[:i] + c[i + 1 :], v] >= p for i in range(len(c)))
    }
    got = {(tuple(r["items"]), r.verdict): r.confidence for r in found.collect()}
    assert got == pytest.approx(minimal) and (("a", "b"), "block") in got
    assert set(used) == {x for c, _ in minimal for x in c}


# winnowing


def test_fingerprints_against_a_loop(spark):
    texts = [t or "" for t in corpus(9, 30)]
    df = winnow.winnowed(frame(spark, texts), "text", "marks")
    words = [r.w for r in frame(spark, texts).orderBy("doc_id").select(F.transform(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), lambda x: F.xxhash64(x)).alias("w")).collect()]
    grams = spark.createDataFrame([(i, k, *(w[k + j] if k + j < len(w) else None for j in range(5))) for i, w in enumerate(words) for k in range(max(1, len(w) - 4)) if w], "i int, k int, a long, b long, c long, d long, e long")
    grams = {(r.i, r.k): r.h & ((1 << 36) - 1) for r in grams.select("i", "k", F.xxhash64("a", "b", "c", "d", "e").alias("h")).collect()}
    for r in df.collect():
        w = words[r.doc_id]
        h = [grams[r.doc_id, k] for k in range(max(1, len(w) - 4))] if w else []
        want = []
        for i in range(max(1, len(h) - 15) if h else 0):
            part = h[i : i + 16]
            at = i + max(j for j, x in enumerate(part) if x == min(part))
            if (h[at], at) not in want:
                want.append((h[at], at))
        assert [(x >> 27, ((1 << 27) - 1) - (x & ((1 << 27) - 1))) for x in r.marks] == want


def test_shared_words_share_a_hash(spark):
    shared = " ".join(f"s{i}" for i in range(20))
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = winnow.winnowed(frame(spark, [f"{a} {shared} {b}", f"{b} {shared}"]), "text", "marks").collect()
    one, two = ({x >> 27 for x in r.marks} for r in rows)
    assert one & two


def test_edited_texts(spark, tmp_path):
    texts = ["", "ab cd ef gh", None, "é" * 9, "one two three four five six seven"]
    frame(spark, texts, [4, 2, 9, 7, 1]).write.parquet(f"{tmp_path}/documents.parquet")
    order = [1, 2, 4, 7, 9]
    by_id = dict(zip([4, 2, 9, 7, 1], [t or "" for t in texts], strict=True))
    got = {r.doc_id: r for r in winnow.op9_winnowing(spark, str(tmp_path)).collect()}
    for i, k in enumerate(order):
        t, after = by_id[k], by_id[order[(i + 1) % 5]]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        assert got[k].n_chars == len(t) and got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[9].near_edited == 1.0 and got[9].near_next == 0.0 and got[4].fingerprint == ""


# line dedup


def gone_lines(texts, ids=None):
    seen, out = [], collections.defaultdict(list)
    for k in range(len(texts)):
        for n, line in enumerate((texts[k] or "").split("\n")):
            w = frozenset(line.encode().split())
            if w:
                if any(5 * len(w & s) >= 4 * len(w | s) for s in seen):
                    out[k].append(n)
                seen.append(w)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_similar_lines(spark, monkeypatch, small):
    if small:  # words cut into blocks, one candidate for each line: the second round finds the rest
        for name, value in (("NEAREST", 1), ("SPLIT", 5), ("HELD_ROWS", 200), ("HELD_PAIRS", 10)):
            monkeypatch.setattr(lines, name, value)
    texts = corpus(11, 80)
    want = gone_lines(texts)
    got = collections.defaultdict(list)
    for r in lines.repeated_lines(frame(spark, texts)).collect():
        got[r.key].append(r.line)
    assert {k: sorted(v) for k, v in got.items()} == dict(want)
    rows = {r.doc_id: r.text for r in lines.deduplicate(frame(spark, texts)).collect()}
    for k, t in enumerate(texts):
        assert rows[k] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[k]))


def test_line_stage_with_odd_ids(spark):
    docs = frame(spark, ["one two three\nfour five six", "one two three", "one two three\nnew line here", None, "", "last of all"], [1, 2, 3, 4, None, None])
    rows = {(r.doc_id, r.text): r.n_chars for r in lines.stage(spark, docs, "").collect()}
    assert rows == {(1, "one two three\nfour five six"): 27, (3, "new line here"): 13, (4, None): None, (None, ""): 0, (None, "last of all"): 11}
    assert lines.stage(spark, docs.limit(0), "").count() == 0
