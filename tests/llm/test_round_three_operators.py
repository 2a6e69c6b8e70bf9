"""Alignment, decontamination and collocations against brute force, with awkward rows."""

import collections
import hashlib
import re

import numpy as np
import pytest

from quayside.llm import op11_alignment as alignment
from quayside.llm import op12_decontamination as leaks
from quayside.llm import op13_collocations as phrases
from tests.llm.test_corpus_operators import frame

# alignment


def merged(x):
    """Groups of a text as (A ids, B ids), token by token."""
    (encode_a, words_a, _), (encode_b, words_b, _) = (alignment._loaded(t) for t in (alignment.ByteLevel(), alignment.Pieces()))
    if not x:
        return []
    a, b = encode_a([x])[0], encode_b([x])[0]
    whole = (" " + x).encode()
    if b"".join(words_a[i] for i in a) != whole or b"".join(words_b[i] for i in b) != whole:
        return []
    groups, left, right, i, j, at_a, at_b = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            at_a, i = at_a + len(words_a[a[i]]), i + 1
            left.append(a[i - 1])
        else:
            at_b, j = at_b + len(words_b[b[j]]), j + 1
            right.append(b[j - 1])
        if at_a == at_b:
            groups.append((left, right))
            left, right = [], []
    return groups


TEXTS = [
    "The quick brown fox", "Elle était là, où ?", "  two  spaces\n\nand lines\t", "😀 emoji and \x00 bytes \x0b", "<|endoftext|> <s> </s>", "▁ mark",
    "", None, "a", "The quick brown fox", "ﬁ ligature", "x" * 3000, "word " * 2000,
]


@pytest.fixture(scope="module")
def aligned(spark):
    docs = frame(spark, TEXTS, ids=[1, 2, 3, 4, 5, 6, 7, 8, None, 1, 11, 12, 13])
    return [r.asDict() for r in alignment.link_statistics(docs.repartition(3)).collect()]


def test_alignment_against_a_loop(aligned):
    groups = [merged(t) for t in TEXTS]
    links = [[(g[0][-1], g[1][-1]) for g in of] for of in groups]
    count = collections.Counter(p for of in links for p in of)
    best = collections.Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    want = []
    for of, found in zip(groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in of)
        want.append((
            sum(len(a) for a, _ in of), sum(len(b) for _, b in of), len(of), len(found), sum(count[p] == best[p[1]] for p in found),
            sum(count[p] for p in found), hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(tuple(r[n] for n in names) for r in aligned) == sorted(want)
    assert sum(r["doc_id"] is None for r in aligned) == 1


def test_both_encoders_give_the_same():
    """Random characters of the range where texts go to the faster encoder, and its pieces in odd places."""
    from tokenizers import Tokenizer

    side = alignment.ByteLevel()
    tool, fast = Tokenizer.from_file(side.path), side._by_rank()
    tool.encode_special_tokens = True
    rng = np.random.default_rng(5)
    every = [chr(c) for c in range(alignment._SETTLED)]
    texts = ["".join(f"{c}a{c}1{c} {c}{c}." for c in every)]
    for low, high in ((0, alignment._SETTLED), (9, 60), (32, 127), (97, 100), (0xA0, 0x17F)):
        texts += ["".join(chr(c) for c in rng.integers(low, high, rng.integers(1, 400))) for _ in range(150)]
    common = ["'s", "'LL", "  ", "\n\n", "the", " The", "ing", "\x85", "\xa0", "12", "<|endoftext|>", "é", "...", "\t"]
    texts += ["".join(rng.choice(common, 200)) for _ in range(150)] + ["a" * 20_000, "ab" * 10_000, " " * 5000]
    for t in texts:
        assert fast.encode_ordinary(" " + t) == tool.encode(" " + t, add_special_tokens=False).ids


def test_lanes_do_not_change_the_links():
    rng = np.random.default_rng(1)
    ends_a, ends_b, begin, at = [], [], [], 0
    for size in (0, 1, 5, 40, 700):
        begin.append(len(ends_a))
        if size:
            cuts = [np.sort(rng.choice(np.arange(1, size), rng.integers(0, size), replace=False)) if size > 1 else np.zeros(0, int) for _ in "ab"]
            ends_a += [at + c for c in [*cuts[0], size]]
            ends_b += [at + c for c in [*cuts[1], size]]
            at += size
    ends_a, ends_b = np.array(ends_a), np.array(ends_b)
    both = np.intersect1d(ends_a, ends_b)
    for lane in (1, 2, 7, 256):
        a, b = alignment.lockstep(ends_a, ends_b, np.array(begin), lane)
        assert (ends_a[a] == both).all() and (ends_b[b] == both).all()


def test_pairs_that_can_be_linked():
    a, b = [b"ab", b"b", b"", b"xab"], [b"b", b"ab", b"zb", b"b"]
    every = {i * 4 + j for i, x in enumerate(a) for j, y in enumerate(b) if x and y and (x.endswith(y) or y.endswith(x))}
    assert alignment.linkable(a, b).tolist() == sorted(every)


def test_aligned_tokens(spark):
    rows = {r.doc_id: r for r in alignment.align(frame(spark, ["The fox", None])).collect()}
    groups = merged("The fox")
    assert rows[0].a == [t for g in groups for t in g[0]] and rows[0].b == [t for g in groups for t in g[1]]
    assert rows[0].a_cuts == list(np.cumsum([len(g[0]) for g in groups]) - 1) and rows[0].b_cuts == list(np.cumsum([len(g[1]) for g in groups]) - 1)
    assert rows[1].a == [] and rows[1].a_cuts == []
    assert alignment.link_statistics(frame(spark, ["x"]).limit(0)).count() == 0


# decontamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def bench(spark, items):
    rows = [(i, t, "own", "own", 1) for i, t in items]
    return spark.createDataFrame(rows, "item_id long, text string, term string, word string, row long")


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"), (2, "SHORT phrase"), (3, ""), (4, None), (5, "é a é a é a é a é a é a"),
    (None, "null id item"), (6, "one"), (7, "short phrase"), (7, "other words here"), (8, "never seen anywhere at all"), (9, "Ünique ÜBER"),
]
DOCS = [
    "x one two three four five six seven eight nine ten eleven y", "a short, phrase; here", "", None, "é a é a é a é a é a é a é", "é a é a é a é a é",
    "null id item null id item", "two three four five six seven eight nine ten eleven twelve " * 2, "Ünique ÜBER ünique über", "other words here",
    "ONE", "short x phrase", "one two three four five " * 50,
]


def hits(text):
    w, hit, ids = words(text), set(), set()
    for i, t in ITEMS:
        v = words(t)
        n = min(len(v), 10)
        for s in range(len(v) - n + 1 if n else 0):
            for k in range(len(w) - n + 1):
                if w[k : k + n] == v[s : s + n]:
                    hit |= set(range(k, k + n))
                    ids.add("" if i is None else str(i))
    return len(w), len(hit), sorted(ids)


def test_benchmark_phrases_against_a_loop(spark):
    docs = frame(spark, DOCS + DOCS[:2], ids=[*range(len(DOCS) - 1), None, 0, None])
    got = [(r.n_words, r.n_hit, r.item_ids) for r in leaks.decontaminate(docs, bench(spark, ITEMS)).collect()]
    assert sorted(got) == sorted(hits(t) for t in DOCS + DOCS[:2])


def test_decontamination_without_rows(spark):
    docs, items = frame(spark, ["one two"]), bench(spark, ITEMS)
    assert leaks.decontaminate(docs.limit(0), items).count() == 0
    row = leaks.decontaminate(docs, items.limit(0)).first()
    assert (row.doc_id, row.n_words, row.n_hit, row.item_ids) == (0, 2, 0, [])


@pytest.mark.parametrize("within", [2, 4, 9])
def test_words_near_each_other(spark, within):
    rng = np.random.default_rng(within)
    docs = [" ".join(rng.choice(list("abcdef"), 30)) for _ in range(6)] + ["", None]
    items = [(1, "a b c"), (2, "d d e"), (3, "f"), (4, "a z")]
    index = leaks.positional_index(frame(spark, docs), bench(spark, items))
    rows = index.documents.select("row", "key").withColumnRenamed("key", "doc")
    found = leaks.proximity_matches(index, within).join(rows, "row").join(index.items.select("item", "id"), "item")
    got = {(r.id, r.doc, r["from"]) for r in found.collect()}
    want = set()
    for i, t in items:
        need = set(t.split())
        for d, text in enumerate(docs):
            w = (text or "").split()
            want |= {(i, d, k) for k in range(len(w)) if w[k] in need and need <= set(w[k : k + within])}
    assert got == want


def test_decontamination_runs_no_python(spark, sf_dir):
    plan = leaks.op12_decontamination(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# collocations


def mined(rows, least, longest, top, percent):
    count, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    count[lang, tuple(w[i : i + k])] += 1
    often = {p: a for p, a in count.items() if len(p[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in often.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(m == lang and len(q) > len(p) and inside(q) and 100 * n >= percent * a for (m, q), n in often.items()):
            continue
        cuts = [(1000 * a * total[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]], total[lang]))
    return {
        (lang, i + 1, p.decode(), -a, left, right, n, -s)
        for lang, found in out.items() for i, (s, a, p, left, right, n) in enumerate(sorted(found)[:top])
    }


def prose(seed=7, n=120):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "Of", "THE"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    texts = []
    for _ in range(n):
        w = list(rng.choice(vocabulary, rng.integers(0, 60), p=weights / weights.sum()))
        if rng.random() < 0.5:
            w += "strong tea with old milk in it".split()
        texts.append("".join(x + rng.choice([" ", "  ", "\t", ". ", "\n", " ,"], p=[0.7, 0.06, 0.06, 0.06, 0.06, 0.06]) for x in w))
    return texts + [None, "", " . ", "a\x0bb", "strong tea " * 400]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_against_a_loop(spark, monkeypatch, small):
    if small:  # most words and pairs have no rank; many flushes
        for name, value in (("HEAD", 8), ("HELD", 500)):
            monkeypatch.setattr(phrases, name, value)
    texts = prose()
    langs = [("en", "fr", None)[i % 3] for i in range(len(texts))]
    rows = [(i, t, x, "own") for i, (t, x) in enumerate(zip(texts, langs, strict=True))]
    docs = spark.createDataFrame(rows, "rank long, text string, lang string, phrase string").repartition(3)
    got = phrases.collocations(docs, min_count=4, top=60).collect()
    want = mined(list(zip(langs, texts, strict=True)), 4, 5, 60, 100)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("tile", [2, 8, 1024])
def test_tiles_count_pairs(monkeypatch, tile):
    """Dense tiles, sparse ones, ranks beyond the tiles and hashes, by whatever size of tile."""
    monkeypatch.setattr(phrases, "TILE", tile)
    monkeypatch.setattr(phrases, "DENSE", 4 * tile)
    rng = np.random.default_rng(tile)
    pairs = rng.zipf(1.3, (2, 20_000)).astype(np.uint64) % np.uint64(6 * tile)
    pairs[:, ::97] |= phrases._HASHED
    want = collections.Counter(zip(*pairs.tolist(), strict=True))
    got = phrases.tally(*pairs)
    assert {(a, b): n for a, b, n in got.T.tolist()} == want and got.shape[1] == len(want)
    again = phrases.summed([got, phrases.tally(*pairs[:, :100])])
    assert again[2].sum() == 20_100 and again.shape[1] == len(want)


def test_phrases_inside_longer_ones(spark):
    texts = prose(8)
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    got = {tuple(r) for r in phrases.collocations(docs, min_count=5, max_words=3, top=1000, covered_percent=60).collect()}
    assert got == mined([("en", t) for t in texts], 5, 3, 1000, 60)


def test_no_phrases(spark):
    docs = frame(spark, ["a b", None, ""])
    assert phrases.collocations(docs).count() == 0 and phrases.collocations(docs.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    level = spark.createDataFrame([(10**13, 10**13, 10**13)], "a long, n long, l long")
    exact = "1000 * CAST(a AS decimal(38,0)) * CAST(n AS decimal(38,0)) div (CAST(l AS decimal(38,0)) * CAST(l AS decimal(38,0)))"
    assert level.selectExpr(exact).first()[0] == 1000
