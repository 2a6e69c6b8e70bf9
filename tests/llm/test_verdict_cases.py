"""URLs of one deep template, a planted block, and a mix whose ids tell nothing."""

import pytest
from pyspark.sql import functions as F

from quayside.llm import op5_source_mix as mixing
from quayside.llm import op8_url_rules as urls
from tests.llm.test_corpus_operators import frame


def test_deep_templates_are_mined(spark):
    """40 labelled URLs of depth 30 have some 100 tokens that always come together."""
    path = "/".join(f"part{i}" for i in range(30))
    rows = [(i, f"https://a.org/{path}/{i}?k={i}") for i in range(40)] + [(99, f"https://other.net/{path}/7")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert len(got) == 41 and {r.verdict for r in got.values()} == {"allow"}
    assert got[99].rule is None and got[99].because is not None


def test_a_planted_word_blocks(spark):
    rules = (("good.org", "/", "allow"), ("bad.org", "/", "block"))
    rows = [(i, f"https://x{i}.good.org/news/{'ab'[i % 2]}/{i}") for i in range(60)]
    rows += [(100 + i, f"https://x{i}.bad.org/casino/{'ab'[i % 2]}/{i}") for i in range(60)]
    rows += [(200, "https://new.net/casino/a/1"), (201, "https://new.net/news/a/1"), (202, "https://new.net/")]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).collect()}
    assert (got[200], got[201], got[202]) == ("block", "allow", "allow")


@pytest.mark.parametrize("ids", ["own", "null"])
def test_targets_without_ids(spark, ids):
    texts = [f"w{i} " * 20 for i in range(1500)]
    docs = frame(spark, texts, ids=None if ids == "own" else [None] * 1500)
    mix = mixing.mixture(docs)
    taken = mixing.copies(mix.sized, mix.plan).groupBy("__pattern").agg(F.sum(F.col("__size") * F.col("__copies")).alias("n"))
    got = {r["__pattern"]: r.n for r in taken.collect()}
    for source, target in ((r.source, r.target) for r in mix.sources.collect()):
        assert abs(got[f'["{source}"]'] - target) <= 20
