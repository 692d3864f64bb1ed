from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import langid
from ordermill.llm.langid import (LANGUAGES, accepted_rows, declared_in, document_evidence, host_of, identify, page_evidence,
                                  train, trigram_counts, visible_text)
from ordermill.llm.queries import op2_language_id


@pytest.fixture(scope="module")
def model(corpus):
    return train(corpus.where("doc_id % 2 = 0"), "lang")


def test_held_out_accuracy(corpus, model):
    held = corpus.where("doc_id % 2 = 1").where("length(text) > 20")
    got = identify(document_evidence(held), model).join(held.select("doc_id", F.col("lang").alias("true")), "doc_id").collect()
    assert sum(r.lang == r.true for r in got) / len(got) >= 0.97 and sum(r.kept for r in got) / len(got) >= 0.99


def test_page_accuracy_and_query(spark, sf_dir, corpus):
    out = op2_language_id(spark, sf_dir)
    rows = {r.doc_id: r for r in out.collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert len(rows) == corpus.count() + pages.count()
    true = {-1 - r.page_id: r.l for r in pages.select("page_id", F.regexp_extract("url", "//[^/]+/([a-z]{2})/", 1).alias("l")).collect() if r.l}
    assert sum(rows[d].lang == l for d, l in true.items()) / len(true) >= 0.97
    assert all(r.kept for r in rows.values() if r.doc_id >= 0 and r.posterior > 0.9 and r.lang)


def test_plan_has_no_cross_join(spark, sf_dir):
    plan = op2_language_id(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def brute(scored):
    """The fusion over plain Python sums: {doc_id: (lang, posterior)}."""
    n = len(LANGUAGES)

    def dom(h):
        return ".".join(h.split(".")[-2:]) if h and "." in h else h

    def suf(h):
        return h.split(".")[-1] if h and "." in h else None

    def sums(pred):
        return [sum(r["post"][i] for r in scored if r["known"] and pred(r)) / 1e6 for i in range(n)]

    def smooth(s, parent):
        t = sum(s) + langid.PRIOR_ROWS
        return [(a + langid.PRIOR_ROWS * p) / t for a, p in zip(s, parent)]

    def log_like(key, value):
        values = {key(r) for r in scored} - {None}
        if value is None:
            return [0.0] * n
        total = [sum(sums(lambda r, v=v: key(r) == v)[i] for v in values) + len(values) for i in range(n)]
        return [math.log((a + 1) / t) for a, t in zip(sums(lambda r: key(r) == value), total)]
    whole = smooth(sums(lambda r: True), [1 / n] * n)
    out = {}
    for r in scored:
        h = r["host"]
        prior = whole
        if h is not None:
            domain = smooth(sums(lambda x: dom(x["host"]) == dom(h)), whole)
            mine = [max(0.0, a - r["known"] * b / 1e6) for a, b in zip(sums(lambda x: x["host"] == h), r["post"])]
            prior = smooth(mine, domain)
        d, s = log_like(lambda x: x["declared"], r["declared"]), log_like(lambda x: suf(x["host"]), suf(h))
        f = [a + math.log(b) + c + e for a, b, c, e in zip(r["loglik"], prior, d, s)]
        top = max(f)
        out[r["doc_id"]] = (LANGUAGES[f.index(top)], 1 / sum(math.exp(x - top) for x in f))
    return out


def test_fusion_equals_brute_force(spark, model):
    texts = ["Thtion the and", "und der die", "que la", "le eaux", "x"]
    rows = [(i, i, texts[i % 5], [None, "en", "de", "fr"][i % 4], [None, "a.b.de", "c.b.de", "x.org", "src0"][(i * 3) % 5])
            for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, row_key long, text string, declared string, host string")
    scored = []
    for doc_id, _, text, declared, host in rows:
        counts = trigram_counts(text)
        mean = counts @ model / counts.sum()
        s = mean * min(counts.sum(), langid.EVIDENCE)
        s = s - s.max()
        p = np.exp(s) / np.exp(s).sum()
        scored.append({"doc_id": doc_id, "declared": declared, "host": host, "loglik": s.tolist(), "post": np.rint(p * 1e6).tolist(),
                       "known": bool(mean.max() >= np.log(1 / langid.BUCKETS))})
    want = brute(scored)
    for r in identify(df, model).collect():
        assert r.lang == want[r.doc_id][0] and r.posterior == pytest.approx(want[r.doc_id][1], rel=1e-9)


def test_declared_language_decides_where_the_text_cannot(spark, model):
    rows = [(i, i, "Thtion the and of in erst", "en", "h.example.com") for i in range(60)]
    rows += [(100 + i, i, "der und die ein nicht ung", "de", "h.example.com") for i in range(60)] + [(999, 0, "the der", "de", None), (998, 0, "the der", "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, row_key long, text string, declared string, host string")
    got = {r.doc_id: r.lang for r in identify(df, model).collect()}
    assert got[999] == "de" and got[998] == "en"


def test_extraction(spark):
    html = "<!DOCTYPE html><HTML class=x lang='fr-CA'><script>if (a<b) \"</p>\"</script><!-- x --><p>un&nbsp;mot<br>deux"
    df = spark.createDataFrame([(html, "https://u@Blog.Example.co.uk:8080/a?b"), ("", "nonsense"), (None, None)], "h string, u string")
    got = df.select(visible_text(F.col("h")), declared_in(F.col("h")), host_of(F.col("u"))).collect()
    assert got[0][0].split() == ["un", "mot", "deux"] and got[0][1:] == ("fr", "blog.example.co.uk")
    assert got[1][1:] == (None, None) and got[2][1:] == (None, None)


def test_odd_rows(spark, model, make_docs):
    rows = [(1, None), (2, ""), (3, "12345 !!! ??"), (4, "the and of in that"), (4, "the and of in that"), (None, "the and of in that"),
            (6, "der und die " * 100_000, "de", None), (7, "\x01\x02 a\x03" * 20, None, "src0")]
    docs = make_docs(rows).withColumn("declared", F.lit("zz")).withColumn("row", F.lit(1))
    kept = accepted_rows(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "6", "None"]
    assert accepted_rows(make_docs([]), model).count() == 0
    pages = spark.createDataFrame([(1, None, None), (2, "u", "<p>")], "page_id long, url string, html string")
    assert [r.kept for r in identify(page_evidence(pages), model).collect()] == [False, False]


def test_broken_markup_takes_linear_time():
    import time
    from ordermill.llm.langid import without_markup
    began = time.process_time()
    for html in ("<" * 1_000_000, "<!--" * 250_000, "<script>" * 125_000, "<style><!--<script>" * 50_000, "</script" * 125_000,
                 "&" * 1_000_000, "&a" * 500_000):
        without_markup(html)
    assert time.process_time() - began < 5
    page = "<p>a<SCRIPT x>b</script >c<!-- d --><style>e</style>&nbsp;f<br/><!-- g <b>h</b> < i"
    assert without_markup(page).split() == ["a", "c", "f", "h", "<", "i"]
