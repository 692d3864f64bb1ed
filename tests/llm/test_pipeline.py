from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ordermill.llm.common import materialise
from test_decontaminate import brute as coverage
from test_mixing import brute_mix
from test_simhash import brute_fp, brute_roots
from ordermill.llm.mixing import DOMAIN_WEIGHTS, LANG_WEIGHTS, MAX_EPOCHS, SEED


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_equal_brute_force(spark, sf_dir, corpus):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "simhash_dedup", "decontaminate", "mix", "tokens"]
    known = materialise(stages["language_id"](spark, corpus, sf_dir), "t1")
    assert known.columns == corpus.columns and known.count() >= 0.98 * corpus.count()
    rows = by_id(known)

    fps = {d: brute_fp(r.text or "") for d, r in rows.items()}
    root = brute_roots(sorted(set(fps.values())))
    least = {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    single = materialise(stages["simhash_dedup"](spark, known, sf_dir), "t2")
    assert single.columns == corpus.columns and sorted(r.doc_id for r in single.collect()) == sorted(least.values())

    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    first = [set(" ".join(t.lower().split()[k:k + 2]) for k in range(0, 40, 3)) for t in items]
    rows = by_id(single)
    leaks = {d for d, r in rows.items() for t, seeds in zip(items, first)
             if sum(s in r.text.lower() for s in seeds) > 3 and coverage(r.text, t) >= 0.5}
    clean = materialise(stages["decontaminate"](spark, single, sf_dir), "t3")
    assert leaks and {r.doc_id for r in clean.collect()} == set(rows) - leaks

    rows = by_id(clean)
    want = brute_mix([(d, r.text, r.lang, r.source) for d, r in rows.items()], None, MAX_EPOCHS,
                     {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS}, SEED)
    mixed = materialise(stages["mix"](spark, clean, sf_dir), "t4")
    assert mixed.columns == corpus.columns and sorted(r.doc_id for r in mixed.collect()) == [d for d, _ in want]

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expect = 0, []
    for d, _ in want:
        ids = tok.encode(rows[d].text or "", add_special_tokens=False).ids + [1]
        expect.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in stages["tokens"](spark, mixed, sf_dir).collect()) == expect
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == expect


def test_odd_rows_pass_every_stage(spark, sf_dir, make_docs):
    text = "the and of in that " * 30
    odd = make_docs([(None, text, "en"), (1, None), (2, "", "en"), (3, text, "en"), (3, text, "en"), (4, text + "tail", "en"),
                     (5, "one that stands alone of and in the", None, None), (6, "der die und das nicht ein", "de", "src1")])
    for docs in (odd.withColumn("row", F.lit(1)).withColumn("_id", F.lit(2)), make_docs([])):
        n = docs.count()
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            docs = materialise(stage(spark, docs, sf_dir), f"odd_{name}")
            assert docs.columns == list(corpus_pipeline.DOCUMENT_COLUMNS)
            if name == "simhash_dedup" and n:
                assert sorted(str(r.doc_id) for r in docs.collect()) == ["3", "5", "6"]
        assert stage is not None
        out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() >= 0
