from __future__ import annotations

import hashlib

import numpy as np

import corpus_pipeline
from railwatch.llm import quality
from railwatch.llm.queries import held_out, tokenizer_path
from railwatch.sources.tables import store
from tests.llm import brute
from tests.llm.conftest import SF
from tests.llm.test_pages_and_items import words


def test_stages_against_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~held_out(5, 0))
    good = {r.doc_id for r in quality.score_documents(docs, model).where("score >= 0.3").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id in good)
    rows = [r for r, e in zip(rows, brute.exact(rows), strict=True) if e[3]]
    rows = [r for r, e in zip(rows, brute.similar(rows), strict=True) if e[0] == e[1]]
    items = [f" {' '.join(words(r.text))} " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t in rows if not any(i in f" {' '.join(words(t))} " for i in items)]
    library = Tokenizer.from_file(tokenizer_path())
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in rows}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(found) == sorted(ids)
    for d, x in ids.items():
        assert (found[d].n_tokens, found[d].ids) == (len(x), x)
        assert found[d].ids_sha256 == hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()


def test_stages_keep_columns_and_take_odd_rows(spark, odd_docs, no_docs):
    docs = store(odd_docs, "odd")
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, docs, SF), name)
        assert out.count() <= docs.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out if name != corpus_pipeline.STAGES[-1][0] else docs
    docs = store(no_docs, "none")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
