"""The pipeline's stages one after another on nulls, long texts, repeated rows, clashing columns and empty tables."""

import brute
import pytest
from pyspark.sql import functions as F
from test_llm_edges import CLASHES, ROWS, SCHEMA, SHARED, words

import corpus_pipeline

LONG_ROWS = [
    (100, words(80, 400) + " " + SHARED, "en", "a", 1), (101, words(81, 300) + " " + SHARED, "en", None, 1), (102, words(80, 400) + " " + SHARED, "en", "a", 1),
    (100, words(80, 400) + " " + SHARED, "en", "a", 1), (None, words(82, 200), None, None, None), (-5, words(83, 4000), "fr", "b", 9),
]


@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, empty):
    docs = spark.createDataFrame([] if empty else [*ROWS, *LONG_ROWS], SCHEMA).withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = corpus_pipeline.written(stage(spark, docs, "unused"), f"edges-{number}")
        after = docs.collect()
        if empty:
            assert after == [] and (number == 3 or docs.columns == columns)
            continue
        if number < 3:
            assert docs.columns == columns
        if number == 0:
            assert {r.doc_id for r in after} >= {-5, 100, 101, 102} and not any(r.text is None or r.text == "" for r in after)
        elif number == 1:  # copies go, but rows of one id stay together and rows without an id stay
            kept = {r.doc_id for r in after}
            assert {-5, 100, 101, None} <= kept and 102 not in kept
        elif number == 2:
            want = {i: n for i, n, *_ in ((r[0], r[1] - r[2]) for r in brute.substring_dedup(before)) if i is not None}
            assert {r.doc_id: len(brute.words(r.text)) for r in after if r.doc_id is not None} == want
        else:
            ids = brute.hf_tokenizer()
            total = sum(len(ids.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in before)
            assert sum(r.length for r in after) == total
