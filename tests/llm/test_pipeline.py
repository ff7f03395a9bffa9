"""The pipeline's stages against brute force on the smallest tables."""

import corpus_pipeline
from palimpsest.llm import langid, simhash

from .test_native import brute_lines


def test_stages(spark, docs):
    kept = corpus_pipeline.language(spark, docs, "").cache()
    assert kept.columns == corpus_pipeline.COLUMNS and kept.count() >= 0.97 * docs.count()
    lined = corpus_pipeline.lines(spark, kept, "").cache()
    assert lined.columns == corpus_pipeline.COLUMNS
    want = {(i, t) for i, _, _, t in brute_lines([(r.doc_id, r.text) for r in kept.collect()])}
    assert {(r.doc_id, r.text) for r in lined.collect()} == want
    last = corpus_pipeline.near_duplicates(spark, lined, "").cache()
    texts = {r.doc_id: r.text for r in lined.collect()}
    stay = {r.doc_id for r in last.collect()}
    shingles = {i: set(simhash.shingle_hashes(t, 5)) for i, t in texts.items()}

    def alike(i, j):
        return len(shingles[i] & shingles[j]) / max(1, len(shingles[i] | shingles[j])) if shingles[i] or shingles[j] else 1

    assert not [(i, j) for i in stay for j in stay if i < j and alike(i, j) >= 0.8]
    assert all(any(alike(i, j) >= 0.8 for j in texts if j != i) for i in texts if i not in stay)
    assert len({texts[i] for i in texts}) - len({texts[i] for i in stay}) < 0.2 * len(texts)
    pieces = corpus_pipeline.packed(spark, last, "").collect()
    assert {r.doc_id for r in pieces} == stay


def test_repeated_ids_through_all_stages(spark, docs):
    """An id with two texts is two documents: neither is lost for the other's copy, whatever the stage."""
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.filter("lang = 'en' AND n_chars > 400").limit(12).collect()]
    texts = [r[1] for r in rows]
    odd = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (2, texts[2]), (None, texts[3]), (None, texts[4]), (None, texts[4]), (5, texts[5])]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in odd], docs.schema)
    kept = corpus_pipeline.near_duplicates(spark, df, "").collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(1, texts[0]), (2, texts[1]), (2, texts[2]), (None, texts[3]), (None, texts[4]), (5, texts[5])], key=repr)
    assert corpus_pipeline.language(spark, df, "").count() == len(odd) and corpus_pipeline.lines(spark, df, "").count() == len(odd)
    assert len({r.sequence_id for r in corpus_pipeline.packed(spark, df, "").collect()}) >= 1


def test_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert got and got[0].__fields__[0] == "doc_id"


def test_odd_rows(spark, edge, empty):
    for df in (edge, empty):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, df.select(*corpus_pipeline.COLUMNS), "").collect()
    assert langid.UNKNOWN == "und"
