"""The pipeline, stage by stage, against plain versions."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm.decontamination import words_of
from test_llm_secrets import plain_base
from test_llm_similar import plain_kept
from test_llm_simhash import plain_classes, plain_fingerprint

tokenizers = pytest.importorskip("tokenizers")


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_every_stage_over_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}

    good = stage("quality")(spark, docs, folder)
    assert good.columns == columns
    kept = {r.doc_id: r for r in good.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    junk = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in clean) / len(clean) > 0.98
    assert sum(i in kept for i in junk) / len(junk) < 0.2

    rows = sorted(kept.values(), key=lambda r: r.doc_id)
    classes = plain_classes([plain_fingerprint(r.text) for r in rows])
    single = stage("near_duplicates")(spark, good, folder)
    by_fingerprint = {r.doc_id for n, r in enumerate(rows) if classes[n] == n}
    by_words = set(plain_kept([(r.doc_id, r.text) for r in rows]))
    assert len(by_words) < len(rows)
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(by_fingerprint & by_words)

    items = [" ".join(words_of(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    holds = lambda t: any(f" {i} " in f" {' '.join(words_of(t))} " for i in items)
    apart = stage("decontamination")(spark, single, folder)
    left = {r.doc_id for r in apart.collect()}
    texts = {r.doc_id: r.text for r in single.collect()}
    leaking = {i for i, t in texts.items() if holds(t)}
    assert leaking and not leaking & left
    assert len(texts) - len(left) <= len(leaking) + 2

    masked = {r.doc_id: r for r in stage("secrets")(spark, apart, folder).collect()}
    assert masked.keys() == left
    for i, r in masked.items():
        assert not plain_base(r.text) and r.n_chars == len(r.text)
        assert r.text == texts[i] or plain_base(texts[i])


def test_run_returns_tokens_for_what_is_left(spark):
    library = tokenizers.Tokenizer.from_file(corpus_pipeline.tokenizer_file())
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows
    for r in rows:
        assert list(r.token_ids) == library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.token_ids)


ODD = [
    (1, "", "en"), (2, None, "en"), (3, " ", None), (None, "some words without an id", "en"), (4, "once and only once here", "en"),
    (4, "once and only once here", "en"), (5, "w " * 30_000, "fr"), (6, "token = abcdef123456 was here", "en"),
    (7, "one two three four five six seven", "en"),
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_and_empty_tables(spark, tmp_path, rows):
    folder = str(tmp_path)
    frame = spark.createDataFrame([(*r, 1, "c", 2.0, [7]) for r in rows], "doc_id long, text string, lang string, n_tokens int, component_id string, score double, token_ids array<int>")
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(99, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "one two three four five six seven"), (2, None)] if rows else []
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert sorted(out.columns) == sorted(frame.columns)
    found = out.select("doc_id", "text", F.size("token_ids").alias("size"), "n_tokens").collect()
    if not rows:
        assert found == []
        return
    texts = sorted(((r.doc_id, r.text) for r in found), key=str)
    assert texts == sorted([(1, ""), (None, ODD[3][1]), (4, ODD[4][1]), (5, ODD[6][1]), (6, "[SECRET] was here")], key=str)
    assert all(r.size == r.n_tokens for r in found)
