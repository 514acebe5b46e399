"""Ids beyond the exact range of doubles beside null ids, and further columns that bear the stages' own names."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from tests.llm.test_pipeline import build
from tests.llm.test_text_operators import frame

import corpus_pipeline as pipeline
from tillpoint.llm.decontamination import mark_leaks
from tillpoint.llm.language_id import language_report
from tillpoint.llm.ngram_join import jaccard_components
from tillpoint.llm.toxicity import toxicity_report

LARGE = 2**53 + 1
ROWS = [
    (LARGE, "one two three four five six seven eight nine ten leaked words of a benchmark", "en", "a"),
    (LARGE + 2, "one two three four five six seven eight nine ten leaked words of a benchmark", "en", "a"),
    (None, "alpha beta gamma delta", "de", "b"),
    (7, None, None, None),
]
IDS = {LARGE, LARGE + 2, None, 7}


def docs(spark):
    return frame(spark, ROWS).coalesce(1)  # one batch


def test_ids_stay_exact_beside_a_null(spark):
    parts = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs(spark)).collect()}
    assert set(parts) == IDS and parts[LARGE] == parts[LARGE + 2] == LARGE
    assert {r["doc_id"] for r in language_report(docs(spark)).collect()} == IDS
    labels = spark.createDataFrame([(LARGE, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r["doc_id"] for r in toxicity_report(docs(spark), labels).collect()} == IDS
    items = spark.createDataFrame([(LARGE, "leaked words of a benchmark")], "item_id long, text string")
    marked = mark_leaks(docs(spark).withColumn("big", F.col("doc_id") + 2).withColumn("nan", F.lit(float("nan"))), items)
    found = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in marked.collect()}
    assert found == {LARGE: [LARGE], LARGE + 2: [LARGE], None: [], 7: []}
    assert {r["big"] for r in marked.collect()} == {LARGE + 2, LARGE + 4, None, 9}
    assert all(r["nan"] != r["nan"] for r in marked.collect())


def test_stages_keep_columns_that_bear_their_names(spark):
    path, _ = build(spark)
    given = spark.read.parquet(os.path.join(path, "documents.parquet"))
    names = ["score", "predicted", "_text", "leaks", "weight", "epoch", "n_tokens", "mix_pos", "a.b", "component_id"]
    marked = given.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")) for c in names})
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, marked, path)
        assert out.columns == marked.columns, name
        rows = out.collect()
        assert sorted(str(r[:5]) for r in rows) == sorted(str(tuple(x)) for x in stage(spark, given, path).collect()), name
        assert rows and all(r[c] == (None if r["doc_id"] is None else f"{c}:{r['doc_id']}") for r in rows for c in names), name


def test_different_texts_of_one_id_stay(spark):
    rows = [(1, "first text of some words", "en", "a"), (1, "second text is another one", "en", "a"), (1, "first text of some words", "en", "a")]
    path, _ = build(spark)
    kept = pipeline.drop_near_copies(spark, frame(spark, rows), path).collect()
    assert sorted(r["text"] for r in kept) == ["first text of some words", "second text is another one"]


def test_stages_of_an_empty_table(spark):
    path, _ = build(spark)
    empty = spark.read.parquet(os.path.join(path, "documents.parquet")).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, path).collect() == []
