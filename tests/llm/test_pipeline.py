"""The pipeline's stages on small tables: what each keeps, and edges of the input."""

from __future__ import annotations

import os
import random
import tempfile

from tests.llm.test_text_operators import brute_components, edges, frame, sentences

import corpus_pipeline as pipeline
from tillpoint.llm.decontamination import normalise


def build(spark):
    rng = random.Random(21)
    rows = edges(rng)
    for k in range(120):
        rows.append((200 + k, sentences(rng, 40, 9000) + (" vilest" if k % 4 == 0 else ""), "en", rng.choice("aaab")))
    item = " ".join(f"leak{k}" for k in range(30))
    rows += [(400, f"Before {item.upper()} after it", "en", "a"), (401, sentences(rng, 30, 9000) + " leak1 leak2", "en", "c")]
    labels = [(200 + k, 1, int(k % 4 == 0)) for k in range(120)]
    path = tempfile.mkdtemp(prefix="tp-corpus-")
    frame(spark, rows).write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(path, "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(os.path.join(path, "benchmark.parquet"))
    return path, rows


def test_stages_keep_what_they_should(spark):
    path, rows = build(spark)
    docs = spark.read.parquet(os.path.join(path, "documents.parquet"))
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "decontamination", "temperature_mixing", "sharding"]
    clean = pipeline.drop_toxic(spark, docs, path)
    assert clean.columns == docs.columns
    left = [tuple(r)[:4] for r in clean.collect()]
    assert sorted(map(str, left)) == sorted(str(r) for r in rows if not (r[1] or "").endswith("vilest"))
    single = pipeline.drop_near_copies(spark, clean, path)
    ids = sorted((r["doc_id"] for r in single.collect()), key=str)
    heads = {c for i, _, c in brute_components(left) if c is not None}
    assert ids == sorted([*heads, *(i for i, *_ in left if i is None)], key=str)
    free = pipeline.drop_leaks(spark, single, path)
    assert {400} == {r["doc_id"] for r in single.collect()} - {r["doc_id"] for r in free.collect()}
    mixed = pipeline.mix(spark, free, path)
    assert {r["doc_id"] for r in mixed.collect()} == {r["doc_id"] for r in free.collect()} and mixed.count() > free.count()


def test_run_places_every_row_once(spark):
    path, _ = build(spark)
    got = pipeline.run(spark, path).collect()
    assert got and all(0 <= r["shard"] < pipeline.SHARDS for r in got)
    assert len({(r["shard"], r["slot"]) for r in got}) == len(got)
    assert normalise(" A\n b ") == "a b"
