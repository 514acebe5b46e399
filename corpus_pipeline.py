"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, source mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their columns; the
last returns where each row goes. Documents pass between stages as Parquet.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm.decontamination import mark_leaks
from tillpoint.llm.mixing import mix_sources
from tillpoint.llm.ngram_join import jaccard_components
from tillpoint.llm.sharding import byte_shards
from tillpoint.llm.tables import read, release_shuffles
from tillpoint.llm.toxicity import learn_toxicity, score_texts
from tillpoint.session import scratch_path

SHARDS = 40
TARGET_ENTROPY, MAX_REPEATS = 0.9, 2.0
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _own_names(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with the input's further columns out of its way: they may bear any name, also one that
    the stage makes itself, and come back as they were."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [c if c in COLUMNS else f"_further{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*plain), sf_dir).select(*plain).toDF(*docs.columns)

    return run


@_own_names
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, does not reject."""
    model = learn_toxicity(docs, read(spark, sf_dir, "labels"))
    scored = score_texts(docs, model, [F.col(c) for c in docs.columns], restored=False)
    return scored.where("predicted = 0").select(docs.columns)


@_own_names
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component; of rows that share id and text, one; different texts
    of one id stay. Rows without an id are linked with nothing and stay."""
    parts = jaccard_components(docs)
    copies = parts.where("doc_id <> component_id").select("doc_id").distinct().checkpoint()
    release_shuffles(spark)
    named = docs.where("doc_id is not null").join(copies, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])
    return named.select(docs.columns).unionByName(docs.where("doc_id is null"))


@_own_names
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    marked = mark_leaks(docs, read(spark, sf_dir, "benchmark"))
    return marked.where(F.size("leaks") == 0).select(docs.columns)


@_own_names
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources up to twice, towards a flatter mixture of sources."""
    mixed = mix_sources(docs, target_entropy=TARGET_ENTROPY, max_repeats=MAX_REPEATS)
    return mixed.select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    placed = byte_shards(docs, SHARDS, keep=["doc_id", "lang", "source"])
    return placed.select("doc_id", "lang", "source", "size", "text_crc32", "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("temperature_mixing", mix),
    ("sharding", shard),
]

#: Scoring and edit distances cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder, each written to the shared scratch folder
    before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
