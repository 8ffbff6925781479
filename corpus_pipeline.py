"""The corpus pipeline: stages that each take the documents that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import jaccard, language, mixing, sharding, templates
from tidewater.session import scratch_path

#: Bytes of text in a shard; the given tables are small, so the limit is too.
SHARD_BYTES = 1 << 20


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents teach.

    Rejected are texts without a letter (or null), and those that no mixture of the languages explains better than chance.
    """
    # Documents may have columns of any name.
    names = [f"own{k}" for k in range(len(docs.columns))]
    kept = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)), "text")
    found = language.identify(kept, language.fit(docs.select("doc_id", "text", "lang")), tuple(names))
    return found.filter(f"lang_pred <> '{language.UNKNOWN}' and gain > 0").select(*names).toDF(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree to 80 %."""
    return jaccard.representatives(docs, jaccard.Join(words=5, percent=80))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, plain or asked again with other values."""
    return templates.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: weights 3, 1, 2 over the sources, 150 % of all words, each at most twice."""
    return mixing.mixed(docs, weights=(3, 1, 2), share=1.5, cap=2.0)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard; no shard has more bytes of text than the limit, unless one document has."""
    return sharding.shard(docs, SHARD_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mix_stage),
    ("sharding", shard_stage),
]

#: No SQL: language models and links between documents are not expressible there.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
