"""The corpus pipeline: five stages from raw documents to token shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the result is
written as Parquet and reread as the next stage's ``docs``.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratus.llm import decontaminate, jaccard, mixing, toxicity, wavelet
from stratus.llm.queries import END_ID, tokenizer_path
from stratus.llm.scratch import MAX_BROADCAST, Scratch, bounded_broadcast, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each near-duplicate component; rows that
    repeat its id stay together."""
    found = jaccard.near_duplicates(docs, Scratch(spark, "pipeline-near"))
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(bounded_broadcast(gone, MAX_BROADCAST), "doc_id", "left_anti").select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    scratch = Scratch(spark, "pipeline-leaks")
    found = scratch.save(decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"), scratch), "leaks")
    gone = found.select("doc_id").distinct()
    return docs.join(bounded_broadcast(gone, MAX_BROADCAST), "doc_id", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its hash say."""
    return mixing.mix(docs, Scratch(spark, "pipeline-mix"))


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token offsets and checksums, read back from the wavelet shards."""
    shards = wavelet.write_shards(docs, Scratch(spark, "pipeline-tokens"), tokenizer_path(), END_ID)
    return wavelet.read_documents(shards)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_shards", token_shards),
]

#: No SQL: the classifier, the latent search and the tokenizer have none.  See
#: tests/llm/test_pipeline.py for the comparison with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
