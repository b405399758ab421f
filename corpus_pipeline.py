"""The training-data pipeline: five stages, each one operator over all its rows.

1. ``toxicity``: documents graded toxic go (cumulative-link ordinal regression).
2. ``near_dedup``: one document of each SimHash component stays (3-word shingles, 2 bits).
3. ``decontamination``: documents that hold a benchmark passage go.
4. ``mixing``: sources are mixed to target weights; a document taken twice is two rows, the
   last document of a source may be cut to its first words.
5. ``sharding``: the mixed rows are dealt into 40 shards by a Feistel permutation.

All stages but the last return the columns of ``documents``; the last returns the
shard and slot of every row. Each stage works on the rows its predecessor kept; null
texts, empty tables and extra columns behave as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.common import written
from ledgerlake.llm.decontamination import drop_contaminated
from ledgerlake.llm.mixing import emit_mix, mix_plan
from ledgerlake.llm.sharding import shard_documents
from ledgerlake.llm.simhash import drop_near_duplicates
from ledgerlake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, width=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return emit_mix(docs, written(mix_plan(docs), "mix-plan"), placed=False)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs, shards=40)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: Fitted grades, SimHash and keyed random draws have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; what one returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
