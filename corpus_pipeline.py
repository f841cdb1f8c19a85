"""A corpus pipeline: each stage applies one operator to all that the one before it kept.

Every stage is written as Parquet in the shared folder and read again, so that
a lost executor costs a stage at most. All stages take nulls in any column,
empty and very long texts, repeated rows, rows that share an id or have none,
further columns of any name, and empty tables; all but the last return their
input's columns in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rastra.llm import decontaminate, mixing, near, tokens, toxicity
from rastra.llm.common import table
from rastra.llm.queries import tokenizer_file
from rastra.storage import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier rejects go; null and empty texts are no more toxic than others and stay."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: sets of five-word shingles with a similarity of 0.8 or more are linked.

    SimHash links come first, each settled by the sets; an index of the sets' prefixes then finds the pairs that the bits miss.

    The smallest id stays, rows without an id only if there is no other; texts without words are one group.
    """
    return near.drop_near_duplicates(docs, shingle=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go; documents without words stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight, half as much again as there is in all; a document taken twice comes twice, a null source is the last one."""
    return mixing.take_mix(docs, weights=(5, 2, 1), share=1.5, ceiling=2.0)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix as Parquet lists, in ascending order of the ids; a row a document of what was written, null and empty texts with the end id alone."""
    path, manifest = tokens.write_tokens(docs, tokenizer_file(), end_id=2)
    return tokens.token_digests(path, manifest)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("tokens", write_tokens),
]

#: Toxicity, near-duplicates and the tokenizer are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents and return the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs, f"stage_{name}")
    return docs
