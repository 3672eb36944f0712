"""A corpus pipeline of the llm operators, stage by stage over the documents table.

quality   documents that a quality rule rejects go
simhash   of each group of near-duplicates (similarity 0.8 or more) the document with the smallest id stays;
          64 bits do not tell 0.8 from less, so candidates come from chains of wide SimHash prints, verified on whole sets
benchmark documents that hold a passage of the benchmark go
pii       personal data is masked in the text; n_chars, where there is one, follows
encode    each text as BPE ids, digested, and decoded again

Every stage takes any table with doc_id and text, whatever its other columns are called, and all but
the last return its columns. Null and empty texts go in the first stage, for want of words; given to
a later one they stay (one row of all texts without words, in the second) and encode to nothing. Rows with a null
id are judged like any other. Of repeated rows the second stage leaves one. An empty table gives an
empty one.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clusterkit.llm.bpe_trie import bpe_digest  # noqa: E402
from clusterkit.llm.common import table, written  # noqa: E402
from clusterkit.llm.decontaminate import keep_clean  # noqa: E402
from clusterkit.llm.pii import mask_pii  # noqa: E402
from clusterkit.llm.quality import keep_good  # noqa: E402
from clusterkit.llm.queries import vocabulary_path  # noqa: E402
from clusterkit.llm.simhash import keep_one  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects."""
    return keep_good(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: similarity of 0.8 by shingles of five words."""
    return keep_one(docs, size=5, similarity=0.8)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of the benchmark."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked."""
    out = mask_pii(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    return bpe_digest(docs, vocabulary_path())


STAGES = [("quality", quality), ("simhash", simhash), ("benchmark", benchmark), ("pii", pii), ("encode", encode)]

#: SQL can express neither the sketches nor the merges; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
