"""From raw documents to tokens: five stages, each written as Parquet and read again.

quality        the classifier's rejects go
near_duplicates  one document of each group of near duplicates stays (five-word
               shingles, Jaccard similarity of 0.8 or more): the smallest id
repeats        bytes of 50-byte strings that a smaller document holds are cut out of the texts
benchmark      documents that hold a benchmark window go
tokens         ids of the remaining texts, and the hashes of ids and decoded texts

Each function takes (spark, docs, sf_dir); all but the last return the columns
of ``docs``.  ``n_chars`` follows the text where it is cut.  Edge cases are those of
the operators: null texts count as empty, repeated rows stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.bpe_codec import bpe_digests
from skytally.llm.decontamination import clean
from skytally.llm.jaccard_join import one_of_each
from skytally.llm.quality_classifier import accepted
from skytally.llm.queries import tokenizer
from skytally.llm.shared import table, written
from skytally.llm.suffix_dedup import deduplicated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, width=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = deduplicated(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digests(docs, tokenizer("byte_bpe_50k.json"), with_ids=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("benchmark", benchmark), ("tokens", tokens)]

#: SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
