"""Five stages over ``documents``, each an operator of ``ledgertalk.llm``.

Every stage takes what the one before wrote. The quality classifier and the quality rules drop
what they reject, the n-gram Jaccard join keeps one document of each group of near
duplicates, personal data is replaced in the texts, and the last stage packs the texts into
training sequences. All but the last return the columns of ``documents``, whatever they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgertalk.llm import jaccard, packing, pii, quality_lm, quality_rules
from ledgertalk.llm.common import table
from ledgertalk.sources.scratch import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# Words that a worker remembers in the last stage: workers live through all stages.
REMEMBERED = 100_000
# Near duplicates: five words and a similarity of 0.8 or more.
NEAR = jaccard.Linking(words=5, percent=80)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text is not too high for their language."""
    return quality_lm.keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rule_cascade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id."""
    return jaccard.one_of_each(docs, NEAR)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER, remembered=REMEMBERED)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rule_cascade),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# A language model, a trained tagger and best-fit packing have no SQL; tests compare the whole
# run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
