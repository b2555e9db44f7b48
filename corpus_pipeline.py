"""From raw documents to encoded training data: five stages, each over all that the one before has kept.

Every stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as the next one's
``docs``, so an executor lost later costs no earlier stage. All but the last return the columns of ``documents``.

A null text is an empty one. It is scored by the classifier's offset alone, is equal to other texts of white space only,
shares no words with any other and holds no item; it encodes to no tokens. Of rows that are there twice one stays, as of
other copies; ties of length go to the smaller doc_id. A missing doc_id comes after all others. An empty table gives an
empty result; columns beside those of ``documents`` are carried along by all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from railwatch.llm import bpe, chosen_path, decontaminate, exact_dedup, quality, shared
from railwatch.llm.queries import held_out, table, tokenizer_path
from railwatch.sources.tables import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(make: Stage) -> Stage:
    """A stage that first frees what earlier ones sent to the executors, as their rows are stored by then."""

    @wraps(make)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        shared.release()
        return make(spark, docs, sf_dir)

    return run_stage


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score below 0.3. The model learns from the labelled ones among ``docs``, but for those held
    out."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out(5, 0))
    return quality.keep_good(docs, model, least=0.3)


@stage
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest stays, then the one of smallest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 over runs of five words, that of smallest doc_id stays."""
    return chosen_path.keep_one_per_class(docs)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage
def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the text they decode to."""
    return bpe.encode_documents(docs, tokenizer_path(), full=True).drop("decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: The classifier, the join and the encoding have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
