"""From raw documents to packed sequences: five stages, each on all that the one before kept.

A stage is a function of (spark, docs, sf_dir) that gives a DataFrame; what it decides takes effect in its rows.
All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from floeframe.llm import near_copies, packing, personal, quality_rules, weak_labels
from floeframe.llm.common import new_path, removed, scratch, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly labelled classifier keeps."""
    return weak_labels.passed(docs)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.passed(docs, table(spark, sf_dir, "labels"))


def near_copy_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return near_copies.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what discloses it replaced in their texts; n_chars is that of the new text."""
    return personal.sanitised(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences."""
    return packing.packed_sequences(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("near copies", near_copy_removal),
    ("personal data", personal_data),
    ("packing", packed),
]

#: No SQL: the classifiers are trained and the packing is a search. Tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. They are read from the last written table; those before are removed once they were read."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), name, path)
        if before:
            removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
