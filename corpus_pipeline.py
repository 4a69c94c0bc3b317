"""Prepares a corpus of documents for training: toxic documents out, one of each group of near
duplicates, no benchmark passages, personal data masked, sources mixed to their weights.

Stages take any table of documents with doc_id, text and source: nulls in any column, repeated rows, equal
ids, columns of any other name, no rows. All but the last give the columns they were given."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from txnguard.llm import dart, mixing, spans, suffix, toxic
from txnguard.llm.queries import toxic_model
from txnguard.session import shared_folder
from txnguard.sources.tables import read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain field, trained on the labels that may be learned from, finds toxic go.

    Null and empty texts are scored like any, whole however long. Repeated rows are judged alike.
    """
    return toxic.reject_toxic(docs, toxic_model(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id stays.

    Null and empty texts are one class. Of repeated rows one stays; a null id comes last.
    """
    return dart.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark passages go; those without words stay.

    Repeated rows are judged each for itself.
    """
    return suffix.decontaminate(docs, read_table(spark, f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked, and n_chars, where there is such a column, follows the text. No row goes;
    null texts stay null."""
    length = "n_chars" if "n_chars" in docs.columns else None
    return spans.mask(docs, spans.train(docs), length_col=length)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with how often it repeats each and how many of its words it takes.

    Documents without words are not in it. Where a column has the name of one of the plan's, the plan's is
    called ``mix_`` and that.
    """
    plan = mixing.plan_mix(docs, carried=docs.columns).where("taken > 0")
    named = []
    for column in ("size", "source_size", "target", "repeats", "extra", "taken"):
        name = column
        while name in docs.columns:
            name = f"mix_{name}"
        named.append(plan[column].alias(name))
    return plan.select("row.*", *named)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: Stages by trained models and signatures have no SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as a table before the next reads it."""
    folder = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = read_table(spark, f"{folder}/{name}")
    return docs
