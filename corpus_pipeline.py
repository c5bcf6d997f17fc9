"""A corpus pipeline over ``documents``: language, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next stage's ``docs``. All but the last return the columns of
``documents``; a document that a stage drops is gone for the rest.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genesieve.llm.bin_packing import pack_documents
from genesieve.llm.common import free_name, materialise, with_row_key
from genesieve.llm.exact_dedup import exact_dedup
from genesieve.llm.language_id import UNKNOWN, held_out, predict, train_on
from genesieve.llm.near_dedup import near_duplicates
from genesieve.llm.pii import redact, train


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language the network is sure of; those without text or without a letter go as well.

    The network and the score that it has to reach are learned from the labelled documents. Without
    any label there is nothing to judge by, and every document goes.
    """
    net = train_on(docs.where(~held_out()))
    names = free_name("_lang", docs.columns), free_name("_sure", docs.columns)
    judged = predict(docs, net, keep=tuple(docs.columns), names=names)
    return judged.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= net.least_score)).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row stays: that with the largest id, and the last in the table of equal ids. Null ids come first."""
    return _only_kept(docs, lambda keyed, row: exact_dedup(keyed, row_col=row))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class, one row stays: that with the least id, and the first in the table of equal ids. Null ids come last."""
    return _only_kept(docs, lambda keyed, row: near_duplicates(keyed, row_col=row))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; every document stays."""
    return redact(docs, train(spark, docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces stand in the training sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _only_kept(docs: DataFrame, judge: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows that ``judge`` keeps. Rows are told apart by their place in the table, so null and repeated ids are rows like others."""
    row = free_name("_row", docs.columns)
    keyed = with_row_key(docs, row)
    dropped = judge(keyed, row).where("not kept").select(row)
    return keyed.join(dropped.hint("shuffle_hash"), row, "left_anti").select(*docs.columns)


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("pii", personal_data), ("packing", packing)]

#: Trained models and sketches can't be put in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
