"""A training-data pipeline over ``documents``: what each stage keeps is all that the next one sees.

1. toxicity: documents that the classifier, trained on the stage's own labelled rows, rejects go
2. near_duplicates: of each group of near copies the document with the smallest id stays
3. decontamination: documents contaminated by the benchmark go
4. secrets: live-looking values are masked, copied examples stay
5. tokens: what is left is encoded, decoded again and compared

A null text is empty in every stage: it is never toxic, a copy, contaminated or secret. A row that
repeats an id is judged on its own, but of equal rows in a group of copies one stays.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, decontaminate, secret_scan, similarity, toxicity
from sluice.llm.registry import VOCABULARY
from sluice.llm.rows import read_table, staged
from sluice.session import ship_package

ORACLE_SQL = None


def _kept(docs: DataFrame, new: set[str], decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``decide`` leaves, whose operator uses columns ``new``; columns of such names are others meanwhile."""
    mark = "_"
    while any(name.startswith(mark) for name in docs.columns):
        mark += "_"
    away = [mark + name if name.lower() in new else name for name in docs.columns]
    left = decide(docs.toDF(*away))
    return left.select([F.col(f"`{name}`").alias(own) for name, own in zip(away, docs.columns, strict=True)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return _kept(docs, {"score", "predicted"}, lambda df: toxicity.score(df, model).where(F.col("predicted") == 0))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _kept(docs, {"_class", "_root", "_least", "_place"}, similarity.representatives)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    benchmark = read_table(spark, sf_dir, "benchmark")
    return _kept(
        docs,
        {"n_words", "spans", "items"},
        lambda df: decontaminate.hits(df, benchmark).where(~decontaminate.contaminated()),
    )


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _kept(docs, {"_hashes", "_row", "_live"}, secret_scan.masked)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("tokens", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
