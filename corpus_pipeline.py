"""Corpus pipeline: documents pass through the stages in order, each written as Parquet and reread for the next."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from relspark.llm.common import materialize, release, table, written
from relspark.llm.minhash import neardup_stage
from relspark.llm.packing import packing_stage
from relspark.llm.pii import pii_stage
from relspark.llm.quality import quality_stage
from relspark.llm.substrings import suffix_stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Tables that stood before the first stage began; None outside a pipeline.
_mark: int | None = None


def _first(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _mark
        _mark = written()
        return stage(spark, docs, sf_dir)

    return run


def _next(stage: Stage) -> Stage:
    """A later stage gets what its predecessor has written whole, so the tables behind that result go first."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _mark is not None:
            release(docs, _mark)
        return stage(spark, docs, sf_dir)

    return run


#: Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
STAGES = [
    ("quality rules", _first(quality_stage)),
    ("MinHash near-dedup", _next(neardup_stage)),
    ("suffix-array dedup", _next(suffix_stage)),
    ("PII", _next(pii_stage)),
    ("best-fit packing", _next(packing_stage)),
]

#: The stages learn a classifier and run tokenizers, which SQL can't state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
