"""The corpus pipeline: quality filter, exact and near deduplication, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which :func:`run` writes to the shared folder as Parquet and
reads again as the next stage's ``docs``. All but the last return the columns of ``documents``: bad documents are gone after the first
stage, copies after the second, all but one document of each near-duplicate group after the third; the fourth leaves out and repeats
documents by their source's target; the last returns pieces of sequences.

A stage deletes what the stage before it staged for itself: its own input is that stage's stored result. Nulls: a null text is the empty
text, a null source is a source of its own, a null id is scored, compared and packed like any other but never a near duplicate. Texts
of any length go through whole. Repeated rows are exact copies, of which one stays. An empty table goes through as an empty table. Other
columns, whatever they are called, are kept up to the last stage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotweave.llm import exact, mixing, neardup, packing, quality, shared
from lotweave.llm.queries import GOOD, table

#: Chunks that a packing worker remembers: executors have other stages' memory to hold, and time to spare.
CHUNKS = 200_000
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_staged: list[str] = []


def cleaning(stage: Stage) -> Stage:
    """``stage``, before which the tables that an earlier stage made on its way go, unless ``docs`` still reads them."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _staged:
            read = docs.inputFiles()
            gone = [p for p in _staged if not any(p.rsplit("/", 1)[-1] in f for f in read)]
            shared.delete(spark, gone)
            _staged[:] = [p for p in _staged if p not in gone]
        shared.tidy(spark)
        with shared.recorded() as made:
            out = stage(spark, docs, sf_dir)
        _staged.extend(made)
        return out

    return run


@cleaning
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score below the limit; learns only from label rows that aren't held out."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.label_bucket("doc_id", 5) != 0)
    score = shared.fresh(docs.columns, "score")
    return quality.scored(docs, model, as_col=score).filter(F.col(score) >= GOOD).drop(score)


@cleaning
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return exact.kept_rows(spark, docs)


@cleaning
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at similarity 0.85 (op4's share, see README), the one with the smallest doc_id stays."""
    return neardup.kept_rows(docs)


@cleaning
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or twice."""
    return mixing.apply_mix(docs)


@cleaning
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; a repeated document is packed as often as it comes."""
    return packing.pack_harmonic(docs, public_tokenizers.path("word_bpe_49k.json"), chunks=CHUNKS)


STAGES = [
    ("quality classifier", quality_stage), ("exact dedup", exact_stage), ("near dedup", near_stage),
    ("source mixing", mixing_stage), ("packing", packing_stage),
]
#: A trained classifier and a tokenizer can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        with shared.recorded() as stored:
            docs = shared.staged(docs, "pipeline-" + name.replace(" ", "-"))
        shared.delete(spark, before)  # the stage's input, now that its result is stored
        before = list(stored)
    return docs
