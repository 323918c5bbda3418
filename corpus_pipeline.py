"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next one's ``docs``. All but the last return the columns of ``documents``. A
stage that begins deletes what the one before it kept in the scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import table, written
from eventloom.llm.jaccard_join import one_per_class
from eventloom.llm.packing import pack_documents
from eventloom.llm.pii import redact_documents
from eventloom.llm.quality_rules import keep_good
from eventloom.llm.queries import tokenizer_path
from eventloom.llm.suffix_dedup import without_repeated_bytes
from eventloom.sources.scratch import delete_scratch, release, scratch_paths

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_kept: list[str] = []  # scratch folders of the stage before


def _stage(function: Stage) -> Stage:
    """``function``, after the scratch of the stage before is gone, but for what docs reads."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _kept, keep=docs)
        before = set(scratch_paths(spark))
        result = function(spark, docs, sf_dir)
        _kept[:] = [path for path in scratch_paths(spark) if path not in before]
        return result

    return run_stage


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars as the texts now are."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, by sets of five words at 0.8, the one with the smallest id stays."""
    return one_per_class(docs, width=5, percent=80)


@_stage
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that occur earlier are cut out; emptied documents go."""
    return _counted(without_repeated_bytes(docs))


@_stage
def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _counted(redact_documents(docs))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their places in packed sequences."""
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("pii", pii),
    ("packing", packing),
]

# Learned cut-offs, byte-level tokens and packing have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        delete_scratch(before)
    return STAGES[-1][1](spark, docs, sf_dir)
