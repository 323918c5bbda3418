"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import oracle
from eventloom.llm.class_model import score_texts
from eventloom.llm.common import table
from eventloom.llm.jaccard_join import set_classes
from eventloom.llm.lexical_search import ranked_search
from eventloom.llm.license_scan import scan_licences
from eventloom.llm.order_minhash import compare_with_next
from eventloom.llm.packing import pack_documents
from eventloom.llm.pii import pii_report
from eventloom.llm.piece_encoding import encode_documents
from eventloom.llm.quality_gam import score_documents
from eventloom.llm.quality_rules import quality_report
from eventloom.llm.substring_dedup import remove_repeated_windows
from eventloom.llm.suffix_dedup import remove_repeated_bytes
from eventloom.llm.whitening import whiten


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_classes(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op10_sentencepiece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(
        table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")
    )


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op")}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """The other queries learn, hash or pack: tests hold them against brute force."""
    return {
        "op1_license_scans": oracle.license_scan(),
        "op2_ngram_jaccard_join": oracle.jaccard_classes(),
        "op4_substring_dedup": oracle.substring_dedup(),
        "op13_ranked_lexical_search": oracle.ranked_search(),
    }
