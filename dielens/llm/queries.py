"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dielens.llm import (
    bpe,
    licenses,
    lines,
    lm,
    mixing,
    packing,
    prefixes,
    quality,
    runs,
    simhash,
    suffixes,
    toxicity,
    vectors,
)
from dielens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS)
    return bpe.digests(bpe.encode(docs, path, public_tokenizers.PATTERN), bpe.decoder(docs, path))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_license_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.places(table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.drop_shared_lines(table(spark, sf_dir, "documents")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER)))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(quality.ledger(table(spark, sf_dir, "documents")))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(table(spark, sf_dir, "documents")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(prefixes.rebuilt(table(spark, sf_dir, "conversations")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(table(spark, sf_dir, "documents"), stretch=True))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_license_scan,
        op2_license_places,
        op3_lm_scoring,
        op4_toxicity,
        op5_line_dedup,
        op6_simhash,
        op7_near_vectors,
        op8_packing,
        op9_suffix_dedup,
        op10_quality_rules,
        op11_mixing,
        op12_prefix_trie,
        op13_periodic_runs,
        pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.oracle("documents"),
    "op5_line_dedup": lines.ORACLE.format(documents="documents"),
    "op10_quality_rules": quality.ORACLE.format(documents="documents"),
    "op11_mixing": mixing.ORACLE,
    "op12_prefix_trie": prefixes.ORACLE,
}
