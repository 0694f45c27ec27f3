"""Queries of the operators, with the parameters meant for production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import exact, mixing, packing, quality, repeats, repetition, shards, simhash, spelling, syncmers, templates, tries, url_rules
from .common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of documents that an earlier document has, removed."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the repetition verdict on every document."""
    return repetition.judge(table(spark, sf_dir, "documents"))


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return templates.extract(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    json_path, ranks_path = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.pack(table(spark, sf_dir, "documents"), str(json_path), str(ranks_path))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and the components of their links."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over 16 shards of nearly equal bytes."""
    return shards.shard(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents and the one of each that stays."""
    return exact.mark_copies(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the form that they are likely a variant of."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations."""
    return tries.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_suffix_dedup, op2_quality, op3_repetition, op4_templates, op5_packing, op6_mixing, op7_syncmers, op8_simhash, op9_url_rules, op10_shards,
        op11_exact_dedup, op12_spelling, op13_conversation_trie,
    )
}
