"""From raw documents to a tokenised training mix, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``, takes all rows that its
predecessor kept and calls one operator of ``tracknet.llm``. All but the last
return the columns of ``documents``:

1. quality rules: rows whose posterior quality is too low, or that fail the
   base rules, go;
2. near duplicates: one row of each class stays;
3. substring dedup: passages that occurred before are cut out of the texts;
   a text of which nothing remains stays as an empty one;
4. mixing: rows are repeated, or left out, so that sources meet their targets;
5. byte-level BPE: ids of every text, and a digest of what they decode to.

Null and empty texts fail the quality rules. Rows equal in id and text are one
document from the second stage on; null ids are kept and decided by row. An
empty table gives an empty result. Extra columns pass through all but the last
stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracknet.llm import bpe, hyperminhash, mixing, quality, queries, substring
from tracknet.plans.iterate import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hyperminhash.keep_representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)``; ids are packed as little-endian unsigned 32-bit integers."""
    coded = bpe.digest_documents(docs, *queries.vocabulary(), keep_ids=True)
    return coded.select("doc_id", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: SQL cannot express the encoding; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again before the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
