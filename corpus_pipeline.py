"""From raw documents to token ids: language ID, SimHash near-dedup, substring dedup, mixing to target weights, SentencePiece.

Stages take documents (doc_id, text, lang, source, n_chars) with any further columns, whatever their names, and keep all columns; the last one
returns tokens instead. An empty table gives an empty result. Nulls and repeated rows: see each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import langid, mixing, pieces, simhash, substring
from folioforge.llm.common import Scratch, released


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some language claims. Prototypes come from the labelled documents that are not held out, without an id or a lang a row only
    is judged. Null texts and texts without a letter go; repeated rows go or stay together; of equally near languages it matters not which."""
    return langid.keep_identified(docs, langid.train(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near-duplicates, joined by pairs of a similarity of 0.8 or more of their sets of five-word
    shingles. Null, empty and blank texts are alike, so one stays; rows without doc_id stay; rows that repeat a doc_id go or stay together."""
    return simhash.first_of_each(docs, k=5, similarity=0.8, recall=0.97)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that a document of smaller doc_id has too; a document left without a word goes. Null texts
    and rows without doc_id stay as they are; rows that repeat a doc_id are one document's and take nothing from each other."""
    return substring.deduplicate(docs, size=50)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Null is a source like any other; texts without words, null ones
    among them, are taken once; repeated rows are mixed each by itself, all alike."""
    return mixing.mixed_rows(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_chars, n_tokens, ids_sha256, decoded_sha256, same, ids) of each row, checked by decoding; text, lang, source and other columns
    are not carried on. Null text: no tokens, and same is null; a row for each row, so repeated rows stay."""
    return pieces.round_trip(docs, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, before = Scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with released():
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
