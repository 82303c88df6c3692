"""A corpus pipeline of five stages over `documents`, each calling one operator of corpusloom.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents. `run`
writes what a stage returns as Parquet in the shared folder and reads it as the next stage's documents.

Rejected: documents without a letter or in no learned language (language ID), documents predicted to be of low quality
(quality classifier), all but the document of least id of each group of near copies (n-gram Jaccard join), documents
that share a window with a benchmark item (decontamination). What is left is encoded (BPE).

Defined cases, for every stage: null and empty texts are texts without words; null ids are ids like any other; repeated rows
are decided alike (near copies keep one of them); an empty table gives an empty table; extra columns of any name are carried
along in a struct and come back as they were.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import bpe, decontamination, jaccard, langid, quality
from corpusloom.llm.common import table, written

TOKENIZER = "word_bpe_49k.json"
#: The measure of near copies in the pipeline; op10_jaccard has values of its own.
WORDS, PERCENT = 5, 80


def _carried(docs: DataFrame) -> dict:
    return {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without text or letters go, whatever their id."""
    found = langid.predicted(docs, langid.learned(docs), _carried(docs))
    return found.where("res.lang_pred <> 'und'").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality is at least one half; an empty or null text is scored like any other."""
    stats = quality.stats_table(docs, _carried(docs))
    return quality.scored(stats, quality.learned(stats, table(spark, sf_dir, "labels"))).where("res.predicted = 1").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by 5-word sets of similarity 0.8 or more: the one of least id.

    Documents are told apart by id and text, so a null id or one id with several texts loses none. Null ids count as the
    greatest; among equal ids the least hash decides. Of rows with one id and one text the one of least source stays, and
    among those that of the least hash of the whole row. Documents without words are near copies of nothing. At this threshold
    candidates come from keys of minimum hashes; a link is missed with a chance of less than 1e-9.
    """
    mark = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")
    kept = jaccard.representatives(docs, mark, k=WORDS, percent=PERCENT, keys="minima").select(F.col("mark").alias("kept"))
    hashable = [c for c, f in zip(_carried(docs).values(), docs.schema) if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    order = F.struct(F.col("source").alias("source"), F.xxhash64(*hashable).alias("hash"))
    rows = docs.select(F.struct(*_carried(docs).values()).alias("row"), mark.alias("mark"), order.alias("nth"))
    # repeated rows meet as partial minima, so a text with a third of all rows is one row a partition
    first = rows.groupBy("mark").agg(F.min_by("row", "nth").alias("row"))
    return first.join(kept, first["mark"] == kept["kept"], "left_semi").select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontamination.scan(docs, table(spark, sf_dir, "benchmark"), _carried(docs))
    return found.where("res.n_hit = 0").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids themselves as little-endian 32-bit numbers."""
    found = bpe.encoded(docs, public_tokenizers.path(TOKENIZER), {"doc_id": F.col("doc_id")})
    return found.select("row.doc_id", "res.n_tokens", "res.ids_sha256", "res.decoded_sha256", "res.ids")


STAGES = [
    ("language_id", language_id),
    ("quality", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: SQL cannot express the learned stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(lambda docs, stage: written(stage[1](spark, docs, sf_dir), stage[0]), STAGES, table(spark, sf_dir, "documents"))
