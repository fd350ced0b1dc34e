"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.llm.decontaminate import without_contamination
from dayfold.llm.exact_dedup import exact_dedup
from dayfold.llm.langid import identify_languages
from dayfold.llm.near_dedup import near_dedup
from dayfold.llm.packing import best_fit_pack
from dayfold.llm.tables import Scratch, known_text, read
from dayfold.session import configure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
OTHERS = COLUMNS[1:]


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain enough."""
    configure(spark)
    found = identify_languages(docs, carry=OTHERS)
    return found.where("accepted").select(COLUMNS)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    configure(spark)
    return exact_dedup(docs, carry=OTHERS, store_single=False).where("kept").select(COLUMNS)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    configure(spark)
    row = F.xxhash64("doc_id", known_text("text"))
    found = near_dedup(docs.select("doc_id", "text", row.alias("row")), carry=["row"])
    kept = Scratch(spark, "kept-rows").write(found.where("keep").select("row"))
    return docs.withColumn("row", row).join(kept, "row", "left_semi").select(COLUMNS)


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    configure(spark)
    return without_contamination(docs, read(spark, sf_dir, "benchmark")).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 1024 tokens."""
    configure(spark)
    return best_fit_pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", in_a_language),
    ("exact_dedup", distinct_texts),
    ("near_dedup", no_near_copies),
    ("decontamination", no_benchmark_passages),
    ("packing", packed),
]

# Trigram models, sketches and token ids are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each one's rows written before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
