"""From documents to packed training sequences, in five stages.

Each stage calls one operator on all that its predecessor kept; its result is
written as Parquet and read again for the next. All but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspine.llm import language, lines, mixing, packing, simhash
from creditspine.sources.session import delete_folder, scratch, scratch_scope, tune


#: Documents handed to a Python worker at a time: long texts in Spark's 10,000 fill hundreds of MB on both sides.
DOCS_PER_BATCH = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings of the stages that run Python over texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(DOCS_PER_BATCH))
    return tune(spark)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without letters go."""
    prepared(spark)
    model = language.fit(docs, public_tokenizers.path("piece_bpe_32k.model"), F.lit(True))
    return language.keep_identified(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays."""
    return lines.drop_common_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs, width=3, max_distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a training sequence."""
    prepared(spark)
    pieces = packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packing.pack(packing.with_checksum(pieces))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Segmentation models, 64-bit hashes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole table of documents.

    What a stage stores on its way goes when its result is written, and that
    result when the next one is, so at most two copies of the corpus lie stored.
    """
    out, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = scratch(spark, name)
        with scratch_scope(spark):
            stage(spark, out, sf_dir).write.parquet(folder)
        if before:
            delete_folder(spark, before)
        out, before = spark.read.parquet(folder), folder
    return STAGES[-1][1](spark, out, sf_dir)
