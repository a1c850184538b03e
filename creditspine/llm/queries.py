"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspine.llm import (
    collocations, embeddings, filter_audit, harmonic, language, lines, mixing, neighbours, packing, records, secret_scan, simhash, urls,
)
from creditspine.llm.common import read
from creditspine.sources.session import scratch, tune


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(tune(spark), sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0, k=10)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(read(tune(spark), sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_groups(read(tune(spark), sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read(tune(spark), sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(tune(spark), sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(read(tune(spark), sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packing.pack(packing.with_checksum(pieces))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read(tune(spark), sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(tune(spark), sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = language.fit(docs, public_tokenizers.path("piece_bpe_32k.model"), ~held_out)
    out = language.predict(docs.select("doc_id", "text"), model)
    return out.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(tune(spark), "records")
    docs = read(spark, sf_dir, "documents")
    records.write_records(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return records.read_records(spark, folder, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(read(tune(spark), sf_dir, "documents"), width=3, max_distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(tune(spark), sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(tune(spark), sf_dir, "documents"), longest=4, least=30, share=80, top=2000)


def op13_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(tune(spark), sf_dir, "documents")
    return packing.with_checksum(harmonic.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


QUERIES = {f.__name__: f for f in (
    op1_nearest_neighbours, op2_secret_scan, op3_embedding_dedup, op4_line_dedup, op5_url_filter, op6_best_fit_packing,
    op7_source_mixing, op8_language_id, op9_token_records, op10_simhash_dedup,
    op11_filter_audit, op12_phrase_collocations, op13_harmonic_packing,
)}
