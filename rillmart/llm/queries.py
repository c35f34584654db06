"""Named queries of the operators, and checking SQL where SQL can express them."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart.llm import (
    bpe_trie,
    collision_ann,
    decontaminate,
    html_template,
    kneser_ney,
    phrase_automata,
    rans,
    secret_scan,
    simhash,
    spelling_variants,
    suffix_dedup,
    toxicity,
    whitening,
)
from rillmart.llm.common import crc_part, table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; every worker has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op1_bpe_trie(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe_digests(bpe_trie.encode_decode(docs, vocabulary("word_bpe_49k.json")))


def op2_html_template(spark: SparkSession, folder: str) -> DataFrame:
    found = html_template.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc_part("doc_id", 7) == 2
    return kneser_ney.score(docs, kneser_ney.train(docs.where(~held_out)), held_out)


def op4_collision_ann(spark: SparkSession, folder: str) -> DataFrame:
    return collision_ann.nearest(table(spark, folder, "embeddings"), every=50, k=5)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "novel")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(kind) for kind in ("assign", "access", "hex")),
        F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    net = toxicity.fit(docs, table(spark, folder, "labels"))
    rows = docs.select("doc_id", "text", (crc_part("doc_id", 3) == 1).alias("held_out"))
    return toxicity.score(rows, net).select("doc_id", "held_out", "score", "predicted")


def _crc32(batches):
    for rows in batches:
        sums = [zlib.crc32(ids.as_buffer()) for ids in rows.column("ids")]
        sizes = [len(ids.as_buffer()) // 4 for ids in rows.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("start"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def op8_rans(spark: SparkSession, folder: str) -> DataFrame:
    read = rans.round_trip(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return read.mapInArrow(_crc32, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    found = phrase_automata.remove_phrases(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variants(table(spark, folder, "documents"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES = {
    "op1_bpe_trie": op1_bpe_trie,
    "op2_html_template": op2_html_template,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_collision_ann": op4_collision_ann,
    "op5_simhash": op5_simhash,
    "op6_secret_scan": op6_secret_scan,
    "op7_toxicity": op7_toxicity,
    "op8_rans": op8_rans,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_phrase_automata": op11_phrase_automata,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {}
