"""The registered queries of the corpus operators: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.llm import decontaminate, langid, lines, media, merkle, mixing, sharding, simhash, substrings, tokens, toxicity, urlfilter, vectors
from rastra.llm.common import table
from rastra.llm.oracles import oracle_sql as oracle_sql


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"), shingle=4, min_match=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs, n_shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored_media(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The public tokenizer that the query applies; a path to any other file does as well.
def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, manifest = tokens.write_tokens(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=2)
    return tokens.token_digests(path, manifest)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=50)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix_sources(docs, weights=(5, 2, 1), share=1.5, ceiling=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: Host, path and action of the rules that the query applies (fixed values).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    judged = urlfilter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.drop_repeated_lines(table(spark, sf_dir, "documents"), min_chars=10, min_docs=2)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectors.compress_vectors(table(spark, sf_dir, "embeddings"), n_parts=8, n_entries=16, rounds=6)
    return coded.withColumn("codebooks_sha256", F.lit(vectors.books_sha256(books)))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    proofs = merkle.dataset_manifest(table(spark, sf_dir, "documents"), fanout=16).proofs
    folded = proofs.withColumn("folded_root", merkle.fold(F.col("altered"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_sharding": op2_sharding,
        "op3_media": op3_media,
        "op4_toxicity": op4_toxicity,
        "op5_tokens": op5_tokens,
        "op6_substrings": op6_substrings,
        "op7_decontamination": op7_decontamination,
        "op8_mixing": op8_mixing,
        "op9_url_filter": op9_url_filter,
        "op10_language": op10_language,
        "op11_line_dedup": op11_line_dedup,
        "op12_vector_codes": op12_vector_codes,
        "op13_merkle": op13_merkle,
    }
