"""Registered queries of the numbered operators and of the corpus pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import oracle
from cardwatch.llm.common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cardwatch.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        rank_file=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.setjoin import join_components

    return join_components(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.decontaminate import find_matches

    return find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.pii import find_pii

    return find_pii(table(spark, sf_dir, "documents"))


def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cardwatch.llm.lattice import score

    return score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.licences import find_licences

    return find_licences(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cardwatch.llm import byte_bpe

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern).drop("text")
    both = byte_bpe.decode(coded, ranks, pattern)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.quality import judge

    return judge(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.linededup import duplicates

    return duplicates(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    return langid.classify(docs.select("doc_id", (~langid.learning_expr()).alias("held_out"), "text"), model).drop("text")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.trie import prefix_nodes

    return prefix_nodes(table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.codes import compress

    return compress(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_lattice_lm": op5_lattice_lm,
    "op6_licences": op6_licences,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality": op8_quality,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_sharding": op13_sharding,
}
ORACLE: dict[str, str] = {
    "op8_quality": oracle.QUALITY,
    "op11_prefix_trie": oracle.TRIE,
    "op12_vector_codes": oracle.CODES,
    "op13_sharding": oracle.SHARDING,
}
