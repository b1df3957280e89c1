"""Stage functions of the corpus pipeline: (spark, docs, sf_dir) -> documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.tables import table

#: Bytes of a repeated passage that the pipeline removes: below the shortest passages of 50 words.
PASSAGE_BYTES = 250


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees keep."""
    from tessera.llm.op8_quality import fit, judge

    judged = judge(docs, fit(docs, table(spark, sf_dir, "labels")))
    return judged.where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    from tessera.llm.op10_ngram_join import keep_one

    return keep_one(docs, n=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of ``PASSAGE_BYTES`` bytes that start elsewhere too; every document stays, if with less text."""
    from tessera.llm.op6_suffix_dedup import remove_repeats

    left = remove_repeats(docs, PASSAGE_BYTES, want=("kept_text",)).withColumnRenamed("kept_text", "text")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages removed; documents of which they are more than 80 % go."""
    from tessera.llm.op3_decontaminate import mark, remove_hits

    marked = mark(docs, table(spark, sf_dir, "benchmark"))
    return remove_hits(marked).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept document; the text stays with them as the decoded bytes' digest."""
    import public_tokenizers

    from tessera.llm.op9_bpe import encode_decode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(docs, path, public_tokenizers.PATTERN, ("token_ids", "n_tokens", "ids_sha256", "decoded_sha256"))
