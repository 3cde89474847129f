"""The registered queries of this subpackage: each reads its whole table and digests an operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandflow.llm import ann, best_fit, bpe, hard_negatives, langid, merkle, minhash, packing, quality, recompress, suffix, token_counts, toxicity


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4)


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without a doc_id is neither held out nor learned from: held_out is null."""
    docs = table(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    found = langid.predict(docs, langid.fit(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.attribute(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    altered = merkle.leaf(*(more if c == "n_chars" else F.col(c) for c in merkle.FIELDS))
    found = merkle.manifest(docs, F.when(chosen, altered))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """By name; their SQL is in `oracle`."""
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
