"""The registered queries of the numbered operators: each applies one to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.llm import (
    bpe, crosstok, distribution, idfiles, langcrf, lshforest, manifest, mixture, packing, repeats, secrets, vafile, wordlm)
from claimspark.llm.store import written
from claimspark.session import checkpoint_dir, package_on_workers


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    package_on_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def public_file(name: str) -> Callable[[], str]:
    """A function that finds a public tokenizer's file where it is called, on the driver or in a task."""
    def path() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)
    return path


def op1_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.judge(_read(spark, sf_dir, "documents"))


def op2_langcrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", langcrf.held_out("doc_id", 4, 2).alias("held_out"))
    model = langcrf.learn(docs.where(~F.col("held_out")))
    return langcrf.identify(docs.select("doc_id", "text", "held_out"), model).drop("text")


def op3_grulm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordlm.score(_read(spark, sf_dir, "documents"), langcrf.held_out("doc_id", 5, 1))


def op4_mixcoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    idfiles.write(_read(spark, sf_dir, "documents"), path, public_file("word_bpe_49k.json"), end_id=1)
    pieces = written(idfiles.read(spark, path).withColumn("crc", F.crc32("ids")).drop("ids"), "pieces")
    return idfiles.documents(pieces)


def op5_lshforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lshforest.classes(_read(spark, sf_dir, "documents"), width=5, percent=85)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs).drop("text")

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def listed(spans: Column | str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(listed(of(*secrets.BASE_KINDS)), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op7_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vafile.integer_vectors(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256)
    return vafile.top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = packing.tokenized(_read(spark, sf_dir, "documents"), public_file("word_bpe_49k.json"), window=2048, end_id=1)
    return packing.pack(tokens, window=2048)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary, pattern = public_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encode(docs, vocabulary, pattern, bytes_col="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove(_read(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(_read(spark, sf_dir, "documents"), weights=(3, 1, 2), percent=150, most=2)


def op12_postorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proofs(_read(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 0)


def op13_crosstok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.align(_read(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"), public_file("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_distribution": op1_distribution,
    "op2_langcrf": op2_langcrf,
    "op3_grulm": op3_grulm,
    "op4_mixcoder": op4_mixcoder,
    "op5_lshforest": op5_lshforest,
    "op6_secrets": op6_secrets,
    "op7_vafile": op7_vafile,
    "op8_packing": op8_packing,
    "op9_bpe": op9_bpe,
    "op10_repeats": op10_repeats,
    "op11_pareto": op11_pareto,
    "op12_postorder": op12_postorder,
    "op13_crosstok": op13_crosstok,
}
