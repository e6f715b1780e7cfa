"""A corpus pipeline of five operators: language, near copies, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet in the shared folder and the next stage reads that.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.llm import langcrf, lshforest, packing, repeats, secrets
from claimspark.llm.queries import public_file
from claimspark.llm.store import written
from claimspark.session import package_on_workers

#: A text of at least ``ENOUGH_WORDS`` words counts as none of the languages if the lexicon has a smaller share of them
#: than this.  Half of the least share of held-out labelled texts of that length (0.10).
MIN_KNOWN_SHARE, ENOUGH_WORDS = 0.05, 30
WINDOW, END_ID = 2048, 1
#: Texts tokenised together: few, as workers and executors still hold what earlier stages left.
PACKED_BYTES = 1 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no learned language: without a letter, or long enough to tell and of unknown words."""
    model = langcrf.learn(docs.where(~langcrf.held_out("doc_id", 4, 2)))
    judged = langcrf.identify(docs, model)
    unknown = (F.col("n_words") >= ENOUGH_WORDS) & (F.col("known_share") < MIN_KNOWN_SHARE)
    fits = (F.col("lang_pred") != langcrf.UNDETERMINED) & ~unknown
    return judged.where(fits).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class (0.8 of the five-word shingles), that with the smallest id; of
    repeated rows one."""
    judged = lshforest.classes(docs.select("doc_id", "text"), width=5, percent=80, with_hash=True)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), "text_hash").distinct()
    left = docs.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.xxhash64("text") == F.col("text_hash")), "left_anti")
    # Rows with one id are copies of each other or, with unlike texts, documents of their own.
    return left.where("doc_id IS NULL").unionByName(left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out passages that a document with a smaller id has; characters cut in half go whole."""
    cut = repeats.remove(docs, length=50)
    text = F.when(F.size("removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn(
        "n_chars", F.when(F.size("removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in the place of every secret."""
    found = secrets.find(docs)
    text = secrets.redacted(F.col("text"), F.col("spans"))
    return found.withColumn("text", text).withColumn(
        "n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most ``WINDOW``."""
    tokens = packing.tokenized(docs, public_file("word_bpe_49k.json"), window=WINDOW, end_id=END_ID,
                               text_bytes=PACKED_BYTES)
    return packing.pack(tokens, window=WINDOW)


#: Columns the stages work on; any further ones pass through under names that no operator uses.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_package(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        package_on_workers(spark)
        inside = docs.toDF(*[c if c in COLUMNS else f"further_column_{i}" for i, c in enumerate(docs.columns)])
        out = stage(spark, inside, sf_dir)
        return out.toDF(*docs.columns) if stage is not packed else out
    return run_stage


STAGES = [(f.__name__, _with_package(f)) for f in (language, near_copies, passages, without_secrets, packed)]

# Several stages have no form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
