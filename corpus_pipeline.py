"""A corpus pipeline: language ID, near-duplicate removal, decontamination, secret removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. It is written as Parquet to the shared
folder and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import decontamination, jaccard_join, language_id, packing, secret_scan
from scorewright.llm.common import stored
from scorewright.llm.queries import tokenizer_path
from scorewright.session import shared_folder

#: Packing has no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Bytes of rows that a Python worker is handed at once. Spark hands over up to 10,000 rows or 64 MB, and holds them
#: several times outside its heap: as Arrow vectors, as the message, and in the worker.
BATCH = 2 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, whose workers get their rows in batches of `BATCH` bytes. The session keeps the setting, as the
    stage's rows are computed only when they are written."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_BYTES, BATCH)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, so that their language can be told; those without text or letters go.

    Learns from the documents' own labels. Rows with null ids stay if their text has letters; repeated
    rows are judged alike. Without labelled rows nothing was learned, and all texts with letters stay."""
    return language_id.keep_told(docs.select(*COLUMNS), language_id.fit(docs))


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows linked by five-word shingles at 0.8 or more, one row stays: the one with the smallest id,
    then with the smallest hash of its text. A null id comes after all others, and its row is linked like any other.

    Rows are told apart by a number of their own, so a repeated id says nothing: its rows stay or go by their
    groups. A row without words is its own group; repeats of it under the same id are one."""
    rows = stored(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = jaccard_join.jaccard_components(rows, size=5, percent=80, id_col="_row").toDF("_row", "n", "group")
    wordless = F.col("n") == 0
    rank = rows.select("_row", "doc_id", F.xxhash64(F.col("text").cast("binary")).alias("hash")).join(groups, "_row")
    keep = rank.groupBy(
        F.when(~wordless | F.col("doc_id").isNull(), F.col("group")).alias("g"),
        F.when(wordless, F.col("doc_id")).alias("i"),
        F.when(wordless, F.col("hash")).alias("h"),
    ).agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "hash", "_row")).alias("first"))
    return rows.join(keep.select("first._row"), "_row", "left_semi").select(*COLUMNS)


@in_small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found, _ = decontamination.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = found.filter("n_hit > 0").select(F.col("row").alias("_row")).distinct()
    rows = docs.select(*COLUMNS).withColumn("_row", F.xxhash64(F.col("text").cast("binary")))
    return rows.join(hit, "_row", "left_anti").select(*COLUMNS)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret in their texts is replaced by a mark, and n_chars follows."""
    cuts = secret_scan.cut_offs(docs.select(F.coalesce("text", F.lit("")).alias("text")), 0.01)
    rows = secret_scan.with_spans(docs.select(*COLUMNS).withColumn("_text", F.coalesce("text", F.lit(""))), "_text", "_spans", cuts)
    rows = rows.withColumn("text", secret_scan.redacted(F.col("text"), F.col("_spans")))
    return rows.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", remove_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/scorewright/pipeline-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH_BYTES)
    try:
        for name, stage in STAGES:
            path = f"{folder}/{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        spark.conf.set(BATCH_BYTES, before)
    return docs
