"""From documents to tokens: quality rules, near duplicates, personal data, source mix, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's documents. All stages but the last
return the columns they were given.

Odd rows, in every stage: a null text counts as empty and, having under 20 words, goes with the quality
rules; null languages and sources are groups like any other; rows with null or repeated ids are
rows of their own, and of repeated rows one stays; texts of any length go through whole;
columns beyond those of documents are carried along whatever they are called, up to the last stage; an
empty table gives empty tables.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm import chunk_bpe, jaccard_join, mixing, pii_crf, quality_rules, scratch
from visitmap.llm.queries import word_bpe
from visitmap.session import apply, scratch_path

#: What Spark hands to Python at once: the JVM and the worker each hold a batch whole, beside a heap that
#: earlier stages have filled. Spark's own bound is 64 MB.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "1m"}
#: Words whose tokens a worker remembers; its memory stands beside that heap, too.
REMEMBERED = 50_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the corpus' own thresholds reject go."""
    return quality_rules.keep_documents(spark, docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 over five-word shingles one stays."""
    return jaccard_join.keep_one_of_each(spark, docs, size=5, percent=80)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii_crf.mask_documents(spark, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mix_documents(spark, docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, their number, and the text they decode to."""
    path = word_bpe()
    carry = [c for c in ("lang", "source", "n_chars") if c in docs.columns]
    out = chunk_bpe.encode_corpus(spark, docs, path, carry=carry, decode_to="decoded", remember=REMEMBERED)
    return out.withColumn("n_tokens", F.expr("octet_length(ids) div 4"))


_left: list[str] = []  # what earlier stages wrote for themselves


def after_the_one_before(stage):
    """The stage, once the tables that the stages before it wrote for themselves are removed.

    A stage gets the written result of the one before, so those have been read for the
    last time; tables that ``docs`` itself still reads are left, and so are all that
    other callers of the operators wrote.

    Its result is worked out when the caller writes it, so the session is left with ``BATCHES``.
    """
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for k, v in BATCHES.items():
            spark.conf.set(k, v)
        scratch.drop_unread(spark, _left, docs)
        before = set(scratch.tables())
        out = stage(spark, docs, sf_dir)
        _left[:] = [p for p in scratch.tables() if p in _left or p not in before]
        return out

    return run_stage


STAGES = [
    (name, after_the_one_before(stage))
    for name, stage in (
        ("quality_rules", quality_stage),
        ("near_duplicates", near_duplicate_stage),
        ("personal_data", personal_data_stage),
        ("source_mixing", mixing_stage),
        ("bpe", bpe_stage),
    )
]

#: Sketch thresholds, a trained field and BPE aren't SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with apply(spark, BATCHES):
        for name, stage in STAGES:
            path = scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
