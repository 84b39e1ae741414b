"""The corpus pipeline: documents through five stages, each written as Parquet and reread by the next.

1. ``toxicity``   documents scored toxic go;
2. ``near_dedup`` one document of each group of near duplicates stays (the smallest id);
3. ``decontaminate`` documents that hold a benchmark window go;
4. ``pii``        personal data in the texts is replaced by its kind in brackets;
5. ``packing``    the rest is tokenised and packed into sequences of 2048 tokens.

All stages but the last return the columns of ``documents``.  Rows are filtered by
semi joins on doc_id, so repeated rows of an id share their fate; documents with a
null doc_id pass the filters unchanged.  Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as decon
from tidemark.llm import near_dup, packing, toxicity
from tidemark.llm import pii as personal
from tidemark.llm.common import read_table
from tidemark.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose id is not in ``gone`` (doc_id)."""
    out = docs.join(gone.select(F.col("doc_id").alias("gone_id")).distinct(), F.col("doc_id") == F.col("gone_id"), "left_anti")
    return out.select(*[c for c in COLUMNS if c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.clean(docs.select(*[c for c in COLUMNS if c in docs.columns]), model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, near_dup.near_duplicates(docs).where("NOT kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, decon.find(docs, read_table(spark, sf_dir, "benchmark")))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal.redacted(docs.select(*[c for c in COLUMNS if c in docs.columns]))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, cache_bytes=48 << 20)  # its workers hold other stages' memory too


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact_pii),
    ("packing", pack_documents),
]

# tokenisation, the trained models and shingle components have no SQL form; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, "pipeline", name)
        out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
