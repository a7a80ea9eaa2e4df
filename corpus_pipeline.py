"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame.  Every stage but
the last returns the columns of ``documents``:

* ``toxicity``: rows that the ordinal model calls toxic go;
* ``near_duplicates``: of each component of texts with a Jaccard similarity of 0.8 on five-word shingles, the smallest id stays;
* ``repeated_passages``: passages of fifty words or more that an earlier document holds are cut from the later one; a text left without words goes;
* ``secrets``: live credentials are replaced by a mark; widely copied examples stay;
* ``packing``: the texts become pieces of windows of 4096 tokens.

A null text passes every filter as an empty text; a null id is never a duplicate.  An empty table passes through.
There is no SQL for the model and the tokenizer, so the result is tested against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecheck.llm import chaining, jaccard, packing, secrets, toxicity
from tablecheck.llm.common import materialise


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    prefix = "model_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return toxicity.score(docs, model, prefix=prefix).where(f"not {prefix}toxic").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard.jaccard_join(docs, k=5, percent=80)
    gone = groups.where("component_id is not null").groupBy("doc_id").agg(F.max(F.col("component_id") == F.col("doc_id")).alias("stays")).where("not stays")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(chaining.cut_passages(docs, chaining.passages(docs)))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redact(docs, secrets.scan(docs, repo=F.concat_ws("/", "source", "lang"))))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), end_id=2))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("secrets", redact_secrets),
    ("packing", pack_windows),
]

#: A fitted model and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
