"""A text corpus made ready for training, in stages that each write a table for the next one."""

from __future__ import annotations

from pyspark.sql import functions as F

from accesstally.llm import bpe, decontaminate, language, near_duplicates, secrets
from accesstally.llm.text import unused
from accesstally.sources.scratch import scratch_path, written


def known_language(spark, docs, sf_dir):
    """Documents without a language go."""
    return language.keep_known(docs, language.learn(docs))


def one_of_each_group(spark, docs, sf_dir):
    """Of near duplicates the one with the smallest number stays."""
    return near_duplicates.keep_one(docs)


def without_benchmark(spark, docs, sf_dir):
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark, docs, sf_dir):
    """All documents stay; secrets in them are masked."""
    found = unused(docs, "_found")
    masked = secrets.redact(docs, secrets.by_document(secrets.scored(docs)), found=found)
    length = F.when(F.size(f"{found}.secrets") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", length).select(docs.columns)


def encoded(spark, docs, sf_dir):
    """Token ids of what is left."""
    import public_tokenizers  # only this stage needs the vocabulary files

    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", encoded),
]

#: The learned stages and the tokenizer's merges are no SQL: tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows; every earlier stage is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, scratch_path(spark, f"pipeline-{name}"))
    return docs
