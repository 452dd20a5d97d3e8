"""The training-data pipeline: five operators of marquee.llm in turn over the documents.

Each stage gets the rows its predecessor kept and returns them as a DataFrame; ``run`` writes every
stage's rows as Parquet and reads them again for the next one. Rows come and go whole, with all
columns; only the masked text of the secret scan changes, and n_chars with it. ``tokens`` adds the
token ids.

Near duplicates go in one stage: SimHash at the radius of op3 finds copies and very close ones, and what has a
five-word similarity of 0.8 or more, which lies beyond any radius that 64 bits can be searched for, goes by its
shingles. Both keep the least id of a group, so no group goes whole.

Defined results for odd rows: a null text counts as empty in every stage. Empty documents score
the share of good labels, form one near-duplicate group, and have no tokens. Rows without doc_id are
never dropped as duplicates. Labels come from the table ``labels`` of the same folder, benchmark items from
``benchmark``; without labels no document is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm.bpe import Codec
from marquee.llm.decontamination import Benchmark
from marquee.llm.quality import CompressionClassifier
from marquee.llm.queries import learning_labels, tokenizer_file
from marquee.llm.secret_scan import mask_secrets
from marquee.llm.simhash import keep_one_per_class
from marquee.llm.similar_texts import without_near_copies
from marquee.llm.workers import prepare
from marquee.session import new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the compression classifier does not reject."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = CompressionClassifier.fit(docs, learning_labels(labels))
    return docs.where(model.score(F.col("text")) >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash or a five-word similarity of 0.8 links."""
    prepare(spark)
    return without_near_copies(keep_one_per_class(docs, words=3, radius=3), searched=docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    prepare(spark)
    return Benchmark(spark.read.parquet(f"{sf_dir}/benchmark.parquet")).without_leaks(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    prepare(spark)
    masked = docs.withColumn("text", mask_secrets(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``token_ids`` and ``n_tokens``."""
    codec = Codec.load(spark, tokenizer_file())
    prepare(spark)
    kept = docs.drop("token_ids", "n_tokens")
    return kept.withColumn("token_ids", codec.encode(F.col("text"))).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

# Compression, tokens and random walks are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
