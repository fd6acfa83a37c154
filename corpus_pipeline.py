"""From raw documents to token shards, stage by stage.

Every stage reads all that its predecessor kept, written as Parquet and read
again. The first three drop documents, the fourth orders them, and the last
writes token ids in that order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import decontaminate, mixing, quality_cnn, simhash, token_planes
from marquee.llm.common import free_name, small_batches, table
from marquee.llm.queries import tokenizer_path
from marquee.session import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    small_batches(spark)
    model = quality_cnn.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_quality")
    scored = quality_cnn.add_score(docs, model, score=score)
    return scored.where(F.col(score) >= quality_cnn.KEEP_FROM).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link (four-word shingles, four bits), the one with the smallest id."""
    small_batches(spark)
    return simhash.drop_near_duplicates(docs, most_bits=simhash.MOST_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files and rows in the order of the mixing schedule."""
    return mixing.in_order(docs, mixing.tempered_weights(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in the order of the files read, and what they hold per document."""
    small_batches(spark)
    part, file, row = (free_name(docs, n) for n in ("_part", "_file", "_at"))
    path = F.col("_metadata.file_path")
    placed = docs.select("*", F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).try_cast("long").alias(part),
                         path.alias(file), F.col("_metadata.row_index").alias(row))
    return token_planes.read_tokens(token_planes.write_tokens(
        placed, token_planes.shard_folder(spark), tokenizer_path(), order=[part, file, row]))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("mixing_to_weights", mix),
    ("token_planes", tokens),
]

# The classifier has no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows: ``doc_id, start, n_tokens, ids_crc32``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
