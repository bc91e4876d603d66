"""The corpus pipeline: stages that each take the documents the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each result to the shared folder and reads it again as the next input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.decontamination import without_contaminated
from shelfcast.llm.mixing import apply_mix, mix_sources
from shelfcast.llm.ngram_join import near_duplicates
from shelfcast.llm.quality import fit_quality_model, keep_quality
from shelfcast.llm.queries import SHARDS, table
from shelfcast.llm.sharding import shard_records
from shelfcast.sizing import fits_broadcast
from shelfcast.workspace import scratch_path, scratch_scope, write_and_reopen


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of these documents."""
    return keep_quality(docs, fit_quality_model(docs, table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id; NULL is the largest.

    Documents without a word are in no group and stay. Of rows with equal id and text one stays. Ids that are NULL or
    stand for several texts are told apart by the text. An empty table stays empty; other columns pass.
    """
    ids = docs.select("doc_id", F.xxhash64("text").alias("_hash"))
    if ids.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").isEmpty():
        kept = near_duplicates(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("_kept_id"))
        kept = write_and_reopen(kept, scratch_path(spark, "pipeline-kept"))
        side = F.broadcast(kept) if fits_broadcast(kept) else kept
        return docs.join(side, F.col("doc_id") == F.col("_kept_id"), "left_semi")
    by_id = F.col("doc_id").asc_nulls_last()
    numbered = ids.distinct().repartitionByRange(by_id, F.col("_hash")).sortWithinPartitions(by_id, "_hash")
    numbered = numbered.select(  # numbers in the order of the ids, written so that they stay
        F.col("doc_id").alias("_id"), "_hash", F.monotonically_increasing_id().alias("_number")
    )
    numbered = write_and_reopen(numbered, scratch_path(spark, "pipeline-numbers"))
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
    single = docs.join(numbered, same).select(F.col("_number").alias("doc_id"), docs["text"]).dropDuplicates(["doc_id"])
    single = write_and_reopen(single, scratch_path(spark, "pipeline-texts"))
    kept = near_duplicates(single).filter("doc_id = component_id").select(F.col("doc_id").alias("_number"))
    kept = write_and_reopen(numbered.join(kept, "_number", "left_semi"), scratch_path(spark, "pipeline-kept"))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for."""
    return apply_mix(docs, mix_sources(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each row; copies of a document share it."""
    return shard_records(docs, [1.0] * SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: SQL can't express the trained classifier of the first stage; the tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_path(spark, f"pipeline-{i}")
        with scratch_scope(spark):  # what the stage wrote on its way is not needed once its result is there
            docs = write_and_reopen(stage(spark, docs, sf_dir), path)
    return STAGES[-1][1](spark, docs, sf_dir)
