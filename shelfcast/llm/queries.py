"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.decontamination import contaminated_passages
from shelfcast.llm.divergence import source_divergence
from shelfcast.llm.holdout import held_out
from shelfcast.llm.language_id import fit_language_model, predict_languages
from shelfcast.llm.ngram_join import near_duplicates
from shelfcast.llm.line_dedup import keep_bitmaps, kept_text
from shelfcast.llm.mixing import mix_sources
from shelfcast.llm.packing import pack_documents
from shelfcast.llm.quality import THRESHOLD, fit_quality_model, score_quality
from shelfcast.llm.secrets_scan import listed, scan_secrets
from shelfcast.llm.topk_search import build_index, search
from shelfcast.llm.token_counts import token_counts
from shelfcast.llm.sharding import number_slots, rendezvous_shard, record_key
from shelfcast.llm.whitening import fit_whitening, whiten
from shelfcast.workspace import scratch_path, write_and_reopen

#: Shards of the sharding query.
SHARDS = 24
#: Tokens beyond which a document is too long for the context.
TOKEN_LIMIT = 512
#: Tokens of a packed sequence.
SEQUENCE_TOKENS = 2048
#: Documents of a language that must hold a term for the audit of sources, and terms listed for a source.
AUDIT_DOCUMENTS, AUDIT_TERMS = 3, 200
#: Whole numbers per unit of an embedding's entry, and directions of the whitening.
WHITENING_SCALE, WHITENING_COMPONENTS = 256, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of benchmark items that documents hold."""
    return contaminated_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 20, its whole text being the query."""
    docs = table(spark, sf_dir, "documents")
    index = write_and_reopen(build_index(docs), scratch_path(spark, "search-index"))
    return search(index, docs.filter("doc_id % 20 = 0")).select("query_id", "rank", "doc_id", "score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that recur in three or more documents go from all but the last of them."""
    docs = table(spark, sf_dir, "documents")
    bitmaps = write_and_reopen(keep_bitmaps(docs), scratch_path(spark, "line-keep"))
    hashed = kept_text(docs.withColumn("content", F.xxhash64("text")), bitmaps).select(
        "doc_id", "content", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )
    return (
        hashed.alias("t")
        .join(bitmaps.distinct().alias("b"), F.expr("t.doc_id <=> b.doc_id AND t.content = b.content"))
        .select("t.doc_id", "n_lines", "n_dropped", "kept_sha256")
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of 5-word shingles, and the component of links at a similarity of 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document so that the sources meet their weights in words."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
        "rate",
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated probability of quality 1 for every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op7_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, and its shard if there were one more."""
    docs = table(spark, sf_dir, "documents")
    key = record_key(F.col("doc_id"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(key, [1.0] * SHARDS).alias("shard"),
        rendezvous_shard(key, [1.0] * (SHARDS + 1)).alias("grown_shard"),
    )
    return number_slots(placed, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of known formats, and strings that the randomness tests report."""
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("known", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed("known").cast("binary"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    predicted = predict_languages(docs, fit_language_model(docs))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Bytes and tokens of every document by the byte-level BPE of 50,257 entries."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts(table(spark, sf_dir, "documents"), str(path))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Sequence and place of every piece of every document, packed by best fit into sequences of 2,048 tokens."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(table(spark, sf_dir, "documents"), str(path), SEQUENCE_TOKENS)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding in the first whitened directions."""
    rows = table(spark, sf_dir, "embeddings")
    return whiten(rows, fit_whitening(rows, WHITENING_SCALE, WHITENING_COMPONENTS))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the terms that set it apart."""
    return source_divergence(table(spark, sf_dir, "documents"), AUDIT_DOCUMENTS, AUDIT_TERMS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_topk_search": op2_topk_search,
    "op3_line_dedup": op3_line_dedup,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_source_mixing": op5_source_mixing,
    "op6_quality_classifier": op6_quality_classifier,
    "op8_secret_scan": op8_secret_scan,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_source_divergence": op13_source_divergence,
    "op7_rendezvous_sharding": op7_rendezvous_sharding,
}
