"""From collected records and their texts to processed records, chunks and datasets, in the order of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.scalars import first_of, metadata_key, nonblank
from lavra.functions.text import clean_text
from lavra.operators import chunking, redaction
from lavra.operators.dedup import leader_clusters
from lavra.operators.quality import quality_verdicts
from lavra.session import durable

MIN_TEXT = 50


def process(records: DataFrame, texts: DataFrame, key: str = "bdtd_id", *, target_language: str = "pt") -> tuple[DataFrame, DataFrame]:
    """(processed records, chunks).

    ``records``: ``key, status, metadata, raw_record``, one row for each key; ``texts``: ``key, text``, at most one for each.
    Records that were not downloaded are ``skipped``; without a text, or with fewer than 50 characters of it, they are ``no_text``; then come
    ``filtered`` (with the verdict), ``duplicate`` (with the cluster) and ``completed``. Clusters are formed in the order of the keys among the texts that pass the filter.
    The processed rows are ``key, status, reason_code, cluster_id, chunk_count, char_count, sha256_text, redaction``.
    """
    downloaded = F.col("status") == "downloaded"
    skipped = records.where(~downloaded | F.col("status").isNull()).select(key, F.lit("skipped").alias("status"), F.concat(F.lit("raw_"), F.coalesce("status", F.lit("unknown"))).alias("reason_code"))
    joined = records.where(downloaded).join(texts.select(key, "text"), key, "left")
    readable = F.length(F.trim(F.coalesce("text", F.lit("")))) >= MIN_TEXT
    no_text = joined.where(~readable).select(key, F.lit("no_text").alias("status"), F.when(F.col("text").isNull(), "extraction_failed").otherwise("empty_text").alias("reason_code"))
    cleaned = durable(joined.where(readable).withColumn("text", clean_text(F.col("text"))))
    judged = durable(quality_verdicts(cleaned, key, "text", target_language).select(key, "reason"))  # a filter on the reason would work the measures out again and again
    filtered = judged.where("reason is not null").select(key, F.lit("filtered").alias("status"), F.col("reason").alias("reason_code"))
    kept = durable(cleaned.join(judged.where("reason is null").select(key), key, "left_semi"))
    keyed = kept.withColumn("_mkey", metadata_key(F.col("metadata.title"), first_of(F.col("metadata.authors")), F.col("metadata.date")))
    clusters = durable(leader_clusters(keyed, key, "text", "_mkey", key).select(key, "cluster_id"))
    duplicates = clusters.where(F.col("cluster_id") != F.col(key)).select(key, F.lit("duplicate").alias("status"), F.lit(None).cast("string").alias("reason_code"), "cluster_id")
    leaders = kept.join(clusters.where(F.col("cluster_id") == F.col(key)), key)
    names = F.array_distinct(F.filter(F.concat(F.coalesce("metadata.authors", F.array().cast("array<string>")), redaction.role_names(F.to_json("raw_record"))), lambda n: nonblank(n).isNotNull()))
    masked = durable(redaction.anonymize(leaders.withColumn("_names", names), "text", "_names").select(key, "cluster_id", F.col("metadata.title").alias("title"), "text", "redactions"))
    chunks = chunking.chunk_documents(masked, key, "text", "title")
    counted = chunks.groupBy(key).agg(F.count(F.lit(1)).alias("chunk_count"))
    completed = masked.join(counted, key, "left").select(
        key, F.lit("completed").alias("status"), F.lit(None).cast("string").alias("reason_code"), "cluster_id", F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"),
        F.length("text").alias("char_count"), F.sha2("text", 256).alias("sha256_text"), F.col("redactions").alias("redaction"),
    )
    processed = completed
    for part in (duplicates, filtered, no_text, skipped):
        processed = processed.unionByName(part, allowMissingColumns=True)
    return processed, chunks
