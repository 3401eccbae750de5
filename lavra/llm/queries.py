"""The queries of this subpackage's operators, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm.bpe import encode_corpus
from lavra.llm.entities import link_names, spelling_pairs
from lavra.llm.language import detect_languages, fit_filters
from lavra.llm.packing import pack_texts
from lavra.llm.pii import find_personal_data, redact_personal_data
from lavra.llm.scans import repair_scans, scan_noise
from lavra.llm.similarity import all_pairs, duplicate_classes, near_duplicates
from lavra.llm.splitting import split_oversized
from lavra.llm.truncation import assess_endings, truncation_by_source
from lavra.session import durable, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, members = near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return all_pairs(links, members).select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p1_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, members = near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return duplicate_classes(durable(links), members).withColumnRenamed("key", "doc_id")


def p2_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every document (segment 0) and of every paragraph long enough."""
    documents = table(spark, sf_dir, "documents")
    return detect_languages(documents, "doc_id", "text", fit_filters(documents, "doc_id", "lang", "text"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = detect_languages(documents.withColumn("keyed", F.struct("doc_id", "lang")), "keyed", "text", fit_filters(documents, "doc_id", "lang", "text"))
    wrong_label = (F.col("segment_no") == 0) & ~F.col("keyed.lang").eqNullSafe(F.col("lang_code"))
    foreign = (F.col("segment_no") > 0) & (F.col("lang_code") != F.col("main_lang"))
    return found.where(wrong_label | foreign).select("keyed.doc_id", "segment_no", "lang_code")


def p4_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of an author or institution with its entity."""
    records = table(spark, sf_dir, "raw_records").select("metadata.authors", "metadata.institution")
    authors = records.select(F.lit("author").alias("kind"), F.explode("authors").alias("name"))
    return link_names(authors.unionAll(records.select(F.lit("institution"), "institution")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spelling_pairs(p4_entities(spark, sf_dir))
    return pairs.select(F.col("kind").alias("name_kind"), F.col("a").alias("name_a"), F.col("b").alias("name_b"))


def p5_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of personal data in the documents and abstracts, with its end."""
    found = find_personal_data(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("rec_key"), "text"), "rec_key", "text")
    records = table(spark, sf_dir, "raw_records").select(F.col("bdtd_id").alias("rec_key"), F.col("metadata.abstract").alias("text"))
    again = find_personal_data(records, "rec_key", "text").distinct()  # records collected again
    return found.select(F.lit("documents").alias("place"), "*").unionAll(again.select(F.lit("raw_records"), "*"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_items(spark, sf_dir).select("place", "rec_key", "pii_kind", "start_pos")


def p5_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with typed placeholders."""
    return redact_personal_data(table(spark, sf_dir, "documents"), "doc_id", "text")


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered pieces of every chunk and document above the limit; rows delivered twice are cut once."""
    chunks = table(spark, sf_dir, "curated_chunks").select("chunk_id", "text").where("length(text) > 4000").distinct()
    return split_oversized(chunks, "chunk_id", "text", "chunk").unionByName(
        split_oversized(table(spark, sf_dir, "documents"), "doc_id", "text", "document")
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_pieces(spark, sf_dir).select("item_kind", "item_key").distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise(table(spark, sf_dir, "documents"), "doc_id", "text")[0]


def p7_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as continuous paragraphs."""
    return repair_scans(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(table(spark, sf_dir, "documents"), "doc_id", "text", 2048)


def p10_endings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess_endings(table(spark, sf_dir, "documents"), "doc_id", "text", "source", "title")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_endings(spark, sf_dir).where("cut").select("doc_id")


def p10_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation_by_source(p10_endings(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_clusters": p1_clusters,
        "p2_found": p2_found,
        "p2_languages": p2_languages,
        "p4_found": p4_found,
        "p4_entities": p4_entities,
        "p5_found": p5_found,
        "p5_items": p5_items,
        "p5_texts": p5_texts,
        "p6_found": p6_found,
        "p6_pieces": p6_pieces,
        "p7_found": p7_found,
        "p7_texts": p7_texts,
        "p8_ids": p8_ids,
        "p9_containers": p9_containers,
        "p10_found": p10_found,
        "p10_by_source": p10_by_source,
    }


def oracle_sql() -> dict[str, str]:
    return {
        # all runs of five words of all texts meet: exact, and feasible where few texts share a run
        "p1_found": r"""
            WITH w AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
                 s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS run FROM w WHERE len(w) >= 40),
                 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
                 c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met FROM s a JOIN s b ON a.run = b.run AND a.doc_id < b.doc_id GROUP BY ALL)
            SELECT x AS doc_id_a, y AS doc_id_b FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE met / (p.n + q.n - met) >= 0.6""",
        "p6_found": """
            SELECT 'chunk' AS item_kind, chunk_id AS item_key FROM curated_chunks WHERE length(text) > 4000 GROUP BY chunk_id
            UNION ALL
            SELECT 'document', CAST(doc_id AS VARCHAR) FROM documents WHERE length(text) > 4000 GROUP BY doc_id""",
    }
