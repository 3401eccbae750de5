"""Datasets of the processed and curated layers: texts, chunks, instructions, denormalised rows, their report and data card."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lavra.functions.scalars import instruction, nonblank

METADATA_TEXTS = ("title", "alternative_title", "abstract", "date", "document_type", "language", "institution", "repository", "access_rights", "source_url")
METADATA_LISTS = ("authors", "subjects")
UNKNOWN = "desconhecido"


def completed(records: DataFrame) -> DataFrame:
    return records.where("status = 'completed'")


def with_defaults(df: DataFrame, prefix: str = "") -> list:
    """Metadata columns with '' for null texts and an empty list for null lists."""
    texts = [F.coalesce(F.col(f"{prefix}{c}"), F.lit("")).alias(c) for c in METADATA_TEXTS]
    return texts + [F.coalesce(F.col(f"{prefix}{c}"), F.array().cast("array<string>")).alias(c) for c in METADATA_LISTS]


def denormalise(chunks: DataFrame, records: DataFrame, key: str = "bdtd_id") -> DataFrame:
    """Chunks of completed records, each with all metadata of its record.

    ``records`` has one row for each key: ``key, status, cluster_id`` and ``metadata``. A null cluster is the record itself. Chunks
    without a completed record are left out; null positions, pages and tokens become 0, 1 and 0. One join on the key.
    """
    kept = completed(records).select(F.col(key), F.coalesce("cluster_id", key).alias("cluster_id"), "metadata")
    own = chunks.select("chunk_id", key, "position", "section", "page", "tokens", "text")
    fixed = [F.coalesce("position", F.lit(0)).alias("position"), F.coalesce("section", F.lit("")).alias("section"), F.coalesce("page", F.lit(1)).alias("page"),
             F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("text", F.lit("")).alias("text")]
    return own.join(kept, key).select("chunk_id", key, "cluster_id", *fixed, *with_defaults(kept, "metadata."))


def without_chunks(records: DataFrame, chunks: DataFrame, key: str = "bdtd_id") -> DataFrame:
    """Keys of completed records that no chunk belongs to."""
    return completed(records).select(key).distinct().join(chunks.select(key).distinct(), key, "left_anti")


def text_dataset(records: DataFrame, texts: DataFrame, key: str = "bdtd_id") -> DataFrame:
    """``id, text, metadata``: one row for each completed record with a text."""
    summary = F.struct(*[F.coalesce(F.col(f"metadata.{c}"), F.array().cast("array<string>") if c in METADATA_LISTS else F.lit("")).alias(c) for c in ("title", "authors", "date", "subjects", "institution", "repository")])
    return completed(records).join(texts.select(key, "text"), key).select(F.col(key).alias("id"), "text", summary.alias("metadata"))


def chunk_dataset(chunks: DataFrame, key: str = "bdtd_id", most: int = 5000) -> DataFrame:
    """``id, part, title, chunks``: the ordered chunks of a document; a document of more than ``most`` chunks has several parts.

    Rows delivered twice are one. A part never holds more than ``most`` chunks, so a hot document is no unbounded group.
    """
    placed = chunks.select(key, "title", "chunk_id", "position", "section", "tokens", "text").distinct().withColumn("part", F.floor(F.coalesce("position", F.lit(0)) / most).cast("int"))
    nested = F.sort_array(F.collect_list(F.struct("position", "chunk_id", "section", "tokens", "text")))
    return placed.groupBy(F.col(key).alias("id"), "part").agg(F.min("title").alias("title"), nested.alias("chunks"))


def instruction_dataset(chunks: DataFrame) -> DataFrame:
    """``instruction, input, output``: one row for each chunk, the instruction by its section."""
    return chunks.select("chunk_id", instruction(F.col("title"), F.col("section")).alias("instruction"), F.coalesce("text", F.lit("")).alias("input"), F.lit("").alias("output"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """``value, rows``: frequencies, null and blank as ``desconhecido``; with ``top`` the most frequent ones, ties by value."""
    counted = df.groupBy(F.coalesce(nonblank(F.col(column)), F.lit(UNKNOWN)).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.orderBy(F.desc("rows"), "value").limit(top) if top else counted


def average_tokens(df: DataFrame) -> DataFrame:
    return df.agg(F.round(F.coalesce(F.avg(F.coalesce("tokens", F.lit(0))), F.lit(0.0)), 6).alias("avg_tokens"))


def curated_report(records: DataFrame, chunks: DataFrame, key: str = "bdtd_id") -> DataFrame:
    """One row: completed documents (with or without chunks), chunks, and completed documents without chunks."""
    counted = completed(records).agg(F.countDistinct(key).alias("document_count"))
    kept = chunks.join(completed(records).select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("chunk_count"))
    missing = without_chunks(records, chunks, key).agg(F.count(F.lit(1)).alias("missing_count"))
    return counted.join(F.broadcast(kept)).join(F.broadcast(missing))  # three tables of one row


def corpus_stats(chunks: DataFrame, key: str = "bdtd_id") -> DataFrame:
    """One row: rows, distinct chunk ids, ids that occur more than once, distinct documents, and those with an abstract."""
    per = chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"))
    ids = per.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("n") > 1).alias("repeated_ids"))
    documents = chunks.groupBy(key).agg(F.max((F.trim(F.coalesce("abstract", F.lit(""))) != "").cast("int")).alias("has")).agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("has"), F.lit(0)).alias("abstracts")
    )
    return ids.join(F.broadcast(documents))


def check_corpus(chunks: DataFrame) -> DataFrame:
    """``code, chunk_id``: what forbids an index: a blank chunk id, key or text, and repeated chunk ids; no rows if all is well."""
    blank = [chunks.where(nonblank(F.col(c)).isNull()).select(F.lit(f"blank_{c}").alias("code"), "chunk_id") for c in ("chunk_id", "bdtd_id", "text")]
    repeated = chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("repeated_chunk_id").alias("code"), "chunk_id")
    return blank[0].unionAll(blank[1]).unionAll(blank[2]).unionAll(repeated)


def first_abstracts(chunks: DataFrame, key: str = "bdtd_id") -> DataFrame:
    """The row of each document that has its first abstract that is not blank, in the order of position and chunk id."""
    order = F.struct(F.coalesce("position", F.lit(0)), "chunk_id")
    return chunks.where(nonblank(F.col("abstract")).isNotNull()).groupBy(key).agg(F.min_by(F.struct("abstract", "title", "source_url"), order).alias("f"))


def data_card(records: DataFrame, chunks: DataFrame, config: dict[str, object] | None = None, name: str = "corpus") -> str:
    """Markdown card of a corpus; only small aggregates reach the driver."""
    status = {r["status"]: r["n"] for r in records.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    report = curated_report(records, chunks).first()
    tokens = average_tokens(chunks).first()[0]
    rows = [f"# Data card: {name}", "", "## Composition", "", f"- Documents: {report['document_count']}", f"- Chunks: {report['chunk_count']}",
            f"- Documents without chunks: {report['missing_count']}", f"- Tokens a chunk: {tokens:.1f}", ""]
    rows += ["## Status", "", *[f"- `{s}`: {status.get(s, 0)}" for s in ("completed", "no_text", "filtered", "duplicate", "skipped")], ""]
    for heading, column, top in (("Languages", "language", 1000), ("Institutions", "institution", 10)):
        rows += [f"## {heading}", "", *[f"- {r['value']}: {r['rows']}" for r in value_counts(chunks, column, top).collect()], ""]
    rows += ["## Parameters", "", *[f"- {k}: {v}" for k, v in sorted((config or {}).items())], "", "## Columns", "", *[f"- `{n}`: {t}" for n, t in chunks.dtypes], ""]
    return "\n".join(rows)


def latest_by(df: DataFrame, key: str, *order) -> DataFrame:
    """The last row of each key in the given order. Keys are reduced by a partial aggregate, so a hot key is no hot group."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != key]), F.struct(*order)).alias("r")).select(key, "r.*")


def first_by_window(df: DataFrame, key: str, *order) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
