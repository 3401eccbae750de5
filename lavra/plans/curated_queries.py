"""Queries over the curated layer: datasets, reports, retrieval and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators import datasets, evaluation, retrieval, staging, validation
from lavra.plans import sql as Q
from lavra.session import table


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "curated_chunks")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed records with the metadata of the record collected last."""
    newest = table(spark, sf_dir, "raw_records").groupBy("bdtd_id").agg(F.max_by("metadata", "checked_at").alias("metadata"))
    return table(spark, sf_dir, "processed_records").join(newest, "bdtd_id", "left")


_META = "(SELECT bdtd_id, arg_max(metadata, checked_at) AS m FROM raw_records GROUP BY bdtd_id)"


def denormalised_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = datasets.denormalise(_chunks(spark, sf_dir), _records(spark, sf_dir)).distinct()
    return found.withColumns({c: F.array_join(c, "|") for c in datasets.METADATA_LISTS})


_DENORMALISED = f"""
    SELECT DISTINCT chunk_id, c.bdtd_id, coalesce(p.cluster_id, p.bdtd_id) AS cluster_id, coalesce(c.position, 0) AS position, coalesce(section, '') AS section, coalesce(page, 1) AS page,
           coalesce(tokens, 0) AS tokens, coalesce(text, '') AS text, {", ".join(f"coalesce(m.{x}, '') AS {x}" for x in datasets.METADATA_TEXTS)},
           {", ".join(f"coalesce(array_to_string(list_filter(m.{x}, lambda v: v IS NOT NULL), '|'), '') AS {x}" for x in datasets.METADATA_LISTS)}
    FROM curated_chunks c JOIN processed_records p ON p.bdtd_id = c.bdtd_id AND p.status = 'completed' LEFT JOIN {_META} r ON r.bdtd_id = p.bdtd_id"""


def missing_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.without_chunks(table(spark, sf_dir, "processed_records"), _chunks(spark, sf_dir))


def curated_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.curated_report(table(spark, sf_dir, "processed_records"), _chunks(spark, sf_dir))


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.corpus_stats(_chunks(spark, sf_dir))


def corpus_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.check_corpus(_chunks(spark, sf_dir))


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.instruction_dataset(_chunks(spark, sf_dir)).distinct()


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").where("text is not null")
    found = datasets.text_dataset(_records(spark, sf_dir), texts)
    return found.select("id", F.sha2("text", 256).alias("digest"), F.col("metadata.title").alias("title"), F.size("metadata.authors").alias("authors"), "metadata.date", "metadata.institution")


def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered chunks of each document, shown as the digest of their ids."""
    found = datasets.chunk_dataset(_chunks(spark, sf_dir))
    return found.select("id", "part", "title", F.size("chunks").alias("n"), F.sha2(F.array_join("chunks.chunk_id", " "), 256).alias("digest"))


def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.value_counts(_chunks(spark, sf_dir), "language")


def institution_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.value_counts(_chunks(spark, sf_dir), "institution", 10)


def average_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.average_tokens(_chunks(spark, sf_dir))


def first_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.first_abstracts(_chunks(spark, sf_dir)).select("bdtd_id", F.col("f.abstract").alias("abstract"))


def index_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.index_entries(_chunks(spark, sf_dir)).select("chunk_id", "bdtd_id", "kind", "section", F.sha2("search_text", 256).alias("digest"))


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The titles of every document whose id is divisible by 50."""
    return table(spark, sf_dir, "documents").where("doc_id % 50 = 0 and title is not null").select("doc_id", "title")


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = retrieval.bm25(table(spark, sf_dir, "documents"), "doc_id", "text", _queries(spark, sf_dir), "doc_id", "title", top=retrieval.DEPTH)
    return found.select("query", "key", "score", "rank")


_BM25 = f"""
    WITH d AS (SELECT doc_id, {Q.terms("coalesce(text, '')")} AS t FROM documents), l AS (SELECT doc_id, len(t) AS dl FROM d WHERE len(t) > 0),
         q AS (SELECT DISTINCT doc_id AS query, unnest({Q.terms('title')}) AS term FROM documents WHERE doc_id % 50 = 0 AND title IS NOT NULL),
         p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
         f AS (SELECT term, count(*) AS df FROM p GROUP BY term), s AS (SELECT count(*) AS docs, avg(dl) AS avg_dl FROM l),
         w AS (SELECT query, doc_id AS key, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg_dl))), 6) AS score
               FROM p JOIN f USING (term) JOIN l USING (doc_id) JOIN q USING (term), s GROUP BY ALL)
    SELECT query, key, score, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS INTEGER) AS rank FROM w QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, key) <= 20"""


def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return retrieval.cosine_top(vectors, "vec_id", "embedding", vectors.where("vec_id % 50 = 0"), "vec_id", "embedding")


_norm = lambda v: f"sqrt(list_sum(list_transform({v}, lambda x: x::DOUBLE * x::DOUBLE)))"
_COSINE = f"""
    WITH w AS (SELECT a.vec_id AS query, b.vec_id AS key, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / ({_norm('a.embedding')} * {_norm('b.embedding')}), 6) AS score
               FROM embeddings a JOIN embeddings b ON a.vec_id % 50 = 0)
    SELECT query, key, score, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS INTEGER) AS rank FROM w QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, key) <= 20"""


def rrf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fusion of the words' and the vectors' ranks; documents and vectors share their ids here."""
    return retrieval.fuse(bm25_topk(spark, sf_dir), cosine_topk(spark, sf_dir))


_RRF = f"""WITH w AS (SELECT query, key, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (SELECT query, key, rank FROM ({_BM25}) UNION ALL SELECT query, key, rank FROM ({_COSINE})) GROUP BY ALL)
    SELECT query, key, score, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS INTEGER) AS rank FROM w QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, key) <= 5"""


def context_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The context of 18,000 characters of each query from its best texts by words."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "title", "text")
    return retrieval.pack_context(bm25_topk(spark, sf_dir).join(documents, "key")).select("query", "rank", F.length("snippet").alias("chars"), F.sha2("snippet", 256).alias("digest"))


_PACK = f"""
    SELECT query, rank, length(h || left(t, n)) AS chars, sha256(h || left(t, n)) AS digest FROM (
        SELECT query, rank, h, t, CAST(18000 - coalesce(sum(length(h) + length(t) + 1) OVER (PARTITION BY query ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - length(h) - 1 AS INTEGER) AS n
        FROM (SELECT query, rank, '[' || key || '] ' || coalesce(title, '') || chr(10) AS h, coalesce(text, '') AS t FROM ({_BM25}) JOIN documents ON doc_id = key)) WHERE n > 0"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events read as runs of an evaluation: a type is a mode, errors failed, and values are seconds."""
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("mode"), F.when(~failed, F.col("props")).alias("answer"), F.when(failed, "error").alias("error"),
        F.when(F.col("user_id") % 7 == 0, "length").alias("done_reason"), (F.col("value") / 10).alias("retrieval_seconds"), F.col("value").alias("seconds"),
    )


def mode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.mode_summary(_runs(spark, sf_dir)).drop("quality_score")


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A case for each document and section: one group of evidence for each section, met by any of its chunks."""
    groups = _chunks(spark, sf_dir).where("section is not null").groupBy("bdtd_id", "section").agg(F.sort_array(F.collect_set("chunk_id")).alias("g"))
    return groups.groupBy(F.col("bdtd_id").alias("id")).agg(F.collect_list("g").alias("evidence_groups"))


def evidence_met(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _chunks(spark, sf_dir).where("position % 3 <> 0").select(F.col("bdtd_id").alias("id"), F.col("chunk_id").alias("ref")).distinct()
    return evaluation.evidence_met(_cases(spark, sf_dir), hits)


def unresolved_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to chunks of documents that are not completed."""
    done = table(spark, sf_dir, "processed_records").where("status = 'completed'").select("bdtd_id")
    known = _chunks(spark, sf_dir).join(done, "bdtd_id", "left_semi").where("position % 5 <> 0").select(F.col("chunk_id").alias("ref"))
    return validation.unresolved_evidence(_cases(spark, sf_dir), known)


def case_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.case_runs(_queries(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("title").alias("question")))


def chunk_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks by id with rows delivered twice replaced by the one of the greatest token count."""
    rows = _chunks(spark, sf_dir).select("chunk_id", "bdtd_id", F.coalesce("tokens", F.lit(0)).alias("tokens"))
    return staging.upsert(rows.limit(0), rows, "chunk_id", "tokens")


QUERIES = {
    f.__name__: f
    for f in (
        denormalised_chunks, missing_chunks, curated_report, corpus_stats, corpus_issues, instruction_rows, text_rows, chunk_rows, language_counts, institution_top10, average_tokens,
        first_abstracts, index_entries, bm25_topk, cosine_topk, rrf_topk, context_pack, mode_summary, evidence_met, unresolved_evidence, case_runs, chunk_upsert,
    )
}
_blank = lambda c: f"SELECT 'blank_{c}' AS code, chunk_id FROM curated_chunks WHERE {Q.nonblank(c)} IS NULL"
_value = lambda c: f"coalesce({Q.nonblank(c)}, '{datasets.UNKNOWN}')"
_GROUPS = "SELECT bdtd_id AS id, list(g) AS groups FROM (SELECT bdtd_id, section, list(DISTINCT chunk_id) AS g FROM curated_chunks WHERE section IS NOT NULL GROUP BY ALL) GROUP BY bdtd_id"
ORACLES = {
    "denormalised_chunks": _DENORMALISED,
    "missing_chunks": "SELECT bdtd_id FROM processed_records WHERE status = 'completed' EXCEPT SELECT bdtd_id FROM curated_chunks",
    "curated_report": """SELECT (SELECT count(DISTINCT bdtd_id) FROM processed_records WHERE status = 'completed') AS document_count,
        (SELECT count(*) FROM curated_chunks WHERE bdtd_id IN (SELECT bdtd_id FROM processed_records WHERE status = 'completed')) AS chunk_count,
        (SELECT count(*) FROM (SELECT bdtd_id FROM processed_records WHERE status = 'completed' EXCEPT SELECT bdtd_id FROM curated_chunks)) AS missing_count""",
    "corpus_stats": f"""SELECT count(*) AS rows, count(DISTINCT chunk_id) AS chunks, (SELECT count(*) FROM (SELECT chunk_id FROM curated_chunks GROUP BY chunk_id HAVING count(*) > 1)) AS repeated_ids,
        count(DISTINCT bdtd_id) AS documents, count(DISTINCT CASE WHEN trim(coalesce(abstract, '')) <> '' THEN bdtd_id END) AS abstracts FROM curated_chunks""",
    "corpus_issues": f"{_blank('chunk_id')} UNION ALL {_blank('bdtd_id')} UNION ALL {_blank('text')} UNION ALL SELECT 'repeated_chunk_id', chunk_id FROM curated_chunks GROUP BY chunk_id HAVING count(*) > 1",
    "instruction_rows": f"SELECT DISTINCT chunk_id, {Q.instruction('title', 'section')} AS instruction, coalesce(text, '') AS input, '' AS output FROM curated_chunks",
    "text_rows": f"""SELECT p.bdtd_id AS id, sha256(d.text) AS digest, coalesce(m.title, '') AS title, coalesce(len(m.authors), 0) AS authors, coalesce(m.date, '') AS date, coalesce(m.institution, '') AS institution
        FROM processed_records p JOIN documents d ON d.bdtd_id = p.bdtd_id AND d.text IS NOT NULL LEFT JOIN {_META} r ON r.bdtd_id = p.bdtd_id WHERE p.status = 'completed'""",
    "chunk_rows": """SELECT id, part, min(title) AS title, count(*) AS n, sha256(string_agg(chunk_id, ' ' ORDER BY position NULLS FIRST, chunk_id, section NULLS FIRST, tokens NULLS FIRST, text)) AS digest FROM (
        SELECT DISTINCT bdtd_id AS id, CAST(floor(coalesce(position, 0) / 5000) AS INTEGER) AS part, title, chunk_id, position, section, tokens, text FROM curated_chunks) GROUP BY id, part""",
    "language_counts": f"SELECT {_value('language')} AS value, count(*) AS rows FROM curated_chunks GROUP BY 1",
    "institution_top10": f"SELECT {_value('institution')} AS value, count(*) AS rows FROM curated_chunks GROUP BY 1 ORDER BY rows DESC, value LIMIT 10",
    "average_tokens": "SELECT round(coalesce(avg(coalesce(tokens, 0)), 0), 6) AS avg_tokens FROM curated_chunks",
    "first_abstracts": f"SELECT bdtd_id, arg_min(abstract, {{'p': coalesce(position, 0), 'c': chunk_id}}) AS abstract FROM curated_chunks WHERE {Q.nonblank('abstract')} IS NOT NULL GROUP BY bdtd_id",
    "index_entries": f"""SELECT chunk_id, bdtd_id, kind, section, sha256(coalesce(title, '') || chr(10) || text) AS digest FROM (
        SELECT DISTINCT chunk_id, bdtd_id, title, source_url, section, 'chunk' AS kind, text FROM curated_chunks UNION ALL
        SELECT bdtd_id || '::abstract', bdtd_id, f.title, f.source_url, 'metadata.abstract', 'abstract', f.abstract FROM (
            SELECT bdtd_id, arg_min({{'abstract': abstract, 'title': title, 'source_url': source_url}}, {{'p': coalesce(position, 0), 'c': chunk_id}}) AS f FROM curated_chunks WHERE {Q.nonblank('abstract')} IS NOT NULL GROUP BY bdtd_id))""",
    "bm25_topk": _BM25,
    "cosine_topk": _COSINE,
    "rrf_topk": _RRF,
    "context_pack": _PACK,
    "mode_summary": """SELECT event_type AS mode, count(*) AS attempted, count(*) FILTER (event_type <> 'error' AND props IS NOT NULL) AS answered, count(*) FILTER (event_type = 'error') AS failed,
        count(*) FILTER (event_type <> 'error' AND props IS NOT NULL AND user_id % 7 = 0) AS truncated, round(median(value / 10), 6) AS median_retrieval_seconds,
        round(median(value) FILTER (event_type <> 'error' AND props IS NOT NULL), 6) AS median_generation_seconds FROM events GROUP BY event_type""",
    "evidence_met": f"""WITH h AS (SELECT bdtd_id AS id, list(DISTINCT chunk_id) AS refs FROM curated_chunks WHERE position % 3 <> 0 GROUP BY bdtd_id)
        SELECT c.id, len(list_filter(groups, lambda g: NOT list_has_any(g, coalesce(refs, [])))) = 0 AS met FROM ({_GROUPS}) c LEFT JOIN h ON h.id = c.id""",
    "unresolved_evidence": """SELECT DISTINCT bdtd_id AS id, chunk_id AS ref FROM curated_chunks WHERE section IS NOT NULL AND chunk_id NOT IN (
        SELECT chunk_id FROM curated_chunks WHERE position % 5 <> 0 AND bdtd_id IN (SELECT bdtd_id FROM processed_records WHERE status = 'completed'))""",
    "case_runs": "SELECT doc_id AS id, title AS question, unnest(['raw_baseline', 'words', 'dense', 'hybrid']) AS mode FROM documents WHERE doc_id % 50 = 0 AND title IS NOT NULL",
    "chunk_upsert": "SELECT chunk_id, unnest(r) FROM (SELECT chunk_id, arg_max({'bdtd_id': bdtd_id, 'tokens': coalesce(tokens, 0)}, coalesce(tokens, 0)) AS r FROM curated_chunks GROUP BY chunk_id)",
}
