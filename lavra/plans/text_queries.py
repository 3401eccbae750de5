"""Queries over ``documents``: cleaning, quality, redaction, deduplication, sections and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions import text as T
from lavra.functions.scalars import metadata_key, nonblank, plain
from lavra.operators import chunking, dedup, quality, redaction
from lavra.plans import sql as Q
from lavra.plans.pipeline import process
from lavra.session import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _text() -> object:
    return F.coalesce("text", F.lit(""))


def _stepped(step):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _documents(spark, sf_dir).select("doc_id", step(_text()).alias("t")).select("doc_id", F.sha2("t", 256).alias("digest"), F.length("t").alias("chars"))

    return run


def _stepped_sql(expression: str) -> str:
    return f"SELECT doc_id, sha256(t) AS digest, length(t) AS chars FROM (SELECT doc_id, {expression} AS t FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents))"


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaning steps over every document (Unicode repair and hyphens in Python, the rest native)."""
    return _stepped(T.clean_text)(spark, sf_dir)


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_verdicts(_documents(spark, sf_dir), "doc_id", "text")
    return found.select("doc_id", "lang", *[F.round(c, 6).alias(c) for c in ("confidence", "repetition_ratio", "junk_ratio")], "char_count", "reason")


def quality_verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(_documents(spark, sf_dir), "doc_id", "text").groupBy("lang", "reason").agg(F.count(F.lit(1)).alias("texts"))


_METRICS = f"""
    SELECT doc_id, CASE WHEN total = 0 THEN NULL WHEN own / total >= 0.1 THEN 'pt' ELSE best.code END AS lang,
           CASE WHEN total = 0 THEN NULL WHEN own / total >= 0.1 THEN own / total ELSE best.hits / total END AS confidence,
           length(x) AS char_count, {Q.repetition('w')} AS repetition_ratio, {Q.junk('x')} AS junk_ratio
    FROM (SELECT *, list_reverse_sort(s)[1] AS best, list_filter(s, lambda z: z.code = 'pt')[1].hits AS own, list_sum(list_transform(s, lambda z: z.hits)) AS total
          FROM (SELECT *, {Q.language('w')} AS s FROM (SELECT *, {Q.words('x')} AS w FROM (SELECT doc_id, {Q.clean_whitespace("coalesce(text, '')")} AS x FROM documents))))"""
_VERDICT = """CASE WHEN char_count < 500 THEN 'too_short' WHEN lang IS DISTINCT FROM 'pt' OR coalesce(confidence, 0) < 0.5 THEN 'not_portuguese'
              WHEN repetition_ratio > 0.7 THEN 'too_repetitive' WHEN junk_ratio > 0.15 THEN 'too_junky' END"""


def char_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.length_histogram(_documents(spark, sf_dir), "n_chars")


def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacements by document and kind."""
    return _documents(spark, sf_dir).where("text is not null").select("doc_id", F.explode(redaction.redaction_counts(F.col("text"))).alias("kind", "n"))


def pii_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _documents(spark, sf_dir).where("text is not null").select(redaction.redaction_counts(F.col("text")).alias("m"))
    return redaction.map_totals(counted, "m")


def pii_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that the redacted texts still have, by kind, zeros included."""
    rest = _documents(spark, sf_dir).where("text is not null").select(redaction.residual_counts(redaction.redact_patterns(F.col("text"))).alias("m"))
    return redaction.map_totals(rest, "m")


def known_name_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with patterns, the names of their own record and role sequences redacted."""
    records = table(spark, sf_dir, "raw_records")
    per = F.concat(F.coalesce("metadata.authors", F.array().cast("array<string>")), redaction.role_names(F.to_json("raw_record")))
    names = records.select("bdtd_id", F.array_distinct(F.filter(per, lambda n: nonblank(n).isNotNull())).alias("names"), "checked_at")
    names = names.groupBy("bdtd_id").agg(F.max_by("names", "checked_at").alias("names"))
    joined = _documents(spark, sf_dir).select("doc_id", "bdtd_id", "text").join(names, "bdtd_id", "left")
    done = redaction.anonymize(joined, "text", "names")
    return done.select("doc_id", F.sha2("text", 256).alias("digest"), F.coalesce(F.col("redactions")["PERSON"], F.lit(0)).alias("persons"))


def exact_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    digested = _documents(spark, sf_dir).select("doc_id", F.sha2(plain(F.col("text")), 256).alias("digest"))
    return dedup.keep_first(digested, "digest", "doc_id").select("doc_id", "cluster_id")


def dedup_cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cluster_stats(exact_dedup_keep_first(spark, sf_dir), "doc_id")


_KEEP_FIRST = f"""SELECT doc_id, CASE WHEN d IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY d) END AS cluster_id
                  FROM (SELECT doc_id, sha256({Q.plain('text')}) AS d FROM documents)"""


def leader_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three levels over all documents; the key is that of the title, the repository and the year of retrieval."""
    keyed = _documents(spark, sf_dir).select("doc_id", "text", metadata_key(F.col("title"), F.col("source"), F.date_format("retrieved_at", "yyyy")).alias("mkey"))
    return dedup.leader_clusters(keyed, "doc_id", "text", "mkey", "doc_id")


def minhash_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that share a band with another text, by band."""
    bands = dedup.minhash(_documents(spark, sf_dir), "doc_id", "text").select(F.posexplode("bands").alias("band", "hash"))
    return bands.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy("band").agg(F.count(F.lit(1)).alias("buckets"), F.sum("n").alias("texts"))


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.sections(_documents(spark, sf_dir), "doc_id", "text")


_SECTIONS = f"""
    WITH h AS (SELECT doc_id, l, list_filter(list_transform(l, lambda x, i: CASE WHEN {Q.heading('x')} THEN {{'at': i - 1, 'name': {Q.section_name('x')}}} END), lambda x: x IS NOT NULL) AS heads
               FROM (SELECT doc_id, {Q.lines("regexp_replace(" + Q.replaced('text', chr(92) + 'r' + chr(92) + 'n?', 'chr(10)') + ", '" + chr(92) + "n$', '')")} AS l FROM documents WHERE text IS NOT NULL)),
         s AS (SELECT doc_id, len(l) AS n, CASE WHEN len(heads) > 0 AND heads[1].at = 0 THEN 1 ELSE 0 END AS shift,
                      CASE WHEN len(heads) > 0 AND heads[1].at = 0 THEN heads ELSE list_concat([{{'at': 0::BIGINT, 'name': 'INÍCIO'}}], heads) END AS s FROM h)
    SELECT doc_id, CAST(i - 1 + shift AS INTEGER) AS section_no, s[i].name AS section, CAST(s[i].at AS INTEGER) AS start_line, CAST(coalesce(s[i + 1].at, n) AS INTEGER) AS end_line
    FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM s)"""


def sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = _documents(spark, sf_dir).where("text is not null").select("doc_id", chunking.sentence_pieces(F.col("text")).alias("p"))
    return cut.select("doc_id", F.size("p").alias("pieces"), F.sha2(F.array_join("p", "|"), 256).alias("digest"))


_PIECES = r"""SELECT doc_id, len(p) AS pieces, sha256(array_to_string(p, '|')) AS digest FROM (
    SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(text, '([.!?…;])[ \t]+', '\1' || chr(10), 'g'), '\n+'), lambda x: trim(x)), lambda x: x <> '') AS p
    FROM documents WHERE text IS NOT NULL)"""


def processed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records through the whole pipeline with the text of their first document: status, reason and cluster."""
    raw = table(spark, sf_dir, "raw_records")
    newest = raw.groupBy("bdtd_id").agg(F.max_by(F.struct("status", "metadata", "raw_record"), "checked_at").alias("r")).select("bdtd_id", "r.*")
    texts = _documents(spark, sf_dir).where("bdtd_id is not null").groupBy("bdtd_id").agg(F.min_by("text", "doc_id").alias("text"))
    processed, _ = process(newest, texts)
    return processed.select("bdtd_id", "status", "reason_code", "cluster_id", "chunk_count")


def chunks_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of about 1,024 tokens with a tail of at least 128 repeated."""
    return chunking.chunk_documents(_documents(spark, sf_dir), "doc_id", "text", "title").select("chunk_id", "doc_id", "section", "page", "position", "tokens", F.sha2("text", 256).alias("digest"))


_l = Q.lines("x")
_kept_pages = f"array_to_string(list_filter({_l}, lambda l: NOT regexp_matches({Q.strip('l')}, '{Q.PAGE_NUMBER}')), chr(10))"
_repeated = f"""(SELECT array_to_string(list_filter({_l}, lambda l: NOT list_contains(far, {Q.strip('l')})), chr(10)) FROM (
    SELECT list_filter(list_distinct(list_filter(s, lambda v, i: i >= 3 AND s[i - 2] = v)), lambda v: length(v) >= 4 AND NOT {Q.matches('v', Q.CHAPTER)} AND NOT regexp_matches(v, '{Q.PAGE_NUMBER}')) AS far
    FROM (SELECT list_sort(list_transform({_l}, lambda l: {Q.strip('l')})) AS s)))"""
_front = f"(SELECT CASE WHEN k > 1 THEN array_to_string(list_slice({_l}, k, len({_l})), chr(10)) ELSE x END FROM (SELECT coalesce(list_position(list_transform({_l}, lambda l: {Q.matches(Q.strip('l'), Q.CHAPTER)}), true), 0) AS k))"
_refs = f"""(SELECT CASE WHEN k > 0 THEN regexp_replace(array_to_string(list_slice({_l}, 1, k - 1), chr(10)), '\\s+$', '') || chr(10) ELSE x END FROM (
    SELECT coalesce(list_position(list_transform({_l}, lambda l, i: i - 1 >= floor(len({_l}) * 0.35) AND {Q.matches(Q.strip('l'), Q.REFERENCES)}), true), 0) AS k))"""

QUERIES = {
    "clean_whitespace_digest": _stepped(T.clean_whitespace),
    "page_number_strip": _stepped(T.strip_page_numbers),
    "repeated_line_strip": _stepped(T.strip_repeated_lines),
    "cut_front_matter": _stepped(T.cut_front_matter),
    "cut_references": _stepped(T.cut_references),
    "clean_text": clean_text,
    "quality_metrics": quality_metrics,
    "quality_verdict_counts": quality_verdict_counts,
    "char_histogram": char_histogram,
    "pii_counts": pii_counts,
    "pii_redacted_digest": _stepped(redaction.redact_patterns),
    "pii_totals": pii_totals,
    "pii_residual": pii_residual,
    "known_name_redaction": known_name_redaction,
    "exact_dedup_keep_first": exact_dedup_keep_first,
    "dedup_cluster_stats": dedup_cluster_stats,
    "leader_clusters": leader_clusters,
    "minhash_bands": minhash_bands,
    "sections": sections,
    "sentence_pieces": sentence_pieces,
    "chunks_packed": chunks_packed,
    "processed_statuses": processed_statuses,
}
_COUNTS = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, {n} AS n FROM documents WHERE text IS NOT NULL" for k, n in Q.counts("text"))
_RESIDUAL = " UNION ALL ".join(
    f"SELECT '{k}' AS kind, sum(len(regexp_extract_all(t, {Q.quoted(p)}))) AS total FROM (SELECT {Q.redacted('text')} AS t FROM documents WHERE text IS NOT NULL)" for k, p in redaction.PATTERNS
)
ORACLES = {
    "clean_whitespace_digest": _stepped_sql(Q.clean_whitespace("x")),
    "page_number_strip": _stepped_sql(_kept_pages),
    "repeated_line_strip": _stepped_sql(_repeated),
    "cut_front_matter": _stepped_sql(_front),
    "cut_references": _stepped_sql(_refs),
    "quality_metrics": f"SELECT doc_id, lang, round(confidence, 6) AS confidence, round(repetition_ratio, 6) AS repetition_ratio, round(junk_ratio, 6) AS junk_ratio, char_count, {_VERDICT} AS reason FROM ({_METRICS})",
    "quality_verdict_counts": f"SELECT lang, {_VERDICT} AS reason, count(*) AS texts FROM ({_METRICS}) GROUP BY ALL",
    "char_histogram": f"SELECT b AS bucket, count(n) AS texts FROM (VALUES {', '.join(f'({Q.quoted(label)})' for _, label in quality.BUCKETS)}) v(b) LEFT JOIN (SELECT {Q.bucket('n_chars')} AS n FROM documents) ON n = b GROUP BY b",
    "pii_counts": f"SELECT * FROM ({_COUNTS}) WHERE n > 0",
    "pii_redacted_digest": _stepped_sql(Q.redacted("x")),
    "pii_totals": f"SELECT kind, CAST(sum(n) AS BIGINT) AS total FROM ({_COUNTS}) WHERE n > 0 GROUP BY kind",
    "pii_residual": f"SELECT kind, CAST(total AS BIGINT) AS total FROM ({_RESIDUAL})",
    "exact_dedup_keep_first": _KEEP_FIRST,
    "dedup_cluster_stats": f"SELECT count(*) AS records, count(DISTINCT cluster_id) AS clusters, count(*) FILTER (cluster_id <> doc_id) AS duplicates FROM ({_KEEP_FIRST})",
    "sections": _SECTIONS,
    "sentence_pieces": _PIECES,
}
