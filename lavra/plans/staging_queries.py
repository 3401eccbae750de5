"""Queries over the raw, exported and processed records: candidates, sources, states, validation and plans of synchronisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions import scalars as S
from lavra.operators import staging, sync, validation
from lavra.plans import sql as Q
from lavra.session import table

NOW = "2024-01-20 00:00:00"


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_records")


def staged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = staging.staged(_raw(spark, sf_dir))
    return found.withColumns({"authors": F.array_join("authors", "|"), "subjects": F.array_join("subjects", "|")})


_NEWEST = "(SELECT bdtd_id, unnest(r) FROM (SELECT bdtd_id, arg_max({'status': status, 'm': metadata, 'checked_at': checked_at}, checked_at) AS r FROM raw_records GROUP BY bdtd_id))"
_texts = lambda x: f"list_filter(list_transform(coalesce({x}, []), lambda v: {Q.strip('v')}), lambda v: v <> '')"
_dated = "^([0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}/[0-9]{2}/[0-9]{2})$"
_authors = f"list_filter({_texts('m.authors')}, lambda v: length(v) >= 3 AND NOT regexp_matches(v, '{_dated}') AND regexp_matches(v, '[A-Za-zÀ-ÖØ-öø-ÿ]'))"
_distinct = lambda x: f"(SELECT list_filter(q, lambda v, i: list_position(q, v) = i) FROM (SELECT {x} AS q))"
_STAGED = f"""
    SELECT bdtd_id, status, regexp_replace(regexp_replace(bdtd_id, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS file_name,
           {Q.strip("coalesce(m.title, '')")} AS title, {Q.strip("coalesce(m.institution, '')")} AS institution, {Q.strip("coalesce(m.repository, '')")} AS repository,
           array_to_string({_distinct(_authors)}, '|') AS authors, array_to_string({_texts('m.subjects')}, '|') AS subjects,
           {Q.iso_date('m.date')} AS date_iso, {Q.year('m.date')} AS year, {Q.language_code('m.language')} AS language_code,
           regexp_matches(lower(coalesce(m.access_rights, '')), '{S.RESTRICTED}') AS restricted, {Q.canonical_url("coalesce(m.source_url, '')")} AS source_url,
           regexp_replace({Q.plain("coalesce(m.title, '')")} || '|' || {Q.plain("coalesce(" + _texts('m.authors') + "[1], '')")} || '|' || {Q.year('m.date')}, '[|]+$', '') AS metadata_key
    FROM {_NEWEST}"""


def latest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records collected before the middle of the run, overridden by those collected after it."""
    rows = _raw(spark, sf_dir).select("bdtd_id", "status", "page", "checked_at")
    late = F.col("checked_at") >= F.lit(NOW).cast("timestamp_ntz")
    return staging.upsert(rows.where(~late), rows.where(late), "bdtd_id", "checked_at")


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.repeated_ids(_raw(spark, sf_dir))


def export_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = staging.export_candidates(table(spark, sf_dir, "bdtd_search_csv"))
    return found.select("row_number", "id", "record_url", "title", F.array_join("authors", "|").alias("authors"), F.array_join("subjects", "|").alias("subjects"), "date", "institution", "repository", F.size("urls").alias("urls"))


_col = lambda c: f'"{c}"'
_topical = Q.plain("concat_ws(' ', " + ", ".join(_col(c) for c in staging.TOPIC_COLUMNS) + ")")
_labels = f"list_transform({Q.split_values(_col('Tipos de acesso'))}, lambda v: {Q.plain('v')})"
_CANDIDATES = f"""
    SELECT csv_row AS row_number, 'csv_' || sha256(concat_ws(chr(31), lower({Q.informed(_col('Identificador persistente ARK'))}),
               array_to_string(list_transform(u, lambda v: {Q.canonical_url('v')}), ' '), {Q.plain('title')}, {Q.plain(Q.informed(_col('Autor(a)')))}, date, {Q.plain('institution')})) AS id,
           u[1] AS record_url, title, array_to_string({Q.split_values(_col('Autor(a)'))}, '|') AS authors,
           array_to_string(list_concat({Q.split_values(_col('Assuntos em português'))}, {Q.split_values(_col('Assuntos em inglês'))}), '|') AS subjects, date, institution,
           coalesce(nullif({Q.informed(_col('Sigla da instituição de defesa'))}, ''), nullif(institution, ''), '') AS repository, len(u) AS urls
    FROM (SELECT *, {Q.informed(_col('Título'))} AS title, {Q.informed(_col('Ano de defesa'))} AS date, {Q.informed(_col('Instituição de defesa'))} AS institution,
                 {Q.urls_in(_col('Link de acesso'))} AS u, {_labels} AS labels FROM bdtd_search_csv)
    WHERE title <> '' AND len(u) > 0 AND list_contains(labels, 'openaccess') AND len(list_filter(labels, lambda v: regexp_matches(v, 'restrictedaccess|embargoedaccess'))) = 0
          AND regexp_matches({_topical}, '{"|".join(staging.TOPIC_TERMS)}')"""


def export_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of every export row with their canonical forms."""
    rows = table(spark, sf_dir, "bdtd_search_csv").select("csv_row", F.posexplode(S.urls_in(F.col("`Link de acesso`"))).alias("place", "url"))
    return rows.select("csv_row", "place", "url", S.canonical_url(F.col("url")).alias("canonical"))


def export_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the subjects by the export's own delimiter alone."""
    rows = table(spark, sf_dir, "bdtd_search_csv").select("csv_row", F.posexplode(S.split_values(F.col("`Assuntos em português`"))).alias("place", "value"))
    return rows


def known_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.known_sources(_raw(spark, sf_dir))


_LINKS = f"list_concat({_texts('[document.source_url, metadata.source_url]')}, {_texts('list_transform(coalesce(raw_record.urls, []), lambda v: v.url)')})"
_KNOWN = f"""SELECT url, arg_max(bdtd_id, {{'c': checked_at, 'b': bdtd_id}}) AS known_id FROM (
    SELECT bdtd_id, checked_at, unnest(list_distinct(list_concat(k, list_transform(k, lambda v: {Q.canonical_url('v')})))) AS url FROM (SELECT *, {_LINKS} AS k FROM raw_records)) GROUP BY url"""


def duplicate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored record whose address each export row names first."""
    rows = table(spark, sf_dir, "bdtd_search_csv").select("csv_row", S.urls_in(F.col("`Link de acesso`")).alias("urls"))
    return staging.duplicate_sources(rows, known_sources(spark, sf_dir), "csv_row", "urls")


_DUPLICATE_SOURCES = f"""
    SELECT r.csv_row, d.duplicate_of FROM (SELECT DISTINCT csv_row FROM bdtd_search_csv) r LEFT JOIN (
        SELECT csv_row, arg_min(known_id, k) AS duplicate_of FROM (
            SELECT csv_row, k, unnest(list_distinct([u[k], {Q.canonical_url('u[k]')}])) AS url FROM (
                SELECT csv_row, u, unnest(range(1, len(u) + 1)) AS k FROM (SELECT csv_row, {Q.urls_in(_col('Link de acesso'))} AS u FROM bdtd_search_csv)))
        JOIN ({_KNOWN}) USING (url) GROUP BY csv_row) d USING (csv_row)"""


def known_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.known_payloads(_raw(spark, sf_dir))


def cooldown_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.cooling(_raw(spark, sf_dir), F.lit(NOW).cast("timestamp_ntz"))


_HOURS = "CASE " + " ".join(f"WHEN r = '{k}' THEN {v}" for k, v in staging.COOLDOWN_HOURS.items()) + f" ELSE {staging.DEFAULT_COOLDOWN_HOURS} END"
_COOLING = f"""SELECT DISTINCT bdtd_id, r AS reason FROM (SELECT bdtd_id, checked_at, coalesce({Q.nonblank('reason')}, status) AS r FROM raw_records WHERE status IN ('unavailable', 'restricted'))
               WHERE checked_at + to_hours({_HOURS}) > TIMESTAMP '{NOW}'"""


def open_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are neither processed to the end nor cooling."""
    done = table(spark, sf_dir, "processed_records").where("status = 'completed'").select("bdtd_id")
    return staging.open_candidates(_raw(spark, sf_dir).select("bdtd_id").distinct(), "bdtd_id", done, cooldown_filter(spark, sf_dir))


def integrity_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downloaded records against completed ones: missing and stale ids."""
    return staging.integrity(_raw(spark, sf_dir).where("status = 'downloaded'"), table(spark, sf_dir, "processed_records").where("status = 'completed'"), "bdtd_id", "bdtd_id")


def integrity_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that records name against the documents there are."""
    named = _raw(spark, sf_dir).where("document.path is not null").select("bdtd_id")
    return staging.integrity(named, table(spark, sf_dir, "documents"), "bdtd_id", "bdtd_id")


_integrity = lambda a, b: f"SELECT 'missing' AS code, id FROM ({a} EXCEPT {b}) UNION ALL SELECT 'stale', id FROM ({b} EXCEPT {a})"


def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.raw_issues(_raw(spark, sf_dir))


def raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.raw_report(_raw(spark, sf_dir))


def processed_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.processed_issues(table(spark, sf_dir, "processed_records"), table(spark, sf_dir, "curated_chunks"))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.status_counts(table(spark, sf_dir, "processed_records"))


def repeated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _raw(spark, sf_dir).where("page is not null").groupBy("page").agg(F.collect_list("bdtd_id").alias("ids"))
    return staging.repeated_pages(pages)


def until_successes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in order up to the hundredth that is long enough."""
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.coalesce("n_chars", F.lit(0)) >= 500).alias("ok"))
    return staging.until_successes(rows, "doc_id", "ok", 100).select("doc_id")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).where("document.path is not null").select("document.path", F.col("document.byte_count").alias("size"), F.col("document.sha256").alias("hash"), "page").distinct()


def bucket_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payloads against a listing that has those of the even pages."""
    rows = _payloads(spark, sf_dir)
    local = rows.groupBy("path").agg(F.max("size").alias("size"))
    return sync.bucket_plan(local, rows.where("page % 2 = 0").groupBy(F.concat(F.lit("raw/"), "path").alias("key")).agg(F.max("size").alias("size")), "raw")


def drive_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _payloads(spark, sf_dir)
    newest = rows.groupBy("path").agg(F.max("size").alias("size"), F.max("hash").alias("hash"))
    return sync.drive_plan(newest, rows.where("page % 2 = 0").groupBy("path").agg(F.max("size").alias("size"), F.max("hash").alias("hash")))


_PAYLOADS = "(SELECT DISTINCT document.path AS path, document.byte_count AS size, document.sha256 AS hash, page FROM raw_records WHERE document.path IS NOT NULL)"
_LOCAL = f"(SELECT path, max(size) AS size, max(hash) AS hash FROM {_PAYLOADS} GROUP BY path)"
_REMOTE = f"(SELECT path, max(size) AS size, max(hash) AS hash FROM {_PAYLOADS} WHERE page % 2 = 0 GROUP BY path)"

QUERIES = {
    f.__name__: f
    for f in (
        staged_records, latest_upsert, repeated_ids, export_candidates, export_urls, export_values, known_sources, duplicate_sources, known_payloads, cooldown_filter, open_candidates,
        integrity_records, integrity_files, raw_issues, raw_report, processed_issues, status_counts, repeated_pages, until_successes, bucket_plan, drive_plan,
    )
}
_rule = lambda code, test, source: f"SELECT '{code}' AS code, bdtd_id AS id FROM {source} WHERE {test}"
_SUM = staging.SHA256
ORACLES = {
    "staged_records": _STAGED,
    "latest_upsert": f"""SELECT bdtd_id, unnest(r) FROM (SELECT bdtd_id, arg_max({{'status': status, 'page': page, 'checked_at': checked_at}}, {{'late': checked_at >= TIMESTAMP '{NOW}', 'c': checked_at}}) AS r
                         FROM raw_records GROUP BY bdtd_id)""",
    "repeated_ids": "SELECT bdtd_id, count(*) AS times FROM raw_records GROUP BY bdtd_id HAVING count(*) > 1",
    "export_candidates": _CANDIDATES,
    "export_urls": f"""SELECT csv_row, CAST(k - 1 AS INTEGER) AS place, u[k] AS url, {Q.canonical_url('u[k]')} AS canonical FROM (
        SELECT csv_row, u, unnest(range(1, len(u) + 1)) AS k FROM (SELECT csv_row, {Q.urls_in(_col('Link de acesso'))} AS u FROM bdtd_search_csv))""",
    "export_values": f"""SELECT csv_row, CAST(k - 1 AS INTEGER) AS place, v[k] AS value FROM (
        SELECT csv_row, v, unnest(range(1, len(v) + 1)) AS k FROM (SELECT csv_row, {Q.split_values(_col('Assuntos em português'))} AS v FROM bdtd_search_csv))""",
    "known_sources": _KNOWN,
    "duplicate_sources": _DUPLICATE_SOURCES,
    "known_payloads": """WITH p AS (SELECT DISTINCT bdtd_id, lower(document.sha256) AS s, checked_at FROM raw_records WHERE status = 'downloaded' AND document.sha256 IS NOT NULL)
        SELECT DISTINCT bdtd_id, first AS duplicate_of FROM (SELECT bdtd_id, first_value(bdtd_id) OVER (PARTITION BY s ORDER BY checked_at, bdtd_id) AS first FROM p) WHERE bdtd_id <> first""",
    "cooldown_filter": _COOLING,
    "open_candidates": f"SELECT bdtd_id FROM raw_records EXCEPT SELECT bdtd_id FROM processed_records WHERE status = 'completed' EXCEPT SELECT bdtd_id FROM ({_COOLING})",
    "integrity_records": _integrity("SELECT bdtd_id AS id FROM raw_records WHERE status = 'downloaded'", "SELECT bdtd_id AS id FROM processed_records WHERE status = 'completed'"),
    "integrity_files": _integrity("SELECT bdtd_id AS id FROM raw_records WHERE document.path IS NOT NULL", "SELECT bdtd_id AS id FROM documents WHERE bdtd_id IS NOT NULL"),
    "raw_issues": " UNION ALL ".join(
        _rule(c, t, "raw_records")
        for c, t in (
            ("required", f"{Q.nonblank('bdtd_id')} IS NULL"),
            ("status", "status IS NULL OR status NOT IN ('downloaded', 'restricted', 'unavailable', 'duplicate')"),
            ("document", "status = 'downloaded' AND document IS NULL"),
            ("document_field", f"status = 'downloaded' AND document IS NOT NULL AND ({Q.nonblank('document.source_url')} IS NULL OR {Q.nonblank('document.sha256')} IS NULL)"),
            ("byte_count", "status = 'downloaded' AND document IS NOT NULL AND (document.byte_count IS NULL OR document.byte_count < 1)"),
            ("checksum", f"status = 'downloaded' AND document IS NOT NULL AND NOT regexp_matches(coalesce(document.sha256, ''), '{_SUM}')"),
            ("pdf", "status = 'downloaded' AND document.pdf_valid = false"),
        )
    ),
    "raw_report": """SELECT count(*) AS record_count, count(*) FILTER (status = 'downloaded') AS downloaded_count, count(*) FILTER (status <> 'downloaded') AS skipped_count,
        count(*) FILTER (status = 'duplicate') AS duplicate_count FROM raw_records""",
    "processed_issues": " UNION ALL ".join(
        _rule(c, t, "processed_records")
        for c, t in (
            ("record", f"{Q.nonblank('bdtd_id')} IS NULL"),
            ("status", "status IS NULL OR status NOT IN ('completed', 'no_text', 'filtered', 'duplicate', 'skipped')"),
            ("reason", f"status IN ('no_text', 'filtered', 'skipped') AND {Q.nonblank('reason_code')} IS NULL"),
            ("cluster_id", f"status IN ('completed', 'duplicate') AND {Q.nonblank('cluster_id')} IS NULL"),
            ("sha256_text", f"status = 'completed' AND NOT regexp_matches(coalesce(sha256_text, ''), '{_SUM}')"),
            ("chunk_count", "status = 'completed' AND (chunk_count IS NULL OR chunk_count < 1)"),
        )
    )
    + """ UNION ALL SELECT 'chunk_count_differs', bdtd_id FROM processed_records LEFT JOIN (SELECT bdtd_id, count(DISTINCT chunk_id) AS n FROM curated_chunks GROUP BY bdtd_id) USING (bdtd_id)
          WHERE status = 'completed' AND coalesce(n, 0) <> coalesce(chunk_count, 0)""",
    "status_counts": "SELECT status, count(*) AS records FROM processed_records GROUP BY status",
    "repeated_pages": """WITH p AS (SELECT page, sha256(array_to_string(list_sort(list(bdtd_id)), ' ')) AS p FROM raw_records WHERE page IS NOT NULL GROUP BY page)
        SELECT page, page > min(page) OVER (PARTITION BY p) AS repeated FROM p""",
    "until_successes": """SELECT doc_id FROM (SELECT doc_id, coalesce(sum(CASE WHEN coalesce(n_chars, 0) >= 500 THEN 1 ELSE 0 END)
        OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before < 100""",
    "bucket_plan": f"""SELECT l.path, 'raw/' || l.path AS key, CASE WHEN l.size IS NOT NULL AND l.size = r.size THEN 'skip' ELSE 'upload' END AS action
        FROM {_LOCAL} l LEFT JOIN {_REMOTE} r ON r.path = l.path""",
    "drive_plan": f"""SELECT path, action, CASE WHEN action = 'duplicate' THEN coalesce(there, first) END AS same_as FROM (
        SELECT l.path, h.there, o.first, CASE WHEN r.hash = l.hash THEN 'skip' WHEN h.there IS NOT NULL THEN 'duplicate' WHEN l.size = r.size THEN 'skip' WHEN o.first < l.path THEN 'duplicate' ELSE 'upload' END AS action
        FROM {_LOCAL} l LEFT JOIN (SELECT hash, min(path) AS there FROM {_REMOTE} WHERE hash IS NOT NULL GROUP BY hash) h ON h.hash = l.hash
        LEFT JOIN {_REMOTE} r ON r.path = l.path LEFT JOIN (SELECT hash, min(path) AS first FROM {_LOCAL} WHERE hash IS NOT NULL GROUP BY hash) o ON o.hash = l.hash)""",
}
