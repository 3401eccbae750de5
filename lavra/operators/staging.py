"""The raw and staged layers: export candidates, known sources, duplicates, cooldowns, upserts and integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions import scalars as S

# Days (or parts of one) in which a failed record is not tried again, by reason.
COOLDOWN_HOURS = {"record_batch_unavailable": 0, "landing_antibot": 168, "landing_js_gate": 168, "restricted_rights": 720, "landing_no_pdf_link": 720, "download_invalid": 720, "no_source_url": 720}
DEFAULT_COOLDOWN_HOURS = 6
# Columns of the export and the terms that a candidate's topic must have one of.
TOPIC_TERMS = ("computacao", "informatica", "informacao")
TOPIC_COLUMNS = ("Título", "Área do conhecimento CNPq", "Assuntos em português", "Assuntos em inglês")
REQUIRED_COLUMNS = ("Título", "Tipos de acesso", "Link de acesso")
SHA256 = "^[0-9a-fA-F]{64}$"
STATUSES = ("downloaded", "restricted", "unavailable", "duplicate", "error")


def export_candidates(rows: DataFrame, number: str = "csv_row", only_topic: bool = True) -> DataFrame:
    """Candidates of an export: rows with a title, open access, a topic term and a web address.

    Missing columns count as null; rows exported twice under another number give the same ``id``. One native pass.
    """
    has = set(rows.columns)
    if missing := [c for c in REQUIRED_COLUMNS if c not in has]:
        raise ValueError(f"columns missing in the export: {missing}")
    col = lambda c: F.col(f"`{c}`") if c in has else F.lit(None).cast("string")
    value = lambda c: S.informed(col(c))
    topical = S.plain(F.concat_ws(" ", *[col(c) for c in TOPIC_COLUMNS]))
    urls = S.urls_in(col("Link de acesso"))
    kept = (value("Título") != "") & S.open_access(S.split_values(col("Tipos de acesso"))) & (F.size(urls) > 0)
    if only_topic:
        kept = kept & topical.rlike("|".join(TOPIC_TERMS))
    institution = value("Instituição de defesa")
    identity = [F.lower(value("Identificador persistente ARK")), F.array_join(F.transform(urls, S.canonical_url), " "), S.plain(value("Título")), S.plain(value("Autor(a)")), value("Ano de defesa"), S.plain(institution)]
    return rows.where(kept).select(
        S.surrogate_id("csv_", *identity).alias("id"), F.col(number).alias("row_number"), urls[0].alias("record_url"), value("Título").alias("title"),
        S.split_values(col("Autor(a)")).alias("authors"),
        S.first_text(value("Resumo em Português"), value("Resumo"), value("Resumo em Inglês")).alias("abstract"),
        F.concat(S.split_values(col("Assuntos em português")), S.split_values(col("Assuntos em inglês"))).alias("subjects"), value("Ano de defesa").alias("date"),
        S.split_values(col("Tipo de documento")).alias("formats"), S.split_values(col("Idioma")).alias("languages"), institution.alias("institution"),
        S.first_text(value("Sigla da instituição de defesa"), institution).alias("repository"), urls.alias("urls"),
    )


def known_sources(records: DataFrame) -> DataFrame:
    """``url, known_id``: every address of a stored record, as it is and canonical; the latest record has it (by ``checked_at``, id)."""
    links = S.texts_of(F.array("document.source_url", "metadata.source_url"), F.col("raw_record.urls.url"))
    both = F.array_distinct(F.concat(links, F.transform(links, S.canonical_url)))
    return records.select("bdtd_id", "checked_at", F.explode(both).alias("url")).groupBy("url").agg(F.max_by("bdtd_id", F.struct("checked_at", "bdtd_id")).alias("known_id"))


def duplicate_sources(candidates: DataFrame, known: DataFrame, key: str, urls: str) -> DataFrame:
    """``key, duplicate_of``: the record that the first known address of each candidate belongs to, null if none is known."""
    exploded = candidates.select(key, F.posexplode(F.col(urls)).alias("at", "u")).select(key, "at", F.explode(F.array_distinct(F.array(F.col("u"), S.canonical_url(F.col("u"))))).alias("url"))
    met = exploded.join(known, "url").groupBy(key).agg(F.min_by("known_id", "at").alias("duplicate_of"))
    return candidates.select(key).distinct().join(met, key, "left")


def known_payloads(records: DataFrame) -> DataFrame:
    """``bdtd_id, duplicate_of``: downloaded records whose payload an earlier one has (by ``checked_at``, id)."""
    payloads = records.where("status = 'downloaded' and document.sha256 is not null").select("bdtd_id", F.lower("document.sha256").alias("sum"), "checked_at").distinct()
    first = payloads.groupBy("sum").agg(F.min_by("bdtd_id", F.struct("checked_at", "bdtd_id")).alias("duplicate_of"))
    return payloads.join(first, "sum").where("bdtd_id <> duplicate_of").select("bdtd_id", "duplicate_of").distinct()


def cooldown_hours(reason: Column) -> Column:
    pairs = [x for k, v in COOLDOWN_HOURS.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[reason], F.lit(DEFAULT_COOLDOWN_HOURS))


def cooling(records: DataFrame, now: Column) -> DataFrame:
    """``bdtd_id, reason``: unavailable or restricted records that may not be tried again yet at ``now``; null times count as expired."""
    reason = F.coalesce(S.nonblank(F.col("reason")), F.col("status"))
    dead = records.where(F.col("status").isin("unavailable", "restricted")).select("bdtd_id", reason.alias("reason"), "checked_at")
    return dead.where(F.col("checked_at") + F.make_dt_interval(F.lit(0), cooldown_hours(F.col("reason"))) > now).select("bdtd_id", "reason").distinct()


def open_candidates(candidates: DataFrame, key: str, *closed: DataFrame) -> DataFrame:
    """Candidates whose key stands in none of ``closed`` (known, cooling or attempted ids), by anti joins."""
    for ids in closed:
        candidates = candidates.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_anti")
    return candidates


def upsert(existing: DataFrame, run: DataFrame, key: str, order: str) -> DataFrame:
    """The latest state of each key: rows of ``run`` replace those of ``existing``, later ones (by ``order``) earlier ones."""
    both = existing.withColumn("_run", F.lit(0)).unionByName(run.withColumn("_run", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (key, "_run")]
    newest = both.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct("_run", F.col(f"`{order}`"))).alias("r"))
    return newest.select(key, "r.*")


def staged(records: DataFrame) -> DataFrame:
    """Records with repaired texts, ISO dates, years and language codes; one row for each id, the one checked last."""
    last = upsert(records.limit(0), records, "bdtd_id", "checked_at")
    m = "metadata"
    return last.select(
        "bdtd_id", "status", S.safe_name(F.col("bdtd_id")).alias("file_name"),
        *[S.strip(F.coalesce(F.col(f"{m}.{c}"), F.lit(""))).alias(c) for c in ("title", "institution", "repository")],
        S.author_names(F.col(f"{m}.authors")).alias("authors"), S.texts_of(F.col(f"{m}.subjects")).alias("subjects"),
        S.iso_date(F.col(f"{m}.date")).alias("date_iso"), S.year(F.col(f"{m}.date")).alias("year"), S.language_code(F.col(f"{m}.language")).alias("language_code"),
        S.restricted(F.col(f"{m}.access_rights")).alias("restricted"), S.canonical_url(F.coalesce(F.col(f"{m}.source_url"), F.lit(""))).alias("source_url"),
        S.metadata_key(F.col(f"{m}.title"), S.first_of(F.col(f"{m}.authors")), F.col(f"{m}.date")).alias("metadata_key"),
    )


def repeated_ids(records: DataFrame, key: str = "bdtd_id") -> DataFrame:
    return records.groupBy(key).agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def integrity(wanted: DataFrame, stored: DataFrame, wanted_key: str, stored_key: str) -> DataFrame:
    """``code, id``: ``missing`` for wanted ids that are not stored, ``stale`` for stored ids that are not wanted. Null ids are neither."""
    a = wanted.select(F.col(wanted_key).alias("id")).where("id is not null").distinct()
    b = stored.select(F.col(stored_key).alias("id")).where("id is not null").distinct()
    both = a.withColumn("w", F.lit(1)).join(b.withColumn("s", F.lit(1)), "id", "full")
    return both.where("w is null or s is null").select(F.when(F.col("s").isNull(), "missing").otherwise("stale").alias("code"), "id")


def inspect_documents(records: DataFrame, files: DataFrame) -> DataFrame:
    """``bdtd_id, detected, type_mismatch, checksum_mismatch`` of downloaded records against ``files`` (``path, content``).

    No path: unknown, both true. A path without a file: unknown, both false. An empty declared type or checksum never differs.
    """
    documents = records.where("document is not null").select("bdtd_id", "document.path", "document.content_type", "document.sha256")
    found = files.select("path", S.content_kind(F.substring("content", 1, 8)).alias("kind"), F.sha2("content", 256).alias("sum"))
    declared = F.lower(F.trim(F.split_part(F.coalesce("content_type", F.lit("")), F.lit(";"), F.lit(1))))
    no_path = S.nonblank(F.col("path")).isNull()
    differs = lambda a, b: (a != "") & (a != b)
    return documents.join(found, "path", "left").select(
        "bdtd_id", F.coalesce("kind", F.lit("unknown")).alias("detected"),
        F.when(no_path, True).when(F.col("kind").isNull(), False).otherwise(differs(declared, F.col("kind"))).alias("type_mismatch"),
        F.when(no_path, True).when(F.col("sum").isNull(), False).otherwise(differs(F.lower(F.coalesce("sha256", F.lit(""))), F.col("sum"))).alias("checksum_mismatch"),
    )


def staging_report(problems: DataFrame) -> dict[str, object]:
    """Counts by code, and ``ok``, which stale and orphaned files do not spoil."""
    counts = {r["code"]: r["n"] for r in problems.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {"counts": counts, "ok": not any(n for code, n in counts.items() if code not in ("stale", "orphan"))}


def prunable(paths: DataFrame, root: str) -> DataFrame:
    """Paths that lie below ``root``: only these may be deleted."""
    inside = F.col("path").startswith(root.rstrip("/") + "/") & ~F.col("path").rlike(r"(^|/)\.\.(/|$)")
    return paths.where(inside)


def attach_details(ids: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Looked-up ids with their details; ``error`` is set where nothing came back."""
    return ids.join(details.withColumn("_there", F.lit(True)), key, "left").withColumn("error", F.when(F.col("_there").isNull(), "not_returned")).drop("_there")


def repeated_pages(pages: DataFrame) -> DataFrame:
    """``page, repeated``: whether an earlier page had the same fingerprint (sorted ids)."""
    printed = pages.select("page", F.sha2(F.array_join(F.array_sort("ids"), " "), 256).alias("p"))
    first = printed.groupBy("p").agg(F.min("page").alias("first"))
    return printed.join(first, "p").select("page", (F.col("page") > F.col("first")).alias("repeated"))


def until_successes(rows: DataFrame, order: str, success: str, target: int) -> DataFrame:
    """Rows in order up to the one that brings the ``target``-th success. Counts of ranges come first, so no task holds all rows."""
    from pyspark.sql.window import Window

    spread = rows.withColumn("_p", F.floor(F.col(order) / 10_000))
    before = spread.groupBy("_p").agg(F.count_if(F.col(success)).alias("n"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row for every 10,000 rows
    offsets = before.withColumn("off", F.coalesce(F.sum("n").over(w), F.lit(0))).select("_p", "off")
    own = Window.partitionBy("_p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("off") + F.coalesce(F.sum(F.col(success).cast("int")).over(own), F.lit(0))
    return spread.join(offsets, "_p").withColumn("_e", earlier).where(F.col("_e") < target).drop("_p", "_e", "off")
