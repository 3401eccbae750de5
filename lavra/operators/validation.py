"""Validators of the raw and processed layers: every broken rule is a row ``(code, id)``; no rows means valid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.scalars import nonblank
from lavra.operators.staging import SHA256

# The vocabularies of the layers.
RAW_STATUSES = ("downloaded", "restricted", "unavailable", "duplicate")
PROCESSED_STATUSES = ("completed", "no_text", "filtered", "duplicate", "skipped")
NEEDS_REASON = ("no_text", "filtered", "skipped")


def _rules(df: DataFrame, key: str, rules: list[tuple[str, object]]) -> DataFrame:
    """One pass for all rules: the codes of the broken ones are exploded. A rule that is null counts as kept."""
    codes = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(code)) for code, broken in rules]))
    return df.select(F.explode(codes).alias("code"), F.col(key).alias("id"))


def raw_issues(records: DataFrame, key: str = "bdtd_id") -> DataFrame:
    """Issues of collected records: unknown status, downloaded without document, and fields of the document."""
    downloaded = F.col("status") == "downloaded"
    has = downloaded & F.col("document").isNotNull()
    return _rules(
        records,
        key,
        [
            ("required", nonblank(F.col(key)).isNull()),
            ("status", F.col("status").isNull() | ~F.col("status").isin(*RAW_STATUSES)),
            ("document", downloaded & F.col("document").isNull()),
            ("document_field", has & (nonblank(F.col("document.source_url")).isNull() | nonblank(F.col("document.sha256")).isNull())),
            ("byte_count", has & (F.col("document.byte_count").isNull() | (F.col("document.byte_count") < 1))),
            ("checksum", has & ~F.coalesce(F.col("document.sha256"), F.lit("")).rlike(SHA256)),
            ("pdf", has & (F.col("document.pdf_valid") == F.lit(False))),
        ],
    )


def raw_report(records: DataFrame) -> DataFrame:
    """One row of conditional counts; duplicates and everything else that was not downloaded count as skipped."""
    return records.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.col("status") == "downloaded").alias("downloaded_count"),
        F.count_if(F.col("status") != "downloaded").alias("skipped_count"),
        F.count_if(F.col("status") == "duplicate").alias("duplicate_count"),
    )


def processed_issues(records: DataFrame, chunks: DataFrame | None = None, key: str = "bdtd_id") -> DataFrame:
    """Issues of processed records; with ``chunks`` also chunk counts that differ from the distinct chunks there are."""
    done = F.col("status") == "completed"
    found = _rules(
        records,
        key,
        [
            ("record", nonblank(F.col(key)).isNull()),
            ("status", F.col("status").isNull() | ~F.col("status").isin(*PROCESSED_STATUSES)),
            ("reason", F.col("status").isin(*NEEDS_REASON) & nonblank(F.col("reason_code")).isNull()),
            ("cluster_id", F.col("status").isin("completed", "duplicate") & nonblank(F.col("cluster_id")).isNull()),
            ("sha256_text", done & ~F.coalesce(F.col("sha256_text"), F.lit("")).rlike(SHA256)),
            ("chunk_count", done & (F.col("chunk_count").isNull() | (F.col("chunk_count") < 1))),
        ],
    )
    if chunks is None:
        return found
    there = chunks.select(key, "chunk_id").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    wrong = records.where(done).join(there, key, "left").where(F.coalesce("n", F.lit(0)) != F.coalesce("chunk_count", F.lit(0)))
    return found.unionAll(wrong.select(F.lit("chunk_count_differs").alias("code"), F.col(key).alias("id")))


def status_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


def valid(issues: DataFrame) -> bool:
    return issues.isEmpty()


def describe(report: dict[str, object], names: dict[str, str] | None = None) -> str:
    """A sentence for people from the counts of an integrity report."""
    counts = {k: v for k, v in sorted(report["counts"].items()) if v}
    return "; ".join(f"{v} {(names or {}).get(k, k)}" for k, v in counts.items()) or "no problems"


def unresolved_evidence(cases: DataFrame, known: DataFrame, groups: str = "evidence_groups", ref: str = "ref") -> DataFrame:
    """``id, ref``: references of any evidence group that are not known."""
    wanted = cases.select("id", F.explode(F.array_distinct(F.flatten(groups))).alias("ref"))
    return wanted.join(known.select(F.col(ref).alias("ref")).distinct(), "ref", "left_anti").select("id", "ref")


def any_of(*conditions):
    return reduce(lambda a, b: a | b, conditions)
