"""Evaluation of retrieval: cases by modes, summaries of runs, evidence and claims."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("raw_baseline", "words", "dense", "hybrid")


def case_runs(cases: DataFrame, modes: tuple[str, ...] = MODES) -> DataFrame:
    """Every case with every mode; the modes are a fixed list, exploded in the row."""
    return cases.withColumn("mode", F.explode(F.array(*[F.lit(m) for m in modes])))


def select_cases(cases: DataFrame, ids: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Chosen cases in order of id. Raises for no cases, blank fields and repeated ids."""
    bad = cases.where("id is null or trim(id) = '' or question is null or trim(question) = ''").count()
    total, distinct = cases.count(), cases.select("id").distinct().count()
    if not total or bad or total != distinct:
        raise ValueError(f"{total} cases, {total - distinct} repeated ids, {bad} with blank fields")
    chosen = cases.where(F.col("id").isin(*ids)) if ids else cases
    return chosen.orderBy("id").limit(limit) if limit else chosen


def messages(runs: DataFrame, contexts: DataFrame, rules: str) -> DataFrame:
    """``id, mode, system, user``: what a model is sent; the baseline gets the question alone. ``contexts``: ``id, mode, rank, snippet``."""
    packed = contexts.groupBy("id", "mode").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "snippet"))), lambda x: x["snippet"]), "\n\n").alias("context"))
    told = F.concat(F.lit("TRECHOS RECUPERADOS:\n"), F.coalesce("context", F.lit("Nenhum trecho recuperado.")), F.lit("\n\nPERGUNTA:\n"), F.col("question"))
    baseline = F.col("mode") == "raw_baseline"
    return runs.join(packed, ["id", "mode"], "left").select("id", "mode", F.when(~baseline, rules).alias("system"), F.when(baseline, F.col("question")).otherwise(told).alias("user"))


def answer(asked: DataFrame, model: Callable[[str | None, str], dict]) -> DataFrame:
    """``id, mode, answer, error, done_reason, seconds``: the model is called for each row; an empty answer is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for r in part.itertuples():
                began, got, error = time.perf_counter(), {}, None
                try:
                    got = model(r.system, r.user)
                    if not (got.get("answer") or "").strip():
                        error = "empty answer"
                except Exception as e:  # a failed call is a row of the report
                    error = str(e)
                rows.append((r.id, r.mode, None if error else got["answer"].strip(), error, got.get("done_reason"), time.perf_counter() - began))
            yield pd.DataFrame(rows, columns=["id", "mode", "answer", "error", "done_reason", "seconds"])

    return asked.mapInPandas(run, "id string, mode string, answer string, error string, done_reason string, seconds double")


def mode_summary(rows: DataFrame, mode: str = "mode") -> DataFrame:
    """Per mode: attempted, answered, failed, truncated, and exact medians of the times (generation over answered rows)."""
    answered = F.col("answer").isNotNull()
    return rows.groupBy(F.col(mode).alias("mode")).agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(answered).alias("answered"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.count_if(answered & F.col("done_reason").eqNullSafe("length")).alias("truncated"),
        F.round(F.median("retrieval_seconds"), 6).alias("median_retrieval_seconds"),
        F.round(F.median(F.when(answered, F.col("seconds"))), 6).alias("median_generation_seconds"),
        F.lit(None).cast("double").alias("quality_score"),
    )


def not_completed(cases: int, modes: int, rows: int) -> int:
    return max(0, cases * modes - rows)


def evidence_met(cases: DataFrame, hits: DataFrame) -> DataFrame:
    """``id, met``: every evidence group has a reference among the hits (``id, ref``) of the case; no groups count as met."""
    found = hits.groupBy("id").agg(F.collect_set("ref").alias("refs"))
    refs = F.coalesce(F.col("refs"), F.array().cast("array<string>"))
    met = F.forall("evidence_groups", lambda g: F.exists(g, lambda r: F.array_contains(refs, r)))
    return cases.join(found, "id", "left").select("id", met.alias("met"))


def claim_scores(scores: DataFrame) -> DataFrame:
    """``id, mode, mean_score, success``: claims are scored 0, 0.5 or 1 by people; success asks for 1 in every claim."""
    return scores.groupBy("id", "mode").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.bool_and(F.col("score") == 1).alias("success"))


def report(summary: DataFrame, title: str, missing: int = 0) -> str:
    """Markdown of a summary: one row for each mode."""
    rows = [r.asDict() for r in summary.orderBy("mode").collect()]
    head = list(rows[0]) if rows else ["mode"]
    lines = [f"# {title}", "", "| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    return "\n".join([*lines, *("| " + " | ".join(str(r[h]) for h in head) + " |" for r in rows), "", f"Not completed: {missing}", ""])
