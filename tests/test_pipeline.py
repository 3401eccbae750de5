from pyspark.sql import functions as F

from lavra.plans import pipeline
from lavra.plans.pipeline import process
from lavra.sinks.files import save_document
from lavra.sources import fixtures


def test_each_record_of_the_fixtures_takes_its_way(spark):
    rows = fixtures.records(spark)
    processed, chunks = process(rows.drop("text"), rows.where("text is not null").select("bdtd_id", "text"))
    got = {r["bdtd_id"]: r for r in processed.collect()}
    assert {k: (r["status"], r["reason_code"]) for k, r in got.items()} == {
        "fixture-a": ("completed", None), "fixture-b": ("duplicate", None), "fixture-c": ("no_text", "empty_text"), "fixture-d": ("filtered", "not_portuguese"),
        "fixture-e": ("skipped", "raw_restricted"),
    }
    assert got["fixture-b"]["cluster_id"] == "fixture-a" and got["fixture-a"]["redaction"]["EMAIL"] == 2 and got["fixture-a"]["redaction"]["PERSON"] >= 2
    texts = [r["text"] for r in chunks.collect()]
    assert texts and not any("Ana Lima" in t or "@" in t or "obras" in t for t in texts) and got["fixture-a"]["chunk_count"] == len(texts)


def test_texts_are_judged_once(spark, monkeypatch):
    judged, verdicts = spark.sparkContext.accumulator(0), pipeline.quality_verdicts

    @F.udf("string")
    def told(reason):
        judged.add(1)
        return reason

    monkeypatch.setattr(pipeline, "quality_verdicts", lambda *a: verdicts(*a).withColumn("reason", told("reason")))
    rows = fixtures.records(spark)
    processed, _ = process(rows.drop("text"), rows.where("text is not null").select("bdtd_id", "text"))
    assert processed.count() == 5 and processed.where("status in ('completed', 'duplicate', 'filtered')").count() == judged.value == 3


def test_empty_tables_pass_through(spark):
    rows = fixtures.records(spark).limit(0)
    processed, chunks = process(rows.drop("text"), rows.select("bdtd_id", "text"))
    assert processed.count() == 0 and chunks.count() == 0


def test_minimal_pdf(tmp_path):
    told = save_document(tmp_path, "k", fixtures.minimal_pdf("a (b)\nc"), "application/pdf")
    assert told["byte_count"] > 300
