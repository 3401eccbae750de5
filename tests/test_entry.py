import __spark_entry__ as driver
from lavra.operators.quality import quality_verdicts


def test_entry_runs_the_flagship_query_over_all_documents(spark):
    rows = driver.entry(spark).collect()
    assert sum(r["texts"] for r in rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_every_oracle_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_verdicts_follow_the_order_of_the_rules(spark):
    pt, en = (" ".join(f"{w} palavra{k}" for k in range(90)) for w in ("não", "the"))
    texts = {1: "curto", 2: en, 3: pt, 4: "um dois tres quatro cinco " * 40, 5: pt + "©" * 400, 6: None}
    rows = quality_verdicts(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", "text").collect()
    assert {r["doc_id"]: r["reason"] for r in rows} == {1: "too_short", 2: "not_portuguese", 3: None, 4: "too_repetitive", 5: "too_junky", 6: "too_short"}
    assert {r["doc_id"]: r["junk_ratio"] for r in rows}[6] == 1.0
