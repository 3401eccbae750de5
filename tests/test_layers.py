import json

import pytest
from pyspark.sql import functions as F

from lavra.sinks import files as out
from lavra.sources import files, service
from lavra.streaming import records as stream


def test_exports(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text('﻿Título,Tipos de acesso\n"a ""b""\nc",x\nd,\n', encoding="utf-8")
    df = files.numbered_export(spark, str(path), ("Título",))
    assert [tuple(r) for r in df.collect()] == [(2, 'a "b"\nc', "x"), (3, "d", None)]
    with pytest.raises(ValueError):
        files.read_export(spark, str(path), ("Link de acesso",))


def test_manifests_records_and_lines(spark, tmp_path):
    out.write_manifest(tmp_path / "m.json", {"records": [{"bdtd_id": "a"}]})
    assert files.read_manifest(spark, str(tmp_path / "m.json")).count() == 1
    out.write_atomic(tmp_path / "bad.json", "{}")
    with pytest.raises(ValueError):
        files.read_manifest(spark, str(tmp_path / "bad.json"))
    folder = tmp_path / "records"
    for name, body in (("1", '{"bdtd_id": "x", "v": 1}'), ("2", '{"bdtd_id": "x", "v": 2}'), ("3", "{broken"), ("4", '{"v": 3}')):
        out.write_atomic(folder / f"{name}.json", body)
    assert [(r["bdtd_id"], r["v"]) for r in files.read_records(spark, str(folder), "bdtd_id string, v int").collect()] == [("x", 2)]
    lines = tmp_path / "c.jsonl"
    lines.write_text('{"chunk_id": "1", "bdtd_id": "a", "text": "t"}\n\n', encoding="utf-8")
    assert files.read_chunks(spark, str(lines)).count() == 1
    lines.write_text('{"chunk_id": "1", "bdtd_id": " ", "text": "t"}\n', encoding="utf-8")
    assert files.read_chunks(spark, str(lines), strict=False).count() == 0
    with pytest.raises(Exception, match="invalid chunk"):
        files.read_chunks(spark, str(lines)).collect()


def test_files_and_texts(spark, tmp_path):
    out.write_atomic(tmp_path / "d/a.pdf", b"x" * 60)
    out.write_atomic(tmp_path / "d/s/b.pdf", b"y")
    assert {tuple(r) for r in files.list_files(spark, str(tmp_path / "d")).collect()} == {("a.pdf", 60), ("s/b.pdf", 1)}
    found = files.extract_texts(files.read_files(spark, str(tmp_path / "d")), lambda b: [b.decode(), None] if len(b) > 1 else 1 / 0).collect()
    assert sorted((r["pages"], r["valid"]) for r in found) == [(0, False), (2, True)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("á/b", 1), ("c", None)], "k string, v int")
    out.write_lines(df, str(tmp_path / "l"))
    assert sorted(json.loads(r.value).get("k") for r in spark.read.text(str(tmp_path / "l")).collect()) == ["c", "á/b"]
    out.write_each(df.withColumn("t", F.col("v").cast("string")), str(tmp_path / "e"), "k", "t", ".txt")
    assert [p.name for p in (tmp_path / "e").iterdir()] == ["b.txt"]
    told = out.save_document(tmp_path / "docs", "r1", b"%PDF-1 %%EOF", "application/pdf", "attachment; filename=\"tese final.pdf\"")
    assert told["path"].endswith("r1/tese_final.pdf")
    with pytest.raises(ValueError):
        out.save_document(tmp_path, "r", b"no", "application/pdf")
    out.write_index(df, str(tmp_path / "i"), "d", 2, {"chunks": 1})
    assert json.loads((tmp_path / "i/manifest.json").read_text())["status"] == "complete"
    with pytest.raises(FileExistsError):
        out.write_index(df, str(tmp_path / "i"), "d", 2, {})


def test_service_retries_pages_and_look_ups():
    waits, calls = [], []

    def fetch(path, p):
        calls.append(path)
        if path == "search":
            return (503, {"Retry-After": "2"}, {}) if len(calls) == 1 else (200, {}, {"records": [{"id": f"{min(p['page'], 2)}-{i}"} for i in range(2)]})
        ids = p["id[]"]
        return (414, {}, {}) if len(ids) > 2 else (200, {}, {"records": [{"id": i} for i in ids if i != "gone"]})

    client = service.Client(fetch, sleep=waits.append)
    assert [n for n, _ in service.search_pages(client, ["a"], 2)] == [1, 2]  # the third page repeats the second
    assert 2.0 in waits
    assert set(service.look_up(client, ["a", "b", "gone"])) == {"a", "b"}
    with pytest.raises(service.ServiceError):
        service.Client(lambda *_: (404, {}, {}), sleep=waits.append).get("x", {})


def test_streams(spark, tmp_path):
    batches = [[("a", 1, "2024-01-01"), ("a", 1, "2024-01-01")], [("a", 2, "2024-01-02"), ("b", 1, "2024-01-02")]]
    schema = "k string, v int, t timestamp"
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k string, v int, t string").withColumn("t", F.col("t").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        read = stream.read_stream(spark, str(tmp_path / "in"), schema, 1)
        stream.upsert_stream(read, str(tmp_path / "state"), str(tmp_path / "cp"), "k", "t").awaitTermination(60)
    last = max((tmp_path / "state").iterdir(), key=lambda p: int(p.name.split("=")[1]))
    assert {(r["k"], r["v"]) for r in spark.read.parquet(str(last)).collect()} == {("a", 2), ("b", 1)}
    read = stream.read_stream(spark, str(tmp_path / "in"), schema)
    counted = stream.counts_by_window(stream.first_deliveries(read, "k", "t"), "t", "k", late=None)
    q = counted.writeStream.format("memory").queryName("counted").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("counted").columns == ["start", "k", "rows"]
