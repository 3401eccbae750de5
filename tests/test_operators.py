import math
import random

import pytest
from pyspark.sql import functions as F

from lavra.operators import chunking, datasets, dedup, evaluation, redaction, retrieval, staging, sync, validation
from lavra.operators.components import connected_components
from lavra.plans import curated_queries


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_pieces_are_packed_with_overlap_and_always_end():
    assert [list(r) for r in chunking.pack([200] * 4 + [900], 1024, 128)] == [[0, 1, 2, 3], [4]]
    assert [list(r) for r in chunking.pack([2000, 10, 10], 1024, 128)] == [[0], [1, 2]]
    assert list(chunking.pack([], 10, 2)) == []
    rng = random.Random(1)
    for _ in range(300):
        sizes = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 40))]
        found = list(chunking.pack(sizes, 32, 8))
        assert found[-1].stop == len(sizes) and all(b.stop > a.stop and b.start <= a.stop for a, b in zip(found, found[1:]))
        assert all(sum(sizes[i] for i in r) <= 32 for r in found)


def test_chunks_and_sections(spark):
    text = "Abertura curta.\n1 Introdução\nUma frase. Outra frase.\n2.1 MÉTODO\nFim."
    df = spark.createDataFrame([(1, "t", text), (2, None, None), (3, "t", " \n "), (1, "t", text)], "k long, title string, text string")
    assert rows(chunking.sections(df.where("k = 1").limit(1), "k", "text")) == {(1, 0, "INÍCIO", 0, 1), (1, 1, "Introdução", 1, 3), (1, 2, "MÉTODO", 3, 5)}
    cut = chunking.chunk_documents(df, "k", "text", "title", target=8, overlap=2)
    found = cut.orderBy("position").collect()
    assert {r["k"] for r in found} == {1} and found[0]["chunk_id"] == "1-chunk-000" and found[0]["section"] == "INÍCIO"
    assert cut.where("tokens > 8").count() == 0
    assert chunking.chunk_documents(df.limit(0), "k", "text").count() == 0


def test_redaction(spark):
    text = "Veja https://a.test e x@y.example, (61) 91234-5678, 123.456.789-00. Orientador: Ana Dias Lima. Bia de  Souza!"
    df = spark.createDataFrame([(text, ["Souza, x", "Bia de Souza", "Solo", None]), (None, None), ("", [])], "text string, names array<string>")
    got = redaction.anonymize(df, "text", "names").collect()
    assert got[0]["text"] == "Veja <<URL>> e <<EMAIL>>, <<PHONE>>, <<CPF>>. <<PERSON>>. <<PERSON>>!"
    assert got[0]["redactions"] == {"URL": 1, "EMAIL": 1, "PHONE": 1, "CPF": 1, "PERSON": 2}
    assert got[1]["text"] is None and got[2]["text"] == ""
    assert list(redaction.names_below_roles({"orientador": ["A B"], "x": [{"Advisor1": "C D"}, 3]})) == ["A B", "C D"]
    with pytest.raises(NotImplementedError):
        redaction.RecognizerRedactor()(F.lit(""), F.array())


def test_leaders_follow_digest_key_and_bands(spark):
    base = " ".join(f"palavra{i}" for i in range(300))
    near = base.replace("palavra150", "outra")
    data = [(1, base, "k1"), (2, base.upper(), "k9"), (3, "texto bem diferente de todos", "k1"), (4, near, None), (5, "", "k1"), (6, None, ""), (7, "sozinho aqui", ""), (8, "texto bem diferente de todos", "k7")]
    df = spark.createDataFrame(data, "id long, text string, mk string")
    got = {r["id"]: (r["cluster_id"], r["level"]) for r in dedup.leader_clusters(df, "id", "text", "mk", "id").collect()}
    assert got == {1: (1, None), 2: (1, "digest"), 3: (1, "key"), 4: (1, "near"), 5: (5, None), 6: (6, None), 7: (7, None), 8: (1, "digest")}


def test_components_of_chains_stars_and_self_edges(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 150)] + [(500, 500), (600, None)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[k] == 100 for k in range(100, 150)) and got[500] == 500 and got[600] == 600


def test_search(spark):
    docs = spark.createDataFrame([(1, "gato preto gato"), (2, "gato branco"), (3, None), (4, "")], "id long, text string")
    asked = spark.createDataFrame([(9, "um gato preto"), (8, "nada aqui"), (7, None)], "q long, text string")
    hits = retrieval.bm25(docs, "id", "text", asked, "q", "text", top=2).orderBy("rank").collect()
    assert [(h["query"], h["key"]) for h in hits] == [(9, 1), (9, 2)]
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [2.0, 0.0])], "id long, v array<double>")
    got = retrieval.cosine_top(v, "id", "v", v.where("id = 1"), "id", "v", top=3).orderBy("rank").collect()
    assert [g["key"] for g in got] == [1, 6, 2]  # ties by key; zero, null and NaN match nothing
    both = retrieval.search("hybrid", lambda k: retrieval.bm25(docs, "id", "text", asked, "q", "text", top=k), lambda k: retrieval.bm25(docs, "id", "text", asked, "q", "text", top=k), top=1)
    assert [(r["query"], r["key"]) for r in both.collect()] == [(9, 1)]
    hits = spark.createDataFrame([(1, 1, "a", "T", "x" * 10), (1, 2, "b", None, "y" * 50), (1, 3, "c", "", "z")], "query long, rank int, key string, title string, text string")
    assert [r["snippet"] for r in retrieval.pack_context(hits, 30).orderBy("rank").collect()] == ["[a] T\n" + "x" * 10, "[b] \n" + "y" * 7]


def shuffled_records(spark):
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_search_by_words_shuffles_no_row_for_each_pair(spark):
    docs = spark.createDataFrame([(i, f"comum palavra{i % 7} outra{i % 11}") for i in range(500)], "id long, text string")
    asked = spark.createDataFrame([(i, f"comum pergunta{i} palavra{i % 7}") for i in range(200)], "q long, text string")
    before = shuffled_records(spark)
    found = retrieval.bm25(docs, "id", "text", asked, "q", "text", top=3).collect()
    assert len(found) == 600 and all(r["key"] == r["query"] % 7 + 7 * (r["rank"] - 1) for r in found)  # ties by key
    assert shuffled_records(spark) - before < 10_000  # of 100,000 pairs


@pytest.fixture(scope="module")
def asked_much(spark, tmp_path_factory):
    """1,500 texts that share a word, 200 of them asked by their titles: 300,000 pairs."""
    at = str(tmp_path_factory.mktemp("asked"))
    ids = [50 * i for i in range(200)] + [50 * i + 1 for i in range(1300)]
    spark.createDataFrame([(i, f"comum titulo{i}", f"comum palavra{i % 7} " + "x" * 3000) for i in ids], "doc_id long, title string, text string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, [1.0, float(i)]) for i in range(40)], "vec_id long, embedding array<float>").write.parquet(f"{at}/embeddings.parquet")
    return at


def test_contexts_shuffle_no_row_for_each_pair(spark, asked_much):
    before = shuffled_records(spark)
    found = curated_queries.context_pack(spark, asked_much).collect()
    assert len(found) == 200 * 6 and {r["rank"] for r in found} == {1, 2, 3, 4, 5, 6}
    assert shuffled_records(spark) - before < 60_000  # of 300,000 pairs


def test_fused_search_shuffles_no_row_for_each_pair(spark, asked_much):
    before = shuffled_records(spark)
    found = curated_queries.rrf_topk(spark, asked_much).collect()
    assert len(found) == 200 * 5
    assert shuffled_records(spark) - before < 60_000  # of 300,000 pairs


def test_search_by_words_counts_repeated_keys_together(spark, monkeypatch):
    texts = [(1, "Gáto gato, preto"), (1, "gato"), (2, "e\u0301le GATO azul azul"), (3, "preto_branco azul"), (None, "gato"), (None, "gato preto"), (4, "um de"), (5, None), (6, "azul \u0301 cao")]
    asked = [(1, "gato preto"), (2, "Preto gato!"), (3, "azul"), (3, "cão"), (None, "um azul"), (7, "nada"), (8, None)]
    cut = {"Gáto gato, preto": ["gato", "gato", "preto"], "gato": ["gato"], "e\u0301le GATO azul azul": ["gato", "azul", "azul"], "preto_branco azul": ["preto_branco", "azul"], "gato preto": ["gato", "preto"], "azul \u0301 cao": ["azul", "cao"]}
    rows_ = [(k, cut[t]) for k, t in texts if t in cut]  # "éle" is a stop word without its marks
    tf, df, average = {}, {}, sum(len(t) for _, t in rows_) / len(rows_)
    for k, t in rows_:
        for w in t:
            tf[k, w] = tf.get((k, w), 0) + 1
    for _, w in tf:
        df[w] = df.get(w, 0) + 1
    want = {}
    for q, ts in ((1, ["gato", "preto"]), (2, ["gato", "preto"]), (3, ["azul", "cao"]), (None, ["azul"])):
        for k, t in rows_:
            for w in ts:
                if k is not None and (n := tf.get((k, w))):
                    idf = math.log(1 + (len(rows_) - df[w] + 0.5) / (df[w] + 0.5))
                    want[q, k] = want.get((q, k), 0) + idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(t) / average))
    docs, questions = spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(asked, "q int, text string")
    for block, cells in ((100, 1 << 22), (2, 1)):
        monkeypatch.setattr(retrieval, "CELLS", cells)
        got = retrieval.bm25(docs, "id", "text", questions, "q", "text", block=block).collect()
        assert {(r["query"], r["key"]): r["score"] for r in got} == {k: round(v, 6) for k, v in want.items()}
        assert all(r["rank"] == 1 + sum(1 for o in got if o["query"] == r["query"] and (-o["score"], o["key"]) < (-r["score"], r["key"])) for r in got)


def test_vectors_of_a_model_are_checked(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string")
    assert retrieval.embed(df, "t", lambda x: [[1.0, 2.0]] * len(x)).count() == 2
    with pytest.raises(Exception, match="invalid vectors"):
        retrieval.embed(df, "t", lambda x: [[0.0]] * len(x)).collect()
    with pytest.raises(ValueError):
        retrieval.index_ready({"status": "building"}, "d", 2)


def test_plans_of_synchronisation(spark):
    local = spark.createDataFrame([("a", 1, "h1"), ("b", 2, "h2"), ("c", 2, "h2"), ("d", 3, None), ("e", 4, "h9")], "path string, size long, hash string")
    remote = spark.createDataFrame([("a", 1, "h1"), ("z", 4, "h9"), ("d", 3, "h7")], "path string, size long, hash string")
    assert rows(sync.drive_plan(local, remote)) == {("a", "skip", None), ("b", "upload", None), ("c", "duplicate", "b"), ("d", "skip", None), ("e", "duplicate", "z")}
    assert rows(sync.bucket_plan(local.limit(2), remote.select(F.col("path").alias("key"), "size"))) == {("a", "a", "skip"), ("b", "b", "upload")}


def test_states_and_rules(spark):
    old = spark.createDataFrame([("a", 1, 5), ("b", 1, 5)], "k string, v int, t int")
    new = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 4, 1)], "k string, v int, t int")
    assert rows(staging.upsert(old, new, "k", "t")) == {("a", 1, 5), ("b", 3, 2), ("c", 4, 1)}
    pages = spark.createDataFrame([(1, ["x", "y"]), (2, ["y", "x"]), (3, ["z"])], "page int, ids array<string>")
    assert rows(staging.repeated_pages(pages)) == {(1, False), (2, True), (3, False)}
    tried = spark.createDataFrame([(i, i % 2 == 0) for i in range(1, 30)], "n int, ok boolean")
    assert sorted(r["n"] for r in staging.until_successes(tried, "n", "ok", 3).collect()) == [1, 2, 3, 4, 5, 6]
    records = spark.createDataFrame([("a", "downloaded", None), ("b", "weird", None), (" ", "duplicate", None)], "bdtd_id string, status string, document struct<source_url string, sha256 string, byte_count long, pdf_valid boolean>")
    assert rows(validation.raw_issues(records)) == {("document", "a"), ("status", "b"), ("required", " ")}
    assert not validation.valid(validation.raw_issues(records)) and validation.describe({"counts": {"x": 2, "y": 0}}) == "2 x"
    paths = spark.createDataFrame([("/r/a",), ("/r/../b",), ("/s/c",)], "path string")
    assert rows(staging.prunable(paths, "/r")) == {("/r/a",)}
    report = staging.staging_report(spark.createDataFrame([("stale", "x")], "code string, id string"))
    assert report["ok"]


def test_documents_are_inspected(spark):
    records = spark.createDataFrame([("a", ("p1", "application/pdf", "00")), ("b", (None, "", "")), ("c", ("gone", "", "")), ("d", None)], "bdtd_id string, document struct<path string, content_type string, sha256 string>")
    files = spark.createDataFrame([("p1", bytearray(b"%PDF-x"))], "path string, content binary")
    assert rows(staging.inspect_documents(records, files)) == {("a", "application/pdf", False, True), ("b", "unknown", True, True), ("c", "unknown", False, False)}


def test_evaluation(spark):
    cases = spark.createDataFrame([("c1", "q1", [["r1", "r2"], ["r3"]]), ("c2", "q2", [])], "id string, question string, evidence_groups array<array<string>>")
    hits = spark.createDataFrame([("c1", "r2")], "id string, ref string")
    assert rows(evaluation.evidence_met(cases, hits)) == {("c1", False), ("c2", True)}
    runs = evaluation.case_runs(evaluation.select_cases(cases), ("raw_baseline", "words"))
    contexts = spark.createDataFrame([("c1", "words", 1, "ctx")], "id string, mode string, rank int, snippet string")
    sent = evaluation.messages(runs, contexts, "rules")
    assert sent.where("mode = 'raw_baseline' and system is not null").count() == 0
    got = evaluation.answer(sent, lambda system, user: {"answer": " ok " if "q1" in user else "", "done_reason": "stop"})
    summary = {r["mode"]: r for r in evaluation.mode_summary(got.withColumn("retrieval_seconds", F.lit(1.0))).collect()}
    assert summary["words"]["answered"] == 1 and summary["words"]["failed"] == 1
    with pytest.raises(ValueError):
        evaluation.select_cases(cases.unionAll(cases))
    assert evaluation.not_completed(2, 4, 9) == 0
    assert rows(evaluation.claim_scores(spark.createDataFrame([("a", "m", 1.0), ("a", "m", 0.5)], "id string, mode string, score double"))) == {("a", "m", 0.75, False)}


def test_data_card(spark):
    records = spark.createDataFrame([("a", "completed"), ("b", "filtered")], "bdtd_id string, status string")
    chunks = spark.createDataFrame([("a-0", "a", 10, "pt", " "), ("a-1", "a", None, "pt", "UF")], "chunk_id string, bdtd_id string, tokens int, language string, institution string")
    card = datasets.data_card(records, chunks, {"target_tokens": 1024})
    assert "- Chunks: 2" in card and "- desconhecido: 1" in card and "- Tokens a chunk: 5.0" in card
