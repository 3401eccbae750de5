"""Near duplicates, languages, pieces, tokens and containers against brute force and hostile input."""

import random
import re

import numpy as np
import pytest

from lavra.llm.bpe import encode_corpus
from lavra.llm.language import LanguageFilters, _Scorer, detect_languages, fit_filters
from lavra.llm.packing import pack_texts
from lavra.llm.similarity import all_pairs, duplicate_classes, near_duplicates, shingle_hashes
from lavra.llm.splitting import split_oversized
from lavra.session import durable


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(4000)}" for _ in range(120)] for _ in range(12)]
    rows = []
    for k in range(72):
        words = list(base[k % 12])
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            words[rng.randrange(len(words))] = "x"
        rows.append((k, " ".join(words)))
    rows += [(900, None), (901, ""), (902, "curto"), (None, rows[0][1])]
    links, members = near_duplicates(spark.createDataFrame(rows, "k long, t string").selectExpr("k", "t", "1 AS a", "2 AS digest"), "k", "t")
    got = {(r["a"], r["b"]) for r in all_pairs(links, members).collect()}
    sets = {k: set(shingle_hashes(t).tolist()) for k, t in rows[:72]}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}
    assert got == want and want
    classes = duplicate_classes(durable(links), members).collect()
    assert len(classes) == 72 and all(r["cluster_id"] <= r["key"] for r in classes)


def test_languages(spark):
    pt, en = "A biblioteca organiza o acervo com uma nova pesquisa e não perde os dados da coleção antiga. ", "The library keeps all of the old books and the new survey is made with the data of each reader. "
    rows = [(k, ("pt", "en")[k % 2], (pt, en)[k % 2] * 4) for k in range(40)] + [(50, None, pt * 3 + "\n\n" + en * 2), (51, "pt", None), (52, "pt", ""), (53, "en", "few words")]
    df = spark.createDataFrame(rows, "k long, lab string, t string")
    got = [r for r in detect_languages(df, "k", "t", fit_filters(df, "k", "lab", "t", languages=("pt", "en"))).collect()]
    assert {(r["segment_no"], r["lang_code"]) for r in got if r["k"] == 50} == {(0, "pt"), (1, "pt"), (2, "en")}
    assert not [r for r in got if r["k"] in (51, 52, 53)] and all(0 <= r["confidence"] <= 1 for r in got)


def test_a_scorer_starts_anew_instead_of_giving_up(monkeypatch):
    monkeypatch.setattr("lavra.llm.language.MEMORY_WORDS", 10)
    scorer = _Scorer(LanguageFilters.fit([("pt", "um dois três"), ("en", "one two three")]))
    scorer.rows([f"palavra{chr(97 + i)}" for i in range(20)])
    assert len(scorer.renewed()) == 0


def test_pieces_of_hostile_texts(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", " ", "\n", "\n\n", ". ", "palavra ", "x" * 50]) for _ in range(rng.randrange(1500, 4000))) for _ in range(20)]
    texts += ["".join(map(str, range(3000))), "", None, "z" * 4000]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    pieces: dict = {}
    for r in split_oversized(df, "k", "t", "document").collect():
        pieces.setdefault(int(r["item_key"]), []).append(r)
    assert set(pieces) == {k for k, t in enumerate(texts) if t and len(t) > 4000}
    for k, rows in pieces.items():
        rows = sorted(rows, key=lambda r: r["piece_no"] if "piece_no" in r.asDict() else r["pos"])
        column = next(c for c in rows[0].asDict() if c in ("text", "piece"))
        parts = [r[column] for r in rows]
        at = 0
        for n, p in enumerate(parts):
            again = [o for o in (range(100, 401) if n else [0]) if texts[k].startswith(p, at - o)]
            assert len(p) <= 4000 and again
            at += len(p) - again[0]
        assert at == len(texts[k])


def test_tokens_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers as P

    t = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = ["Olá, mundo! <|endoftext|> 123  \n\n tab\t", "日本語 e 😀 ção", "a" * 700, "", None, "  ", "x\r\ny"]
    got = {r["k"]: list(r["ids"]) for r in encode_corpus(spark.createDataFrame(list(enumerate(texts)), "k long, t string"), "k", "t").collect()}
    assert got == {k: t.encode(x, add_special_tokens=False).ids if x else [] for k, x in enumerate(texts)}


def test_containers_hold_everything_once(spark):
    rng = random.Random(1)
    texts = [" ".join("palavra" for _ in range(rng.randrange(1, 400))) for _ in range(120)] + ["", None, "um " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pack_texts(df, "doc_id", "text", 2048).collect()
    size, seen = {}, {}
    for r in rows:
        d = r.asDict()
        size[d["container"]] = size.get(d["container"], 0) + d["tokens"]
        seen.setdefault(d["doc_id"], []).append(d["tokens"])
    assert max(size.values()) <= 2048 and set(seen) == {k for k, t in enumerate(texts) if t}
    assert all(len(v) == 1 for k, v in seen.items() if k != 122) and len(size) <= np.ceil(sum(size.values()) / 2048) + 2
    assert re.match("um", texts[122])
