import random
from collections import Counter

import numpy as np

from lavra.llm import scans
from lavra.llm.scans import MODELS, Reader, alignment, count_words, line_features, models, repair_scans, scan_noise

WORDS = "nossa biblioteca municipal organiza cada acervo digital segundo critérios de qualidade durante a coleta dos dados outra pesquisa compara este método pós-doutoral".split()


def clean(seed, n=120):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        s = [rng.choice(WORDS) for _ in range(rng.randrange(7, 13))]
        out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
    return out


def scanned(seed):
    words, lines, line, page = clean(seed), [], "", 40
    for k, w in enumerate(words):
        if k in (30, 60):
            w = w.replace("a", "ä").replace("e", "c") if len(w) > 4 else "0utra"
        if len(line) + len(w) > 48:
            if w.isalpha() and len(w) > 6:
                lines.append(f"{line} {w[:4]}-")
                line = w[4:]
            else:
                lines.append(line)
                line = w
            if len(lines) % 9 == 0:
                page += 1
                lines += [f"- {page} -", "ACERVO DIGITAL E PESQUISA MUNICIPAL"]
        else:
            line = f"{line} {w}".strip()
    return "\n".join([*lines, line])


def test_alignment_knows_confusions():
    assert alignment("0utra", "outra") == (1, 0) and alignment("forrna", "forma") == (1, 0) and alignment("cllgital", "digital") == (2, 0) and alignment("xigital", "digital") == (0, 1)
    assert alignment("casa", "casa") == (0, 0)


def test_models_and_features():
    assert MODELS.stat().st_size < 300_000 and set(models()) == {"header", "page_number", "hyphen", "word"}
    assert line_features(["a b", "", "12"]).shape == (2, 24)


def test_noise_is_found_and_repaired(spark):
    rows = [(k, " ".join(clean(k, 400))) for k in range(30)] + [(100, scanned(5)), (101, None), (102, ""), (103, "\n".join(str(n * 37 % 900) for n in range(60))), (104, "Título")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' AS word", "1 AS key")
    kinds, _ = scan_noise(df, "doc_id", "text")
    got = {(r["doc_id"], r["noise_kind"]) for r in kinds.collect()}
    assert {k for d, k in got if d == 100} == {"hyphen", "header", "page_number", "misread"} and {d for d, _ in got} == {100}
    texts = {r["doc_id"]: r["text"] for r in repair_scans(df, "doc_id", "text").collect()}
    assert texts[0] == rows[0][1] and texts[101] is None and texts[102] == "" and len(texts) == len(rows)
    assert "- 4" not in texts[100] and "ACERVO" not in texts[100] and "-\n" not in texts[100] and "0utra" not in texts[100]
    assert scan_noise(df.limit(0), "doc_id", "text")[0].count() == 0


def test_compounds_keep_their_hyphen():
    reader = Reader({"pós-doutoral": 1e-3, "digital": 1e-3}, models())
    rows = ["uma linha de texto que vem antes desta", "nossa pesquisa pós-", "doutoral e um acervo digi-", "tal de muitos dados que existem", "e mais uma linha de texto aqui"]
    found, _ = reader.read("\n".join(rows))
    assert [(a, b) for _, _, a, b, _ in found["hyphen"]] == [("digi", "tal")]


class Counting:
    """Stands for something and notes how much it is asked for."""

    def __init__(self, real):
        self.real, self.asked = real, 0

    def __getattr__(self, name):
        return getattr(self.real, name)

    def findall(self, text):
        self.asked += len(text)
        return self.real.findall(text)

    def score(self, x):
        self.asked += len(x)
        return self.real.score(x)


def odd(seed):
    rng = random.Random(seed)
    return "".join(rng.choice("abcÉÃÂ€â¿\x80 \n\n-¬\xad‐†'’ﬁ01.ǅΣ𝐀\x0c\t\x1c") for _ in range(rng.randrange(120)))


def test_words_are_counted_as_they_stand_and_each_piece_is_read_once(monkeypatch):
    token, texts = Counting(scans._TOKEN), [odd(k) for k in range(300)] + ["o pós-doutoral, 0utra casa† de digi-\ntal N\u00c3O"] * 200
    want = Counter(w for t in texts if not scans._MOJIBAKE.search(t) for w in scans.words_of(scans._HALVES.sub(" ", t)) if len(w) <= 30 and not w.isdigit())
    monkeypatch.setattr(scans, "_TOKEN", token)
    assert count_words(texts) == want
    assert token.asked < len("".join(texts[:300])) + 60
    assert [scans.wrongly_decoded(t) for t in texts] == [bool(scans._MOJIBAKE.search(t)) for t in texts]


def test_lines_that_cannot_be_page_numbers_are_not_classified():
    page, trained = Counting(models()["page_number"]), models()
    x = np.random.default_rng(3).normal(0, 30, (2000, 24))
    x[:, [2, 6]] = 0
    assert page.score(x).max() <= 1 / (1 + np.exp(-page.most({2: 0, 6: 0}))) < 0.5 and page.most({}) > 0
    page.asked = 0
    reader = Reader({"acervo": 1e-3}, trained | {"page_number": page})
    assert not reader.bare_pages
    lines = scanned(5).split("\n")
    plain = [r for r in lines if not any(c.isdigit() for c in r)]
    assert not reader.read("\n".join(plain))[0]["page_number"] and page.asked == 0
    numbers = [i for i, r in enumerate(lines) if r.startswith("- ")]
    assert reader.read("\n".join(lines))[0]["page_number"] == numbers and len(numbers) <= page.asked < len(lines) / 2
