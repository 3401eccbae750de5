"""Training of the models of scanned pages: ``python -m lavra.llm.scan_training DATA_DIR`` writes ``scan_models.json``.

Labelled lines and words are made from clean texts: they are wrapped and paged with running heads and page numbers of many
styles, words are broken at line ends, letters are confused; number tables, numbered sections, speaker marks and compounds that break at their own
hyphen are the counter-examples. A bounded sample of texts is used, and a fifth of what is made is held out.
"""

from __future__ import annotations

import json
import math
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from lavra.llm import scans as S
from lavra.llm.boosting import Boosted

SAMPLE_TEXTS, PAGED_TEXTS = 4_000, 1_300
# Invented headings of running heads; the rest is taken from the texts themselves.
HEADS = ("Programa de Estudos Avançados", "Tese apresentada ao curso", "Dissertação de Curso", "Cadernos de pesquisa em redes", "Proceedings of the local workshop", "Universidade do Vale", "Revista de estudos e dados")


def sentences_of(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.!?])\s+", " ".join(text.split())) if len(s) > 20]


def confuse(word: str, rng: random.Random) -> str:
    """One letter, or pair of letters, taken for another."""
    ways = [(m.start(), t, s) for t, s in S.CONFUSIONS[:21] for m in re.finditer(re.escape(t), word)]
    if not ways:
        return word
    at, t, s = rng.choice(ways)
    return word[:at] + s + word[at + len(t) :]


def noisy(line: str, rng: random.Random, share: float) -> str:
    return " ".join(confuse(w, rng) if len(w) > 3 and rng.random() < share else w for w in line.split(" "))


def roman(n: int) -> str:
    out = ""
    for value, sign in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (n // value)
        n %= value
    return out


def number_style(rng: random.Random):
    top = rng.randrange(60, 260)
    if rng.random() < 0.12:
        return lambda n: roman(n % 60 + 1)
    return rng.choice([lambda n: f"{n}", lambda n: f"- {n} -", lambda n: f"[{n}]", lambda n: f"p. {n}", lambda n: f"Página {n} de {top}", lambda n: f"{n}.", lambda n: f"– {n} –", lambda n: f"Page {n}", lambda n: f"pág. {n}"])


def heading(rng: random.Random, texts: list[str]) -> str:
    words = re.findall(r"[^\W\d_]+", rng.choice(texts))[:60]
    at = rng.randrange(max(1, len(words) - 8))
    phrase = " ".join(words[at : at + rng.randrange(3, 8)])
    told = rng.choice([phrase.upper(), phrase.upper(), phrase.capitalize(), phrase.capitalize() + ":", rng.choice(HEADS)])
    return f"{rng.choice([*HEADS, 'Capítulo 2', 'Anexo B'])} | {told}" if rng.random() < 0.25 else told


def words_list(text: str, rng: random.Random) -> str:
    """A line of key words."""
    words = rng.choices(re.findall(r"[^\W\d_]{4,}", text) or ["dados"], k=3)
    line = rng.choice(["Palavras-chave", "Keywords", "Palabras clave", "Mots-clés"]) + ": " + rng.choice(["; ", ", ", ". "]).join(words) + rng.choice(["", "."])
    return line.upper() if rng.random() < 0.2 else line


def made_page(text: str, texts: list[str], rng: random.Random) -> tuple[list[str], list[str], list[tuple[str, str, str, bool]]]:
    """(lines, their labels, broken words): a text wrapped, and paged or not."""
    paged, width = rng.random() < 0.65, rng.randrange(42, 92)
    sentences = sentences_of(text)[:60]
    spoken = rng.random() < 0.15  # a transcript: every part begins with who speaks
    if spoken or rng.random() < 0.15:
        paged, width = paged and not spoken, width if rng.random() < 0.4 else 10_000
    speakers = [rng.choice(re.findall(r"[^\W\d_]{5,}", text) or ["Pessoa"]).capitalize() + ":" for _ in range(2)]
    lines: list[str] = []
    labels: list[str] = []
    breaks: list[tuple[str, str, str, bool]] = []
    mark, breaking = rng.choice(["-", "-", "¬", "\xad", "‐"]), paged and rng.random() < 0.7
    share = rng.choice([0, 0, 0.03, 0.08]) if paged else 0

    def put(line: str, label: str = "text") -> None:
        lines.append(line)
        labels.append(label)

    at = 0
    while at < len(sentences):
        size = rng.randrange(2, 7)
        paragraph = " ".join(sentences[at : at + size])
        at += size
        r = rng.random()
        if spoken:
            put(rng.choice(speakers))
        elif r < 0.15:
            put(f"{rng.randrange(1, 20)}{rng.choice(['', '.', f'.{rng.randrange(1, 4)}'])} " + rng.choice([heading(rng, texts).upper(), "Resultados e discussão", "Introdução"]))
        elif r < 0.19:
            for _ in range(rng.randrange(4, 30)):
                put(rng.choice([f"{rng.randrange(2030)}", f"0.{rng.randrange(1000)}", f"{rng.randrange(99)},{rng.randrange(9)}", f"0.{rng.randrange(999)}\t{rng.randrange(999)}"]))
        elif r < 0.23:
            put(rng.choice(["P1:", "P2:", "Entrevistadora:", "Participante:", "Resumo", "RESUMO", "ABSTRACT", "RESUMEN", "Capítulo 2", "Anexo A", *[words_list(paragraph, rng)] * 4]))
        line = ""
        words = paragraph.split(" ")
        k = 0
        while k < len(words):
            w = words[k]
            if len(line) + len(w) + 1 <= width:
                line = f"{line} {w}".strip()
                k += 1
                continue
            plain, room = re.fullmatch(r"[^\W\d_]{5,}[.,;]?", w), width - len(line) - 2
            inner = w.find("-") + 1
            if inner and w[:inner].rstrip("-").isalpha() and inner <= room + 1 and rng.random() < 0.8:
                breaks.append((w[: inner - 1].lower(), re.match(r"[^\W\d_]*", w[inner:])[0].lower(), "-", False))
                put(f"{line} {w[:inner]}")
                words[k], line = w[inner:], ""
            elif breaking and plain and room >= 2:
                cut = rng.randrange(2, max(3, min(room + 1, len(w) - 2)))
                breaks.append((w[:cut].lower(), re.match(r"[^\W\d_]*", w[cut:])[0].lower(), mark, True))
                put(f"{line} {w[:cut]}{mark}".strip())
                words[k], line = w[cut:], ""
            else:
                put(line or w)
                k, line = (k, "") if line else (k + 1, "")
        if line:
            put(line)
        if not paged or rng.random() < 0.5:
            put("")
    if rng.random() < (0.15 if paged else 0.35):
        put(words_list(text, rng))
    elif rng.random() < 0.2 and len(lines[-1]) > 30:
        lines[-1] = lines[-1][: rng.randrange(12, len(lines[-1]))]
    if rng.random() < 0.1:
        lines, labels = [heading(rng, texts), "", *lines], ["text", "text", *labels]
    lines = [noisy(x, rng, share) for x in lines]
    if not paged:
        return lines, labels, breaks
    number, head = number_style(rng), heading(rng, texts)
    kind = rng.choice(["number", "head", "both", "joined", "both"])
    page, every, n = rng.randrange(1, 220), rng.randrange(8, 34), rng.randrange(3, 12)
    space = rng.random() < 0.35
    out, told = [], []
    for x, y in zip(lines, labels):
        out.append(x)
        told.append(y)
        n -= 1
        if n <= 0:
            n, page = every + rng.randrange(-2, 3), page + 1
            block = []
            if kind in ("number", "both"):
                block.append((number(page), "page_number"))
            if kind in ("head", "both") and rng.random() < 0.9:
                block.append((noisy(head, rng, share), "header"))
            if kind == "joined":
                block.append((rng.choice([f"{noisy(head, rng, share)}   {page}", f"{page}   {head}"]), "joined"))
            if rng.random() < 0.3:
                block.reverse()
            if space:
                block = [("", "text"), *block, ("", "text")]
            for b, label in block:
                out.append(b)
                told.append(label)
    return out, told, breaks


def held_out(name: str, x: np.ndarray, y: np.ndarray, **options) -> Boosted:
    cut = len(y) // 5
    model = Boosted.fit(x[cut:], y[cut:], **options)
    p = model.score(x[:cut]) > 0.5
    right = int((p & (y[:cut] == 1)).sum())
    print(name, x.shape, "held out: found", f"{right / max(1, int(y[:cut].sum())):.4f}", "right", f"{right / max(1, int(p.sum())):.4f}", flush=True)
    return model


def main(folder: str) -> None:
    rng = random.Random(3)
    every = [S.nfc(t) for t in pq.read_table(f"{folder}/documents.parquet", columns=["text"])["text"].to_pylist() if t]
    rng.shuffle(every)
    every = every[:SAMPLE_TEXTS]
    counts = S.count_words(every)
    total = sum(counts.values())
    least = max(3, math.ceil(S.USUAL * total))
    usual = {w: n / total for w, n in counts.items() if n >= least}
    clean = [t for t in every if len(t) > 600 and np.median([len(x) for x in t.split("\n") if x.strip()]) > 150]
    reader = S.Reader(usual, {})
    lines, marks, joins, broken = [], [], [], []
    for text in (clean * 3)[:PAGED_TEXTS]:
        made, labels, breaks = made_page(text, clean, rng)
        rows = [x.strip() for x in made]
        kept = [y for x, y in zip(rows, labels) if x]
        lines.append(S.line_features(rows))
        marks += kept
        for a, b, m, whole in breaks:
            if rng.random() < 0.1:
                a, b = (confuse(a, rng), b) if rng.random() < 0.5 else (a, confuse(b, rng))
            joins.append(S.join_features(a, b, m, reader.rate))
            broken.append(whole)
    x, marks_ = np.concatenate(lines), np.array(marks)
    models = {
        "header": held_out("header", x, np.isin(marks_, ["header", "joined"]).astype(float), trees=70, depth=5),
        "page_number": held_out("page_number", x, np.isin(marks_, ["page_number", "joined"]).astype(float), trees=60, depth=5),
        "hyphen": held_out("hyphen", np.array(joins, np.float64), np.array(broken, float), trees=40, depth=3),
    }
    # words: confused usual words with their candidates, and unusual words that are right with theirs
    grams = defaultdict(set)
    listed = [w for w, n in counts.items() if n >= least and 3 <= len(w) <= 24 and w.isalpha()]
    for w in listed:
        for i in range(len(w) + 1):
            grams[f"##{w}#"[i : i + 3]].add(w)
    rows, told = [], []

    def candidates(seen: str) -> list[tuple[str, int]]:
        met: Counter = Counter()
        for i in range(len(seen) + 1):
            met.update(grams.get(f"##{seen}#"[i : i + 3], ()))
        return [(w, k) for w, k in met.most_common(60) if k >= 2 and abs(len(w) - len(seen)) <= 3][:25]

    for w in rng.choices(listed, k=5_000):
        seen = confuse(w, rng)
        if seen == w or seen in usual:
            continue
        for c, k in candidates(seen):
            if S.alignment(seen, c)[1] <= 1:
                rows.append(S.word_features(seen, c, rng.choice([1, 1, 2, 3, 8]), counts[c], k))
                told.append(float(c == w))
    inflected = [w for w, n in counts.items() if n < least and w.isalpha() and len(w) >= 4 and not set(w) & set("0123456789†ﬁﬂ")]
    known = set(listed)
    for w in rng.sample(inflected, min(6_000, len(inflected))):
        if any(S.alignment(w, c) in ((1, 0), (2, 0)) for c, _ in candidates(w)):
            continue  # may be misread in the sample itself
        for c, k in candidates(w)[:8]:
            if S.alignment(w, c)[1] <= 1 and c in known:
                rows.append(S.word_features(w, c, counts[w], counts[c], k))
                told.append(0.0)
    for w in rng.choices(listed, k=800):  # accents that are missing are an encoding's fault
        if S.bare(w) != w:
            rows.append(S.word_features(S.bare(w), w, rng.choice([1, 3, 9]), counts[w], len(w)))
            told.append(0.0)
    order = np.random.default_rng(0).permutation(len(told))
    models["word"] = held_out("word", np.array(rows, np.float64)[order], np.array(told)[order], trees=60, depth=4)
    S.MODELS.write_text(json.dumps({k: m.to_json() for k, m in models.items()}, separators=(",", ":")) + "\n")


if __name__ == "__main__":
    main(sys.argv[1])
