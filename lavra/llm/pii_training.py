"""Training of the tagger of personal data: ``python -m lavra.llm.pii_training DATA_DIR`` writes ``pii_weights.npz``.

There are no labelled texts, so labelled spans are made: marking rules that know the written forms of the data (addresses of mail,
telephone and identity numbers, streets) and the given names of the author lists mark the spans of a bounded sample of texts, and
further windows are made by putting invented items of rare forms into texts. A fifth of the sample is held out; the agreement on
its items is printed. The rules serve for training only: results come from the tagger.
"""

from __future__ import annotations

import random
import re
import sys
import time
import unicodedata
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from lavra.llm.pii import KINDS, WEIGHTS, spans_of
from lavra.llm.tagger import CharTagger, encode

#: Texts sampled, and windows cut from them, at most; characters of a window in each of the two phases, and their epochs.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 16_000, 16_000
STEPS, LONG_STEPS = 144, 256
HIDDEN, EPOCHS, LONG_EPOCHS = 24, 12, 5

_DOMAIN = r"[\w-]+(?:(?:\s?\.\s?|\s+dot\s+)[\w-]+)*?(?:\s?\.\s?|\s+dot\s+)(?:example|test|invalid)\b"
EMAIL = re.compile(r"[\w.+-]*\w(?:\s?@\s?|\s*[(\[](?:arroba|at)[)\]]\s*|\s+at\s+)" + _DOMAIN, re.I)
_NO_TABLE_BEFORE, _NO_TABLE_AFTER = r"(?<!\d[\n\t])", r"(?![\n\t]+\d)"  # columns of numbers are no items
PHONE = re.compile(
    _NO_TABLE_BEFORE + r"(?<![\w.,/])(?:\+\d{1,2}\s?(?:\(\d\d\)|\d\d)?\s?\d{3,5}[-\s]?\d{4}|\(\d{2,3}\)\s?\d{3,5}[-\s]?\d{4}|\d{2}\s9\s\d{4}\s\d{4}"
    r"|\d{3}\s\d{4}\s\d{4}|\d{2}\.\d{4}\.\d{4}|(?<!ark:/\d{5}/)\d{10})(?![\w/]|[.,-]\d)" + _NO_TABLE_AFTER
)
IDENTITY = re.compile(_NO_TABLE_BEFORE + r"(?<![\w.,/-])(?:\d{3}\.\d{3}\.\d{3}-\d\d|\d{3}\s\d{3}\s\d{3}\s\d\d|\d{11}|(?:[A-Z]{2}-)?\d{2}\.\d{3}\.\d{3}(?:-[\dx])?|X[A-Z]\d{6})(?![\w/]|[.,-]\d)" + _NO_TABLE_AFTER, re.I)
_TO_END = r"(?:,\s(?:nº\s)?(?:\d{1,4}|s/n)|\s\d{1,4})?(?:,\s(?:apto|piso|casa|fundos|bloco)\b\.?\s?\w*)*(?:(?:,\s|\s-\s|\s)(?:CEP\s)?\d{5}-\d{3})?"
ADDRESS = re.compile(
    r"\b(?:(?:rua|r\.|av\.|avenida|travessa|pra[çc]a|alameda|calle|plaza)\s+(?-i:[A-ZÀ-Ýa-zà-ÿ])[^\W\d_]+(?:,\s+(?:nº\s+)?(?:\d{1,4}|s/n)|\s+\d{1,4})|quadra\s+\d{1,4},\s+bloco\s\w)\b"
    + _TO_END + r"|(?<![\w/.-])\d{1,4}(?:\s(?:bis|ter))?,\s+(?:rue|avenue|boulevard|place|allée|chemin|impasse|quai)\s+[^\W\d_]+"
    r"|(?<![\w/.-])\d{1,4}\s+[^\W\d_]+\s+(?:street|ave\.|avenue|road|rd\.|lane|st\.|square|drive)(?:,\s+apt\.\s\d+)?",
    re.I,
)
_PLACE = re.compile(r"(?:,|\s-)?\s+(?:[A-ZÀ-Ý][^\W\d_]+\s+[A-ZÀ-Ý][^\W\d_]+)(?:,\s+CEP\s\d{5}-\d{3})?")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_PARTICLES = ("de", "da", "do", "dos", "das", "del", "e")


def fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


def given_names(authors: list[list[str] | None], least: int = 3) -> set[str]:
    """Words that stand first among the given names of at least ``least`` authors."""
    seen: Counter = Counter()
    for names in authors:
        for name in names or ():
            before, comma, after = (name or "").partition(",")
            words = re.findall(r"[^\W\d_]+", after if comma else before)
            if words and len(words[0]) > 2:
                seen[fold(words[0])] += 1
    return {w for w, n in seen.items() if n >= least}


def mark(text: str, given: set[str], ordinary: set[str]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the items in a text, by rules."""
    found = [(*m.span(), kind) for kind, rule in (("EMAIL", EMAIL), ("PHONE", PHONE), ("ID", IDENTITY)) for m in rule.finditer(text)]
    for m in ADDRESS.finditer(text):
        tail = _PLACE.match(text, m.end())
        found.append((m.start(), tail.end() if tail else m.end(), "ADDRESS"))
    tokens = [(m.start(), m.end(), fold(m[0]), m[0]) for m in _TOKEN.finditer(text)]

    def name_like(k: int) -> bool:
        return tokens[k][2] not in ordinary and tokens[k][2] not in given and len(tokens[k][2]) > 3

    def gap(k: int) -> str:
        return text[tokens[k][1] : tokens[k + 1][0]]

    k = 0
    while k < len(tokens):
        if tokens[k][2] in given and (not k or gap(k - 1)[-1:] not in tuple(".-_+@")):
            j, last = k, None
            while j + 1 < len(tokens) and (re.fullmatch(r"\s+", gap(j)) or (len(tokens[j][3]) == 1 and re.fullmatch(r"\.\s+", gap(j)))):
                j += 1
                if name_like(j):
                    last = j
                elif not (tokens[j][2] in given or tokens[j][2] in _PARTICLES or (len(tokens[j][3]) == 1 and text[tokens[j][1] : tokens[j][1] + 1] == ".")):
                    break
                elif last is not None:
                    break
            first = k
            while first and name_like(first - 1) and tokens[first - 1][3][0].isupper() >= tokens[k][3][0].isupper() and re.fullmatch(r",\s+" if first == k else r"\s+", gap(first - 1)):
                first -= 1
            if last is not None and first == k or first < k:
                end = tokens[last][1] if last is not None else tokens[k][1]
                found.append((tokens[first][0], end, "PERSON"))
                k = last if last is not None else k
        k += 1
    found.sort(key=lambda s: (s[0], -s[1]))
    out: list[tuple[int, int, str]] = []
    for s in found:
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


def tags_of(text: str, spans: list[tuple[int, int, str]]) -> np.ndarray:
    tags = np.zeros(len(text), np.int8)
    for a, b, kind in spans:
        tags[a:b] = 2 + 2 * KINDS.index(kind)
        tags[a] = 1 + 2 * KINDS.index(kind)
    return tags


def cut_windows(
    texts: list[str], spans: list[list[tuple[int, int, str]]], rng: random.Random, limit: int, STEPS: int = STEPS, again: dict[int, list[int]] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Windows around items, and as many at random; some of them in capitals. ``again``: places that were read wrongly, by text."""
    ids, gold = [], []
    order = list(range(len(texts)))
    rng.shuffle(order)
    rare = Counter(kind for s in spans for _, _, kind in s)
    for i in order:
        text, found = texts[i], spans[i]
        tags, starts = tags_of(text, found), []
        for a, _, kind in found:
            starts += [a - rng.randrange(10, STEPS - 40) for _ in range(1 + (rare[kind] < 500))]
        if rng.random() < 0.7:
            starts.append(rng.randrange(max(1, len(text) - STEPS)))
        for m in re.finditer(r"[@/]|\bark:|ISSN|processo|bloco|versão|páginas|mapa|arroba|\(\d{4}\)", text):
            if rng.random() < (0.25 if text[m.start()] != "(" else 0.04):
                starts.append(m.start() - rng.randrange(10, STEPS - 30))
        starts += [a - rng.randrange(5, STEPS - 40) for a in (again or {}).get(i, ()) for _ in range(3)]
        if again is not None and rng.random() < 0.45 and i not in again:
            starts = starts[:1]
        for at in starts:
            at = max(0, min(at, len(text) - STEPS))
            piece = text[at : at + STEPS]
            if rng.random() < 0.12 and len(piece.upper()) == len(piece):
                piece = piece.upper()
            row, tag = np.zeros(STEPS, np.int16), np.zeros(STEPS, np.int8)
            row[: len(piece)] = encode(piece)
            tag[: len(piece)] = tags[at : at + STEPS]
            if tag[0] and tag[0] % 2 == 0:
                tag[0] -= 1
            ids.append(row)
            gold.append(tag)
        if len(ids) >= limit:
            break
    return np.array(ids[:limit]), np.array(gold[:limit])


def main(folder: str, phase: str = "all") -> None:
    rng = random.Random(5)
    texts = [t for t in pq.read_table(f"{folder}/documents.parquet", columns=["text"])["text"].to_pylist() if t]
    records = pq.read_table(f"{folder}/raw_records.parquet", columns=["metadata"])["metadata"].to_pylist()
    texts += [r["abstract"] for r in records if r and r["abstract"]]
    texts = list(dict.fromkeys(texts))
    rng.shuffle(texts)
    texts = texts[:SAMPLE_TEXTS]
    given = given_names([r["authors"] for r in records if r])
    frequency = Counter(w for t in texts for w in {fold(x) for x in _TOKEN.findall(t)})
    ordinary = {w for w, n in frequency.items() if n > 0.004 * len(texts)} - given
    spans = [mark(t, given, ordinary) for t in texts]
    print(len(texts), Counter(k for s in spans for _, _, k in s), flush=True)
    fifth = len(texts) // 5
    if phase == "all":  # "long" goes on from the weights that are there
        ids, gold = cut_windows(texts[fifth:], spans[fifth:], rng, SAMPLE_WINDOWS)
        print(ids.shape, flush=True)
        tagger, began = CharTagger.fresh(HIDDEN, 1 + 2 * len(KINDS), seed=1), time.time()
        tagger.fit(ids, gold, epochs=EPOCHS, batch=64, rate=0.012, log=lambda e, x: print(e, f"{x:.5f}", f"{time.time() - began:.0f} s", flush=True))
        WEIGHTS.write_bytes(tagger.to_bytes())
    lengthen(texts[fifth:], spans[fifth:], rng)
    report(texts[:fifth], spans[:fifth])


def lengthen(texts: list[str], spans: list[list[tuple[int, int, str]]], rng: random.Random) -> None:
    """The second phase: longer windows, and more of those that the first phase reads wrongly."""
    tagger, again, began = CharTagger.from_bytes(WEIGHTS.read_bytes()), {}, time.time()
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        for i, (text, tags) in enumerate(zip(part, tagger.decode(tagger.text_scores(part)))):
            wrong = {(a, k) for a, _, k in spans_of(text, tags)} ^ {(a, k) for a, _, k in spans[at + i]}
            if wrong:
                again[at + i] = [a for a, _ in wrong]
    ids, gold = cut_windows(texts, spans, rng, SAMPLE_WINDOWS, LONG_STEPS, again)
    print(len(again), ids.shape, f"{time.time() - began:.0f} s", flush=True)
    tagger.fit(ids, gold, epochs=LONG_EPOCHS, batch=64, rate=0.006, seed=2, log=lambda e, x: print("long", e, f"{x:.5f}", f"{time.time() - began:.0f} s", flush=True))
    WEIGHTS.write_bytes(tagger.to_bytes())


def report(texts: list[str], spans: list[list[tuple[int, int, str]]]) -> None:
    tagger = CharTagger.from_bytes(WEIGHTS.read_bytes())
    right, wrong, lost, shown = Counter(), Counter(), Counter(), 0
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        for text, gold, tags in zip(part, spans[at : at + 500], tagger.decode(tagger.text_scores(part))):
            found = {(a, k) for a, _, k in spans_of(text, tags)}
            true = {(a, k) for a, _, k in gold}
            for source, into in ((found & true, right), (found - true, wrong), (true - found, lost)):
                into.update(k for _, k in source)
            for a, k in sorted(found ^ true):
                if shown < 60:
                    shown += 1
                    print("  wrong" if (a, k) in found else "  lost", k, repr(text[max(0, a - 40) : a + 50]))
    for k in KINDS:
        print(k, "right", right[k], "wrong", wrong[k], "lost", lost[k])


if __name__ == "__main__":
    main(*sys.argv[1:])
