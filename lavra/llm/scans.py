"""Noise of scanned pages: broken words, running heads, page numbers and misread characters are found and repaired.

Misread words: a corpus vocabulary gives the usual words; unusual ones retrieve candidates through an inverted join on
character q-grams, and gradient-boosted trees rank the candidates by how the letters are confused and how frequent the words are.
Lines: boosted classifiers look at every line with its neighbours and tell running heads and page numbers from text, and at every
pair of lines with a mark at the end of the first and tell broken words from compounds that broke at their own hyphen.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.boosting import Boosted
from lavra.session import durable

#: A word is usual if it is at least this share of all words; so at most 1 / USUAL words are usual, whatever the corpus.
USUAL = 1e-5
#: What is read at most so often as its replacement (a share) can be a misreading.
RARITY = 0.05
MODELS = Path(__file__).with_name("scan_models.json")
# What letters are taken for.
CONFUSIONS = (
    ("o", "0"), ("l", "1"), ("i", "1"), ("s", "5"), ("g", "9"), ("b", "6"), ("z", "2"), ("t", "†"), ("e", "c"), ("i", "í"), ("a", "ä"), ("o", "ö"), ("u", "ü"), ("m", "rn"), ("d", "cl"),
    ("h", "li"), ("u", "ii"), ("w", "vv"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("n", "ri"), ("i", "l"), ("l", "i"), ("c", "e"), ("rn", "m"), ("q", "g"),
)
_SEEN: dict[str, tuple[str, ...]] = {}
for _true, _seen in CONFUSIONS:
    _SEEN[_seen] = (*_SEEN.get(_seen, ()), _true)
BREAK = "-¬\xad‐"
_MOJIBAKE = re.compile("Ã[\x80-¿]|Â[\x80-¿]|â€|ï¿½")
_TOKEN = re.compile(r"[^\W_]++(?:[†'’‐-]++[^\W_]++)*+†*+|†++[^\W_]++(?:[†'’-]++[^\W_]++)*+")
_HALVES = re.compile(rf"(?<![^\W\d_])[^\W\d_]++[{BREAK}]\s*\n\s*[^\W\d_]+")
_LINE_END = re.compile(rf"[{BREAK}]\s*\n")
_DIGITS = re.compile(r"\d+")
#: Lines above this length are no running heads.
LONG_LINE = 150
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?: [^\W\d_]){3,}(?![^\W_])")
_APART = re.compile(r" [^\W\d_] [^\W\d_] ")
_NUMBER = re.compile(r"^\W{0,3}(?:(?:p|pp|pág|pag|página|page|pagina|página|f|fl)\b\.?\s*)?(?:\d{1,4}|[ivxlc]{1,6})(?:\s*(?:de|of|/|sur)\s*\d{1,4})?\W{0,3}$", re.I)
_TAIL_NUMBER = re.compile(r"\S\s{2,}\d{1,4}$|^\d{1,4}\s{2,}\S")
_SECTION = re.compile(r"^\d{1,2}(?:\.\d{1,2})*\.?\s+[^\W\d_]")


def nfc(text: str) -> str:
    return unicodedata.normalize("NFC", text) if not text.isascii() else text


def bare(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def words_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def wrongly_decoded(text: str) -> bool:
    return not text.isascii() and ("â€" in text or "ï¿½" in text or ("Ã" in text or "Â" in text) and bool(_MOJIBAKE.search(text)))


def spaced_out(text: str) -> bool:
    """Whether letters with blanks between them stand in a text."""
    return bool(_APART.search(text)) and bool(_SPACED.search(text))


def count_words(texts: list[str]) -> Counter:
    """The words that stand inside the lines of texts, without those of wrongly decoded texts.

    No word goes over a blank, so what stands between blanks is counted first, and each of it is read once."""
    pieces: Counter = Counter()
    for t in texts:
        if not wrongly_decoded(t):
            pieces.update((_HALVES.sub(" ", t) if _LINE_END.search(t) else t).lower().split())
    counts: Counter = Counter()
    for p, n in pieces.items():
        for w in (p,) if p.isalnum() else _TOKEN.findall(p):
            counts[w] += n
    return Counter({w: n for w, n in counts.items() if len(w) <= 30 and not w.isdigit()})


# words: how a misreading and a replacement fit


@lru_cache(maxsize=200_000)
def alignment(seen: str, true: str) -> tuple[int, int]:
    """(confusions, other edits) of the cheapest way from the true word to the seen one; another edit costs three confusions."""
    n, m = len(seen), len(true)
    inf = (99, 99)
    cost = [[inf] * (m + 1) for _ in range(n + 1)]
    cost[0][0] = (0, 0)
    key = lambda c: c[0] + 3 * c[1]
    for i in range(n + 1):
        for j in range(m + 1):
            if cost[i][j][1] > 2:
                continue
            a, b = cost[i][j]
            steps = []
            if i < n and j < m:
                steps.append((1, 1, (a, b) if seen[i] == true[j] else (a, b + 1)))
            if i < n:
                steps.append((1, 0, (a, b + 1)))
            if j < m:
                steps.append((0, 1, (a, b + 1)))
            for k in (1, 2):
                for t in _SEEN.get(seen[i : i + k], ()) if i + k <= n else ():
                    if true.startswith(t, j):
                        steps.append((k, len(t), (a + 1, b)))
            for di, dj, c in steps:
                if key(c) < key(cost[i + di][j + dj]):
                    cost[i + di][j + dj] = c
    return cost[n][m]


def word_features(seen: str, true: str, n_seen: int, n_true: int, shared: int) -> list[float]:
    conf, other = alignment(seen, true)
    odd = sum(c.isdigit() or c in "†ﬁﬂ" for c in seen)
    accents = float(bare(seen) == bare(true) and len(bare(seen)) == len(seen) and seen == bare(seen))  # accents lost, no letter
    return [conf, other, math.log((n_true + 1) / (n_seen + 1)), len(true), odd, accents, shared / (len(true) + 2), float(seen[0] == true[0]), float(bare(seen) == bare(true)), conf / len(true)]


# lines: features of a line among its neighbours


def _frame(line: str) -> str:
    return _DIGITS.sub("9", line.lower()) if len(line) <= LONG_LINE else line


def _tail_number(line: str) -> bool:
    return len(line) <= LONG_LINE and (line[-1:].isdigit() or line[:1].isdigit()) and bool(_TAIL_NUMBER.search(line))


@lru_cache(maxsize=1)
def _cases() -> np.ndarray:
    """For each code point of the basic plane whether it is a letter and whether it is upper case."""
    return np.array([[c.isalpha(), c.isupper()] for c in map(chr, range(0x10000))], np.int32)


def _letters(lines: list[str]) -> list[list[int]]:
    """(letters, upper-case ones) of each line; lines are not empty."""
    joined = "".join(lines)
    if not joined:
        return []
    if max(joined) > "\uffff":
        return [[sum(map(str.isalpha, r)), sum(map(str.isupper, r))] for r in lines]
    points = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    return np.add.reduceat(_cases()[points], np.cumsum(sizes) - sizes).tolist()


def line_features(rows: list[str]) -> np.ndarray:
    """One row of features for each line that is not blank; ``rows`` are stripped lines, blank ones as ''."""
    full = [i for i, r in enumerate(rows) if r]
    lengths = [len(rows[i]) for i in full]
    typical = float(np.median(lengths)) if lengths else 1.0
    framed = {i: _frame(rows[i]) for i in full}
    frames = Counter(framed.values())
    number = {i: len(rows[i]) < 30 and bool(_NUMBER.match(rows[i])) for i in full}
    values: dict[int, int] = {}
    for i in full:
        if number[i] or _tail_number(rows[i]):
            digits = re.findall(r"\d+", rows[i])
            if digits:
                values[i] = int(digits[0] if number[i] or rows[i][0].isdigit() else digits[-1])
    seen_values = set(values.values())
    cased = iter(_letters([rows[i] for i in full if len(rows[i]) <= LONG_LINE]))
    numbers_to = list(accumulate((number[i] for i in full), initial=0))
    out = []
    for k, i in enumerate(full):
        r = rows[i]
        before = rows[full[k - 1]] if k else ""
        after = rows[full[k + 1]] if k + 1 < len(full) else ""
        far = rows[full[k - 2]] if k > 1 else ""
        beyond = rows[full[k + 2]] if k + 2 < len(full) else ""
        b_furniture = bool(before) and (number[full[k - 1]] or full[k - 1] in values)
        a_furniture = bool(after) and (number[full[k + 1]] or full[k + 1] in values)
        text_before = far if b_furniture else before
        text_after = beyond if a_furniture else after
        short = len(r) <= LONG_LINE
        letters, upper = next(cased) if short else (len(r), 0)
        value = values.get(i)
        out.append((
            len(r.split()), len(r) / max(1.0, typical), number[i], r[:1] in "[(-–—", r[:1].isdigit(), r[-1:] in "].)-–—", _tail_number(r),
            bool(text_before) and text_before[-1:] not in ".!?:…”\")]", text_after[:1].islower(), text_before[-1:] in BREAK and bool(text_before),
            value is not None and ((value + 1) in seen_values or (value - 1) in seen_values), b_furniture, a_furniture,
            upper / max(1, letters), r[:1].isupper(), r[-1:] in ".!?;,", frames[framed[i]] - 1, bool(_SECTION.match(r)), typical,
            i > 0 and not rows[i - 1], i + 1 < len(rows) and not rows[i + 1], numbers_to[min(len(full), k + 4)] - numbers_to[max(0, k - 3)] - number[i], r[:1].islower(), letters / max(1, len(r)),
        ))
    return np.array(out, np.float32).reshape(len(out), 24)


def join_features(left: str, right: str, mark: str, rate) -> list[float]:
    """Features of a word that a line's end has broken into ``left`` and ``right``; ``rate`` gives the log share of a word, 0 if unusual."""
    whole, compound = left + right, f"{left}-{right}"
    return [rate(whole), rate(compound), rate(left), rate(right), mark != "-", len(left), len(right), right[:1].islower(), rate(left + right[:1]) and 1.0]


def _broken(rows: list[str]) -> Iterator[tuple[int, int, str, str, str]]:
    """(line, next line with text, left part, right part, mark) for lines that end in a mark after a letter."""
    for i, r in enumerate(rows):
        if len(r) > 2 and r[-1] in BREAK and r[-2].isalpha():
            j = i + 1
            while j < len(rows) and j <= i + 6 and (not rows[j] or _NUMBER.match(rows[j]) or _tail_number(rows[j]) or not rows[j][:1].isalpha() or not rows[j][:1].islower()):
                j += 1
            if j < len(rows) and j <= i + 6:
                left = re.search(r"[^\W\d_]+(?:-[^\W\d_]+)*$", r[:-1])
                right = re.match(r"[^\W\d_]+", rows[j])
                if left and right:
                    yield i, j, left[0].lower(), right[0].lower(), r[-1]


class _Unusual(dict):
    """The unusual words of what stands between two blanks, remembered for at most ``MOST`` of it."""

    MOST = 200_000

    def __init__(self, usual: dict[str, float]):
        super().__init__()
        self.usual = usual

    def __missing__(self, piece: str) -> tuple[str, ...]:
        if len(self) >= self.MOST:
            self.clear()
        words = () if piece in self.usual else tuple(w for w in words_of(piece) if w not in self.usual and self.looked_at(w))
        self[piece] = words
        return words

    def looked_at(self, w: str) -> bool:
        if len(w) < 3 or len(w) > 30 or w.isdigit():
            return False
        return not (sum(map(str.isalpha, w)) * 2 < len(w) or "-" in w and all(self.usual.get(p) for p in w.split("-")))


class Reader:
    """What is known of lines and words: the usual words with their shares, and the three classifiers."""

    def __init__(self, usual: dict[str, float], models: dict[str, Boosted]):
        self.usual, self.models, self.unusual = usual, models, _Unusual(usual)
        #: Lines that are no number and have none beside them need not be looked at where no other feature could make up for that.
        self.bare_pages = models["page_number"].most({2: 0, 6: 0}) > 0

    def rate(self, word: str) -> float:
        share = self.usual.get(word)
        return 0.0 if share is None else 12 + math.log(share)

    def read(self, text: str) -> tuple[dict[str, list], list[str]]:
        return self.read_all([text])[0]

    def read_all(self, texts: list[str]) -> list[tuple[dict[str, list], list[str]]]:
        """For each text what its lines hold (``hyphen``, ``header``, ``page_number``, ``spaced``), and its unusual words. The lines of
        all texts are classified together."""
        split = [[r.strip(" \t\r") for r in re.split(r"\n|\x0c", t)] for t in texts]
        features = [line_features(rows) if sum(map(bool, rows)) >= 4 else np.zeros((0, 24), np.float32) for rows in split]
        ends = np.cumsum([0, *map(len, features)])
        x = np.concatenate(features) if features else np.zeros((0, 24), np.float32)
        short = np.array([len(r) <= LONG_LINE for rows, f in zip(split, features) if len(f) for r in rows if r], bool)
        # a running head stands again in the text or between two halves of a sentence, or beside or with a page number; numbered
        # headings of sections are none
        strong = (x[:, 16] > 0) | ((x[:, 7] > 0) & (x[:, 8] > 0))
        beside = (x[:, 11] > 0) | (x[:, 12] > 0) | (x[:, 6] > 0)
        asked = {
            "header": np.flatnonzero(short & (strong | beside) & ((x[:, 17] == 0) | (x[:, 6] > 0))),
            "page_number": np.flatnonzero(short & ((x[:, 2] > 0) | (x[:, 6] > 0) | self.bare_pages)),
        }
        heads, numbers = np.zeros(len(x)), np.zeros(len(x))
        for k, scores in (("header", heads), ("page_number", numbers)):
            scores[asked[k]] = self.models[k].score(x[asked[k]])
        heads, numbers = ((heads > 0.3) & strong) | ((heads > 0.5) & beside), numbers > 0.5
        breaks = [list(_broken(rows)) for rows in split]
        flat = [join_features(a, b, m, self.rate) for found in breaks for _, _, a, b, m in found]
        joined = iter(self.models["hyphen"].score(np.array(flat, np.float64).reshape(len(flat), 9)) > 0.5)
        out = []
        for k, (text, rows) in enumerate(zip(texts, split)):
            full = np.array([i for i, r in enumerate(rows) if r], np.int64)[: ends[k + 1] - ends[k]]
            mine = slice(ends[k], ends[k + 1])
            found: dict[str, list] = {
                "hyphen": [b for b in breaks[k] if next(joined)],
                "header": full[heads[mine]].tolist(),
                "page_number": full[numbers[mine]].tolist(),
                "spaced": [],
            }
            out.append((found, self._words(text, rows, found, breaks[k])))
        return out

    def _words(self, text: str, rows: list[str], found: dict[str, list], breaks: list) -> list[str]:
        """The unusual words of the lines that are text; spaced words are put into ``found``."""
        skip = set(found["header"]) | {i for i in found["page_number"] if _NUMBER.match(rows[i])}
        end = max((i for i, r in enumerate(rows) if r), default=-1)
        ends = {(i, a) for i, _, a, _, _ in breaks} | {(j, b) for _, j, _, b, _ in breaks}
        unusual: set[str] = set()
        mojibake = wrongly_decoded(text)
        if spaced_out(text):
            found["spaced"] += [(i, m[0]) for i, r in enumerate(rows) if r and i not in skip for m in _SPACED.finditer(r) if self._unspaced(m[0])]
        if mojibake:
            return []
        whole, halves = [], {i for i, _ in ends}
        for i, r in enumerate(rows):
            if not r or i in skip:
                continue
            last = r[-1] in BREAK or (i == end and r[-1].isalnum())  # the last word may be half a word
            if not last and i not in halves:
                whole.append(r)
                continue
            ws = words_of(r.rstrip(BREAK))
            unusual.update(w for k, w in enumerate(ws) if w not in self.usual and (i, w) not in ends and not (last and k == len(ws) - 1) and self.unusual.looked_at(w))
        unusual.update(*map(self.unusual.__getitem__, set("\n".join(whole).lower().split())))
        return sorted(unusual)

    def _unspaced(self, letters: str) -> str | None:
        """The usual words that spaced letters spell, or None."""
        run = letters.replace(" ", "")
        low = run.lower()
        if low in self.usual:
            return run
        for cut in range(1, len(low)):
            if low[:cut] in self.usual and low[cut:] in self.usual:
                return f"{run[:cut]} {run[cut:]}"
        return None

    def repair(self, text: str, replaced: dict[str, str]) -> str:
        """Continuous paragraphs: furniture goes, broken words and wrapped lines are joined, misread words are replaced."""
        found, _ = self.read(text)
        rows = [r.strip(" \t\r") for r in re.split(r"\n|\x0c", text)]
        drop = set(found["header"]) | set(found["page_number"])
        for i, letters in found["spaced"]:
            rows[i] = rows[i].replace(letters, self._unspaced(letters) or letters)
        join = {i for i, *_ in found["hyphen"]}

        def fixed(m: re.Match) -> str:
            new = replaced.get(m[0].lower())
            return m[0] if new is None else new.upper() if m[0].isupper() and len(m[0]) > 1 else new.capitalize() if m[0][0].isupper() else new

        lengths = [len(r) for i, r in enumerate(rows) if r and i not in drop]
        wrapped = len(lengths) >= 4 and np.median(lengths) < 110
        out, open_, gap = [""], "", False
        for i, r in enumerate(rows):
            if i in drop:
                continue
            if not r:
                gap = True
                continue
            r = _TOKEN.sub(fixed, r)
            flows = out[-1] and wrapped and not _SECTION.match(r) and (open_ == "join" or not gap or (r[:1].islower() and out[-1][-1:] not in ".!?:"))
            if flows and not (_SECTION.match(out[-1]) and len(out[-1]) < 60):
                out[-1] = out[-1][:-1] + r if open_ == "join" else out[-1] + ("" if out[-1][-1:] in BREAK else " ") + r
            else:
                out.append(r)
            open_, gap = ("join" if i in join else ""), False
        return "\n\n".join(p for p in out if p)


@lru_cache(maxsize=1)
def models() -> dict[str, Boosted]:
    return {k: Boosted.from_json(v) for k, v in json.loads(MODELS.read_text()).items()}


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("text is not null")


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """``word, n``: all words of the corpus that stand inside lines, counted in each batch before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_words([nfc(t) for t in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    counted = df.select(F.col(f"`{text}`").alias("text")).where("text is not null").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _usual(words: DataFrame, share: float) -> tuple[dict[str, float], int]:
    """The usual words with their shares (at most 1 / ``share`` of them), and the number of all words."""
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(3, math.ceil(share * total))
    return {r["word"]: r["n"] / total for r in words.where(F.col("n") >= least).toLocalIterator()}, total


def _grams(c):
    """q-grams of three characters with their places, in threes, so that neighbours in place meet."""
    padded = F.concat(F.lit("##"), c, F.lit("#"))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.struct(F.substring(padded, i, F.lit(3)).alias("g"), i.alias("at")))


def corrections(unusual: DataFrame, words: DataFrame, usual_least: int, models: dict[str, Boosted]) -> DataFrame:
    """``word, replacement, score``: the best replacement of each unusual word that the ranking takes for a misreading.

    Candidates share at least two q-grams at about the same place; only words with a letter of the alphabet take part.
    """
    known = words.where(F.col("n") >= usual_least).where(F.length("word") >= 3)
    suspects = unusual.join(words, "word", "left").select("word", F.coalesce("n", F.lit(1)).alias("n"))
    a = suspects.select("word", "n", F.explode(_grams(F.col("word"))).alias("x")).select("word", "n", "x.g", F.explode(F.expr("array(x.at - 1, x.at, x.at + 1)")).alias("at"))
    b = known.select(F.col("word").alias("true"), F.col("n").alias("n_true"), F.explode(_grams(F.col("word"))).alias("x")).select("true", "n_true", "x.g", "x.at")
    met = a.join(b, ["g", "at"]).where((F.col("n") <= RARITY * F.col("n_true")) & (F.abs(F.length("word") - F.length("true")) <= 3))
    pairs = met.groupBy("word", "true").agg(F.count(F.lit(1)).alias("shared"), F.first("n").alias("n"), F.first("n_true").alias("n_true")).where("shared >= 2")
    model = models["word"]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for r in zip(*(c.to_pylist() for c in batch.columns))]
            fit = [r for r in rows if alignment(r[0], r[1])[1] <= 1]
            score = model.score(np.array([word_features(r[0], r[1], r[2], r[3], r[4]) for r in fit], np.float64).reshape(len(fit), 10))
            kept = [(r[0], r[1], float(s)) for r, s in zip(fit, score) if s > 0.5]
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64()))], names=["word", "true", "score"])

    ranked = pairs.select("word", "true", "n", "n_true", "shared").mapInArrow(rank, "word string, true string, score double")
    return ranked.groupBy("word").agg(F.max_by("true", F.struct("score", "true")).alias("replacement"), F.max("score").alias("score"))


def scan_noise(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(``key, noise_kind``; ``key, word, replacement``): the kinds of noise in each text, and its misread words.

    Null, empty and short texts have no noise; repeated rows count once; a null key is kept; texts are read whole; wrongly decoded texts have no
    misread words. Two narrow passes over the texts; only counts of words and the unusual words of a text are shuffled.
    """
    kind, trained = df.schema[key].dataType.simpleString(), models()
    words = durable(vocabulary(df, text))
    usual, total = _usual(words, USUAL)
    least = max(3, math.ceil(USUAL * total))
    held = df.sparkSession.sparkContext.broadcast(usual)  # at most 1 / USUAL words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(held.value, models())
        for batch in batches:
            out: list[tuple[int, str, str | None]] = []
            texts = [nfc(t) for t in batch.column(1).to_pylist()]
            for at in range(0, len(texts), 256):
                for i, (found, unusual) in enumerate(reader.read_all(texts[at : at + 256]), at):
                    out += [(i, "misread" if k == "spaced" else k, None) for k, v in found.items() if v]
                    out += [(i, "word", w) for w in unusual]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([o[0] for o in out], pa.int32())), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.string())], names=["key", "noise_kind", "word"]
            )

    read = durable(_rows(df, key, text).mapInArrow(run, f"key {kind}, noise_kind string, word string"))
    unusual = read.where("noise_kind = 'word'").select("word").distinct()
    fixes = durable(corrections(unusual, words, least, trained))
    misread = read.where("noise_kind = 'word'").join(fixes, "word").select("key", "word", "replacement")
    kinds = read.where("noise_kind <> 'word'").select("key", "noise_kind").unionAll(misread.select("key", F.lit("misread"))).distinct()
    return kinds.withColumnRenamed("key", key), misread.withColumnRenamed("key", key)


def repair_scans(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text``: texts with noise as continuous paragraphs, all others unchanged. Keys must be unique and not null.

    The vocabulary and the corrections are those of ``scan_noise``; texts are shuffled once, by key, to meet their corrections.
    """
    kinds, misread = scan_noise(df, key, text)
    words = vocabulary(df, text)
    usual, _ = _usual(durable(words), USUAL)
    held = df.sparkSession.sparkContext.broadcast(usual)
    kind = df.schema[key].dataType.simpleString()
    fixes = misread.groupBy(key).agg(F.map_from_entries(F.collect_set(F.struct("word", "replacement"))).alias("fixes"))
    noisy = kinds.select(key).distinct().join(fixes, key, "left").select(F.col(key).alias("key"), F.coalesce("fixes", F.create_map().cast("map<string,string>")).alias("fixes"))
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).join(noisy, "key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(held.value, models())
        for batch in batches:
            done = [t if f is None or t is None else reader.repair(nfc(t), dict(f)) for t, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.string())], names=["key", "text"])

    return rows.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key).withColumnRenamed("text", text)
