"""Languages of texts and of their paragraphs, by bit-sliced filters over character n-grams.

One byte array holds a Bloom filter for each language in one bit of every byte, so a single look gives all languages that contain
an n-gram. A paragraph's popcount for a language is corrected for the filter's false positives; the language with the largest
corrected share of n-grams is the paragraph's. A text's main language is that of most of its words.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("pt", "en", "es", "fr")
#: Labelled rows for each language that the filters are fitted on, the ones with the least hashes of their keys.
SAMPLE_ROWS = 400
SLOTS, HASHES = 1 << 20, 3
#: Words that a worker keeps scores of before it starts anew.
MEMORY_WORDS = 250_000
TEXT_WORDS, PARAGRAPH_WORDS = 20, 12
_WORD = re.compile(r"[^\W\d_]+")
_BLANK_LINES = re.compile(r"\n\s*\n")
_MARKS = re.compile("[̀-ͯ]")


def _ngrams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for n in (2, 3, 4) for i in range(len(padded) - n + 1)] + [padded]


def _slots(gram: str) -> list[int]:
    h = xxhash.xxh3_64_intdigest(gram)
    return [(h >> (20 * k)) & (SLOTS - 1) for k in range(HASHES)]


class LanguageFilters:
    """The bit-sliced filters; ``rates`` are their false-positive rates, measured from their fill."""

    def __init__(self, languages: tuple[str, ...], slices: np.ndarray):
        self.languages, self.slices = languages, slices
        self.rates = np.array([float(((slices >> i) & 1).mean()) ** HASHES for i in range(len(languages))])

    @classmethod
    def fit(cls, labelled: list[tuple[str, str]], languages: tuple[str, ...] = LANGUAGES, rounds: int = 2) -> LanguageFilters:
        """Filters from (language, text). Labels may be partly wrong: after each round the texts are labelled anew.

        An n-gram belongs to the languages in which its share of words is at least a third (in the last round a tenth) of its
        share in the language that has it most.
        """
        texts = [(lab, Counter(_WORD.findall(_plain(t)))) for lab, t in labelled if lab in languages]
        for r in range(rounds + 1):
            counts = [Counter() for _ in languages]
            for lab, words in texts:
                counts[languages.index(lab)].update(words)
            shares: dict[str, np.ndarray] = {}
            for i, c in enumerate(counts):
                total = max(1, sum(c.values()))
                for w, n in c.items():
                    for g in _ngrams(w):
                        shares.setdefault(g, np.zeros(len(languages)))[i] += n / total
            keep, slices = (0.33, 0.2, 0.1)[min(r, 2)], np.zeros(SLOTS, dtype=np.uint8)
            for g, s in shares.items():
                mask = sum(1 << i for i in range(len(languages)) if s[i] >= keep * s.max())
                for at in _slots(g):
                    slices[at] |= mask
            found = cls(languages, slices)
            if r < rounds:
                scorer = _Scorer(found)
                texts = [(scorer.best(words) or lab, words) for lab, words in texts]
        return found


def _plain(text: str) -> str:
    return (unicodedata.normalize("NFC", text) if _MARKS.search(text) else text).lower()


class _Scorer(dict):
    """Words to rows of ``table``: popcounts for each language, and last the number of n-grams."""

    def __init__(self, filters: LanguageFilters):
        super().__init__()
        self.filters, self.width = filters, len(filters.languages)
        self.table = np.zeros((1024, self.width + 1), dtype=np.float32)

    def _counts(self, word: str) -> list[int]:
        slices = self.filters.slices
        counts, grams = [0] * self.width, _ngrams(word)
        for g in grams:
            a, b, c = _slots(g)
            mask = slices[a] & slices[b] & slices[c]
            for i in range(self.width):
                counts[i] += mask >> i & 1
        return [*counts, len(grams)]

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[row] = self._counts(word)
        self[word] = row
        return row

    def renewed(self) -> _Scorer:
        """Itself, or an empty one once it holds many words: what a worker keeps is bounded, and no word is left out."""
        return self if len(self) <= MEMORY_WORDS else _Scorer(self.filters)

    def rows(self, words: list[str]) -> list[int]:
        return list(map(self.__getitem__, words))

    def shares(self, sums: np.ndarray) -> np.ndarray:
        """Shares of n-grams in each language, without what the filters find by chance."""
        f = self.filters.rates
        return np.maximum(1e-6, (sums[:, :-1] / np.maximum(sums[:, -1:], 1) - f) / (1 - f))

    def best(self, words: Counter) -> str | None:
        if not words:
            return None
        rows = self.rows(list(words))
        sums = (self.table[rows] * np.array(list(words.values()))[:, None]).sum(axis=0, keepdims=True)
        return self.filters.languages[int(self.shares(sums)[0].argmax())]


def _confidence(lead: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Logistic in the number of n-grams by which the language leads: 0.5 for a tie, below for a text that mixes languages."""
    return 1 / (1 + np.exp(-np.clip(lead * grams / 4, -30, 30)))


def fit_filters(df: DataFrame, key: str, label: str, text: str, *, languages: tuple[str, ...] = LANGUAGES, sample_rows: int = SAMPLE_ROWS) -> LanguageFilters:
    """Filters fitted on at most ``sample_rows`` labelled rows for each language."""
    ids = None
    for code in languages:
        part = df.where((F.col(label) == code) & F.col(key).isNotNull()).select(key).orderBy(F.xxhash64(key), key).limit(sample_rows)
        ids = part if ids is None else ids.unionAll(part)
    wanted = F.broadcast(ids.distinct())  # at most sample_rows x languages keys
    rows = df.join(wanted, key, "left_semi").where(F.col(text).isNotNull() & F.col(label).isin(*languages))
    one = rows.groupBy(key).agg(F.min(F.struct(label, text)).alias("r"))  # one for each key, whatever keys repeat
    return LanguageFilters.fit(sorted((r[0], r[1]) for r in one.select("r.*").collect()), languages)


def detect_languages(df: DataFrame, key: str, text: str, filters: LanguageFilters) -> DataFrame:
    """``key, segment_no, lang_code, confidence, words, main_lang``: row 0 for each text, then its paragraphs.

    Texts with fewer than 20 words (null, empty and blank ones among them) have no rows, paragraphs with fewer than 12 none.
    Paragraphs are numbered from 1 in the whole text. ``confidence`` is logistic in the lead over the next language,
    counted in n-grams. Equal shares go to the language named first. Texts are read whole; repeated rows stay repeated; other columns are
    not read.
    """
    kind = df.schema[key].dataType.simpleString()
    languages, slices = filters.languages, filters.slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(LanguageFilters(languages, slices))
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # slices of a bounded number of characters, one text at least
                scorer, end, size = scorer.renewed(), at, 0
                while end < batch.num_rows and end - at < 500 and (end == at or size < 4_000_000):
                    size += len(batch.column(1)[end].as_py() or "")
                    end += 1
                yield part_rows(batch.slice(at, end - at), scorer)
                at = end

    def part_rows(part: pa.RecordBatch, scorer: _Scorer) -> pa.RecordBatch:
        rows: list[int] = []
        segments: list[tuple[int, int, int]] = []  # row of the batch, number of the paragraph, words
        for i, text in enumerate(part.column(1).to_pylist()):
            if not text:
                continue
            number = 0
            for paragraph in _BLANK_LINES.split(_plain(text)):
                if not paragraph.strip():
                    continue
                number += 1
                words = _WORD.findall(paragraph)
                if words:
                    rows += scorer.rows(words)
                    segments.append((i, number, len(words)))
        out: list[tuple[int, int, str, float, int, str]] = []
        if segments:
            sizes = np.array([n for _, _, n in segments])
            sums = np.add.reduceat(scorer.table[rows], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
            shares = scorer.shares(sums)
            best = shares.argmax(axis=1)
            top = np.sort(shares, axis=1)
            sure = _confidence(top[:, -1] - top[:, -2], sums[:, -1])
            owner = np.array([i for i, _, _ in segments])
            firsts = np.flatnonzero(np.diff(owner, prepend=-1))
            for a, b in zip(firsts, [*firsts[1:], len(segments)]):
                total = int(sizes[a:b].sum())
                if total < TEXT_WORDS:
                    continue
                votes = np.zeros(len(languages))
                long_ = sizes[a:b] >= PARAGRAPH_WORDS // 2
                np.add.at(votes, best[a:b][long_], sizes[a:b][long_])
                whole = scorer.shares(sums[a:b].sum(axis=0, keepdims=True))[0]
                main = int((votes + whole / 1e3).argmax())
                other = np.delete(whole, main).max()
                out.append((int(owner[a]), 0, languages[main], float(_confidence(whole[main] - other, sums[a:b, -1].sum())), total, languages[main]))
                out += [
                    (int(owner[a]), segments[k][1], languages[best[k]], float(sure[k]), int(sizes[k]), languages[main])
                    for k in range(a, b)
                    if sizes[k] >= PARAGRAPH_WORDS
                ]
        taken = part.column(0).take(pa.array([o[0] for o in out], pa.int32()))
        names = ["key", "segment_no", "lang_code", "confidence", "words", "main_lang"]
        kinds = [pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([taken, *(pa.array([o[j + 1] for o in out], k) for j, k in enumerate(kinds))], names=names)

    schema = f"key {kind}, segment_no int, lang_code string, confidence double, words int, main_lang string"
    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)
