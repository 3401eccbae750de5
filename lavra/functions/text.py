"""Cleaning of texts, in the order in which the steps build on one another.

Everything but Unicode repair and the joining of hyphenated lines is a native expression over the lines of one row, so that
cleaning is one narrow pass inside generated code.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns that define the cleaned form.
CHAPTER = r"(?iu)^(?:CAP[IÍ]TULO(?:\s+[0-9]+)?|PARTE(?:\s+[0-9]+)?|INTRODUÇÃO(?:\s|$)|[0-9]+(?:\.[0-9]+)*\.?\s+[A-ZÀ-Ú])"
REFERENCES = r"(?iu)^(?:REFERÊNCIAS\s*BIBLIOGR[ÁA]FICAS?|REFERÊNCIAS|BIBLIOGRAFIA)(?:[^\p{L}\p{N}_]|$)"
PAGE_NUMBER = r"^[0-9]{1,4}$"
_MOJIBAKE = re.compile("Ã[\x80-\xbf]|Â[\x80-\xbf]|â€[\x80-\xbf]|â[\x80-\xbf]")
_VOWELS = frozenset("aeiouáéíóúàâêôãõAEIOUÁÉÍÓÚÀÂÊÔÃÕ")
_LEAD = re.compile(r"[A-Za-zÀ-ú][A-Za-zÀ-ú']*")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once for each row: inside lambdas an expression is worked out for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def clean_whitespace(text: Column) -> Column:
    """Line ends as LF, no control characters, no blanks around line ends, runs of blanks as one, at most one empty line."""
    steps = ((r"\r\n?", "\n"), (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""), (r"[ \t]+\n", "\n"), (r"\n[ \t]+", "\n"), (r"[ \t]{2,}", " "), (r"\n{3,}", "\n\n"))
    for pattern, into in steps:
        text = F.regexp_replace(text, pattern, into)
    return text


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def strip_page_numbers(text: Column) -> Column:
    """Without the lines that hold one to four digits and nothing else."""
    return F.array_join(F.filter(lines(text), lambda x: ~strip(x).rlike(PAGE_NUMBER)), "\n")


def repeated_lines(text: Column, least: int = 3, least_chars: int = 4) -> Column:
    """The distinct lines that stand at least ``least`` times in the text and are neither short, nor chapters, nor page numbers.

    Equal lines are neighbours once sorted, so that a text of n lines costs n log n and no pairs of lines are compared.
    """
    keep = lambda x: (F.length(x) >= least_chars) & ~x.rlike(CHAPTER) & ~x.rlike(PAGE_NUMBER)

    def again(ordered: Column) -> Column:
        return F.filter(F.array_distinct(F.filter(ordered, lambda x, i: (i >= least - 1) & (F.get(ordered, i - (least - 1)) == x))), keep)

    return let(F.array_sort(F.transform(lines(text), strip)), again)


def strip_repeated_lines(text: Column, least: int = 3) -> Column:
    def without(found: Column) -> Column:
        return F.when(F.size(found) == 0, text).otherwise(F.array_join(F.filter(lines(text), lambda x: ~F.array_contains(found, strip(x))), "\n"))

    return let(repeated_lines(text, least), without)


def _first_line(text: Column, pattern: str, share: float = 0.0) -> Column:
    """Number (from 1) of the first line that fits, at or after the given share of the lines; 0 for none."""

    def first(rows: Column) -> Column:
        fits = F.transform(rows, lambda x: strip(x).rlike(pattern))
        if not share:
            return F.array_position(fits, True)
        return let(F.floor(F.size(rows) * F.lit(share)).cast("int"), lambda least: F.array_position(F.transform(fits, lambda x, i: (i >= least) & x), True))

    return let(lines(text), first)


def cut_front_matter(text: Column) -> Column:
    """From the first line that opens a chapter on; the whole text if none does."""
    at = _first_line(text, CHAPTER)
    return F.when(at > 1, F.array_join(F.slice(lines(text), at.cast("int"), F.size(lines(text))), "\n")).otherwise(text)


def cut_references(text: Column, share: float = 0.35) -> Column:
    """Up to the first heading of references that stands at or after ``share`` of the lines."""
    at = _first_line(text, REFERENCES, share)
    kept = F.array_join(F.slice(lines(text), 1, F.greatest(at.cast("int") - 1, F.lit(0))), "\n")
    return F.when(at > 0, F.concat(F.regexp_replace(kept, r"\s+$", ""), F.lit("\n"))).otherwise(text)


def repaired(text: str) -> str:
    """NFC; text that was decoded in a wrong one-byte encoding is decoded again if all of it can be."""
    text = unicodedata.normalize("NFC", text)
    if _MOJIBAKE.search(text):
        for encoding in ("latin-1", "cp1252"):
            try:
                return text.encode(encoding).decode("utf-8")
            except UnicodeError:
                pass
    return text


def joined_hyphens(text: str) -> str:
    """Without soft hyphens; a line that ends in a hyphen takes in the next one if what comes together can be a word."""
    rows, out, at = text.replace("­", "").split("\n"), [], 0
    while at < len(rows):
        row = rows[at].rstrip()
        head = row[:-1].rstrip()
        if row[-1:] == "-" and len(head) >= 3 and at + 1 < len(rows):
            following = rows[at + 1].lstrip()
            lead = _LEAD.match(following)
            if lead and not _VOWELS.isdisjoint(head[-1] + lead[0]):
                out.append(head + following)
                at += 2
                continue
        out.append(row)
        at += 1
    return "\n".join(out)


def folded(text: str) -> str:
    """Without case, accents and runs of white space: the form in which texts are compared."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join(plain.casefold().split())


def ascii_folded(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKD", text.casefold()).encode("ascii", "ignore").decode().split())


def _each(function):
    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else function(x))

    return run


repair_unicode = _each(repaired)
join_hyphens = _each(joined_hyphens)
fold = _each(folded)
ascii_fold = _each(ascii_folded)
fix_text = _each(lambda x: repaired(x).strip())


_STEPS = [(re.compile(p), x) for p, x in ((r"\r\n?", "\n"), (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""), (r"[ \t]+\n", "\n"), (r"\n[ \t]+", "\n"), (r"[ \t]{2,}", " "), (r"\n{3,}", "\n\n"))]
_CHAPTER_LINE, _REFERENCE_LINE, _NUMBER_LINE = (re.compile(p.replace("(?iu)", "(?i)").replace(r"[^\p{L}\p{N}_]", r"\W")) for p in (CHAPTER, REFERENCES, PAGE_NUMBER))


def cleaned(text: str) -> str:
    """All steps in one pass for texts whose Unicode and hyphens must be repaired between the native steps."""
    text = repaired(text)
    for pattern, into in _STEPS:
        text = pattern.sub(into, text)
    rows = [r for r in text.split("\n") if not _NUMBER_LINE.match(r.strip())]
    often = Counter(r.strip() for r in rows)
    rows = [r for r in rows if often[r.strip()] < 3 or len(r.strip()) < 4 or _CHAPTER_LINE.match(r.strip())]
    rows = joined_hyphens("\n".join(rows)).split("\n")
    at = next((i for i, r in enumerate(rows) if _CHAPTER_LINE.match(r.strip())), 0)
    rows = rows[at:]
    end = next((i for i, r in enumerate(rows) if i >= int(len(rows) * 0.35) and _REFERENCE_LINE.match(r.strip())), len(rows))
    return "\n".join(rows[:end]).strip() + "\n"


clean_text = _each(cleaned)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"))


def shingles(word_list: Column, width: int = 5) -> Column:
    """Runs of ``width`` words; a shorter text is one run."""
    runs = F.transform(F.sequence(F.lit(0), F.size(word_list) - width), lambda i: F.array_join(F.slice(word_list, i + 1, width), " "))
    return F.when(F.size(word_list) >= width, runs).otherwise(F.array(F.array_join(word_list, " ")))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)
