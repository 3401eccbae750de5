"""Personal data by fixed patterns: ordered redaction, known names, role sequences and what remains afterwards.

All of it is native: patterns are replaced one after another in the running text, names by a fold over the row's own list.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator

import json
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import let

# Patterns in the order in which they are replaced, with their placeholders.
PATTERNS = (
    ("URL", r"(?i)\b(?:https?://|ftp://|www\.)\S+"),
    ("EMAIL", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
    ("IP", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"),
    ("PHONE", r"(?:\+55[\s-]?)?(?:\([0-9]{2}\)[\s-]?|[0-9]{2}[\s-]?)[0-9]{4,5}[\s-]?[0-9]{4}"),
    ("CPF", r"\b[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}\b|\b[0-9]{11}\b"),
    ("RG", r"\b[0-9]{1,2}\.[0-9]{3}\.[0-9]{3}(?:-[0-9]{1,2})?\b"),
    ("ENDEREÇO", r"\b[0-9]{5}-[0-9]{3}\b"),
)
ROLE_SEQUENCE = (
    r"(?iu)(?:Orientador|Co-orientador|Coorientador|por|Autor|Professor|Professora)\s*:?\s+"
    r"[A-ZÀ-Ú][\p{L}\p{N}_']*(?:\s+[A-ZÀ-Ú][\p{L}\p{N}_']*){1,5}"
)
ROLE_KEYS = ("orientador", "advisor", "professor")
PERSON = "<<PERSON>>"


def redact_patterns(text: Column) -> Column:
    for name, pattern in PATTERNS:
        text = F.regexp_replace(text, pattern, f"<<{name}>>")
    return text


def redaction_counts(text: Column) -> Column:
    """Map of kind to the number of replacements, each counted in the text as the earlier ones left it; kinds without any are left out."""

    def counted(t: Column, rest: tuple, entries: list[Column]) -> Column:
        (name, pattern), *rest = rest
        entries = [*entries, F.struct(F.lit(name).alias("key"), F.regexp_count(t, F.lit(pattern)).alias("value"))]
        if not rest:
            return F.filter(F.array(*entries), lambda e: e["value"] > 0)
        return let(F.regexp_replace(t, pattern, f"<<{name}>>"), lambda x: counted(x, rest, entries))

    return F.map_from_entries(let(text, lambda t: counted(t, PATTERNS, [])))


def residual_counts(text: Column) -> Column:
    """Map of all kinds to the matches that a text still has, zeros included."""
    pairs = [x for name, pattern in PATTERNS for x in (F.lit(name), F.regexp_count(text, F.lit(pattern)))]
    return F.create_map(*pairs)


def redact_names(text: Column, names: Column) -> Column:
    """Known names of two words or more, whole words, in any case, whatever blanks stand between the words."""
    parts = lambda n: F.filter(F.split(n, r"[,\s]+"), lambda w: w != "")
    quoted = lambda n: F.transform(parts(n), lambda w: F.concat(F.lit(r"\Q"), w, F.lit(r"\E")))
    pattern = lambda n: F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_])"), F.array_join(quoted(n), r"\s+"), F.lit(r"(?![\p{L}\p{N}_])"))
    usable = F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.size(parts(n)) >= 2)
    return F.aggregate(usable, text, lambda t, n: F.regexp_replace(t, pattern(n), F.lit(PERSON)))


def redact_roles(text: Column) -> Column:
    return F.regexp_replace(text, ROLE_SEQUENCE, PERSON)


def names_below_roles(value: object) -> Iterator[str]:
    """Texts below keys that name an adviser or professor, wherever they stand in a record; lists of texts there count too."""
    if isinstance(value, dict):
        for key, item in value.items():
            if any(r in key.lower() for r in ROLE_KEYS):
                if isinstance(item, str):
                    yield item
                elif isinstance(item, list):
                    yield from (x for x in item if isinstance(x, str))
                    yield from names_below_roles([x for x in item if not isinstance(x, str)])
            else:
                yield from names_below_roles(item)
    elif isinstance(value, list):
        for item in value:
            yield from names_below_roles(item)


@F.pandas_udf(T.ArrayType(T.StringType()))
def role_names(records: pd.Series) -> pd.Series:
    """Names below role keys of records given as JSON; null and broken records have none."""

    def read(x):
        try:
            return list(names_below_roles(json.loads(x))) if x else []
        except ValueError:
            return []

    return records.map(read)


class PersonRedactor(ABC):
    """How persons are redacted; the default knows names and role sequences."""

    @abstractmethod
    def __call__(self, text: Column, names: Column) -> Column: ...


class HeuristicRedactor(PersonRedactor):
    def __call__(self, text: Column, names: Column) -> Column:
        return redact_roles(redact_names(text, names))


class RecognizerRedactor(PersonRedactor):
    """A place for a recogniser of names: ``function`` takes text and names and gives the redacted text."""

    def __init__(self, function=None):
        self.function = function

    def __call__(self, text: Column, names: Column) -> Column:
        if self.function is None:
            raise NotImplementedError("no recogniser is configured")
        return self.function(text, names)


def anonymize(df: DataFrame, text: str, names: str, redactor: PersonRedactor | None = None) -> DataFrame:
    """``df`` with ``text`` redacted and ``redactions``, the map of what was replaced (PERSON included).

    Null texts stay null with null counts; null name lists count as empty. The columns ``text`` and ``redactions`` are replaced
    if they exist; all others stay.
    """
    body = (redactor or HeuristicRedactor())(redact_patterns(F.col(f"`{text}`")), F.transform(F.col(f"`{names}`"), lambda n: F.trim(n)))
    persons = F.regexp_count(F.col("__redacted"), F.lit(PERSON))
    counted = F.map_filter(F.map_concat(F.col("__counts"), F.create_map(F.lit("PERSON"), persons)), lambda _, v: v > 0)
    staged = df.withColumns({"__redacted": body, "__counts": redaction_counts(F.col(f"`{text}`"))})
    return staged.withColumns({"redactions": counted, text: F.col("__redacted")}).drop("__redacted", "__counts")


def map_totals(df: DataFrame, column: str) -> DataFrame:
    """``kind, total``: sums of a map column by key."""
    return df.select(F.explode(column).alias("kind", "n")).groupBy("kind").agg(F.sum("n").alias("total"))
