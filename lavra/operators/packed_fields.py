"""Several values packed into one field: a parsing expression grammar that gives one row for each value.

    field     <- gap (value (gap value)*)? gap
    value     <- quoted &stop / bracketed &stop / address &stop / bare
    quoted    <- '"' ('""' / !'"' .)* '"'
    bracketed <- '[' (!']' .)* ']' / '<' (!'>' .)* '>'
    bare      <- (address / !delimiter .)+
    stop      <- delimiter / end

The alternatives are tried in this order. A quote that never closes, or that closes before a delimiter is due, makes
``quoted`` fail; the parser goes back and reads the value as ``bare``, and says so in ``flag``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.scalars import NOT_INFORMED
from lavra.functions.text import ascii_folded

_SCHEMES = r"(?:https?://|ftp://|www\.|hdl:|doi:|urn:|ark:)"


@dataclass(frozen=True)
class FieldGrammar:
    """How one kind of field packs its values.

    ``headings``: a comma before a lower-case word belongs to an inverted heading and is no delimiter.
    ``addresses``: a blank between two addresses is a delimiter.
    """

    headings: bool = False
    addresses: bool = False


class PackedFieldParser:
    def __init__(self, grammar: FieldGrammar):
        comma = r",(?!\s*(?-i:[a-zß-öø-ÿ]))" if grammar.headings else ","
        soft = rf"(?:[;,]+(?=\s|$|[\"|;,]|{_SCHEMES}|info:|n[ãa]o\s+informado))"
        self.address = re.compile(rf"(?:info:[^\s|;,\"]+|{_SCHEMES}(?:(?!{soft})[^\s|\"<>])+)", re.I)
        gap = rf"\s*(?:\|+|;|{comma}|\n)\s*|\s+/\s+"
        if grammar.addresses:
            gap += rf"|\s+(?=\"?(?:{_SCHEMES}|info:))"
        self.gap = re.compile(f"(?:{gap})+")
        self.lead = re.compile(rf"\s*(?:(?:\|+|;|,|\n|/\s)\s*)*")
        self.quoted = re.compile(r'"((?:[^"]|"")*)"')
        self.bracketed = re.compile(r"\[[^\[\]]*\]|<[^<>]*>")
        # blanks are taken as a whole, and only before what is no delimiter, so that a long run of them is looked at once
        sign = rf"\||;|{comma}"
        address = rf"|\"?(?:{_SCHEMES}|info:)" if grammar.addresses else ""
        self.bare = re.compile(rf"(?:{self.address.pattern}|[^\S\n]++(?!\n|{sign}|/\s{address})|(?!{sign})\S)+", re.I)
        self.blank_tail = re.compile(r"\s*$")

    def _stop(self, text: str, at: int) -> bool:
        return bool(self.gap.match(text, at) or self.blank_tail.match(text, at))

    def _value(self, text: str, at: int) -> tuple[int, str, str | None]:
        flag = None
        if text[at] == '"':
            m = self.quoted.match(text, at)
            if m and self._stop(text, m.end()):
                return m.end(), m[1].replace('""', '"').strip(), None
            if m and text[m.end() :].lstrip()[:1] == '"':  # what is quoted is one value, though its delimiter is missing
                return m.end(), m[1].replace('""', '"').strip(), "missing_delimiter"
            flag = "text_after_quote" if m else "open_quote"
        elif text[at] in "[<":
            m = self.bracketed.match(text, at)
            if m and self._stop(text, m.end()):
                return m.end(), m[0], None
            flag = None if m else "open_bracket"
        else:
            m = self.address.match(text, at)
            if m and self._stop(text, m.end()):
                return m.end(), m[0], None
        m = self.bare.match(text, at)
        if not m:
            return at + 1, "", flag
        value = m[0].strip()
        if flag == "open_quote":
            value = value[1:].strip()
        return m.end(), value, flag

    def parse(self, text: str | None) -> list[tuple[str, str | None]]:
        """Values with their error flags, in order; empty pieces and placeholders are left out."""
        if not text:
            return []
        out, at, end = [], self.lead.match(text).end(), len(text)
        while at < end:
            at, value, flag = self._value(text, at)
            if value and (len(value) > 40 or ascii_folded(value) != NOT_INFORMED):
                out.append((value, flag))
            m = self.gap.match(text, at)
            at = m.end() if m else (end if self.blank_tail.match(text, at) else at + (flag == "missing_delimiter") * (len(text[at:]) - len(text[at:].lstrip())))
        return out


@lru_cache(maxsize=16)
def parser(grammar: FieldGrammar) -> PackedFieldParser:
    return PackedFieldParser(grammar)


def split_packed_fields(df: DataFrame, key: str, fields: dict[str, FieldGrammar]) -> DataFrame:
    """One row for each value of the packed ``fields``: ``key, field_name, pos, item, flag, values_in_field``.

    ``pos`` counts the values of a field from 1. Null, empty and blank fields, empty pieces and placeholders give no row.
    ``flag`` is null for well-formed values, else ``open_quote``, ``text_after_quote``, ``missing_delimiter`` or ``open_bracket``. A null key is
    kept; repeated input rows give repeated rows; values of any length are read whole; columns of ``df`` that are not named
    are not read, so clashing names do not matter. One narrow pass, no shuffle.
    """
    kind = df.schema[key].dataType.simpleString()
    names = list(fields)
    columns = [F.col(f"`{n}`").alias(f"f{i}") for i, n in enumerate(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, field, pos, item, flag, many = [], [], [], [], [], []
            for i, name in enumerate(names):
                parse = parser(fields[name]).parse
                for row, text in enumerate(batch.column(i + 1).to_pylist()):
                    found = parse(text)
                    rows += [row] * len(found)
                    field += [name] * len(found)
                    pos += range(1, len(found) + 1)
                    item += [v for v, _ in found]
                    flag += [f for _, f in found]
                    many += [len(found)] * len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int32())),
                    pa.array(field, pa.string()),
                    pa.array(pos, pa.int32()),
                    pa.array(item, pa.string()),
                    pa.array(flag, pa.string()),
                    pa.array(many, pa.int32()),
                ],
                names=["key", "field_name", "pos", "item", "flag", "values_in_field"],
            )

    schema = f"key {kind}, field_name string, pos int, item string, flag string, values_in_field int"
    return df.select(F.col(f"`{key}`").alias("key"), *columns).mapInArrow(run, schema).withColumnRenamed("key", key)
