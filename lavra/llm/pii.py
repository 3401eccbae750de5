"""Personal information in free text: a character-level BiLSTM with CRF finds it, typed placeholders take its place.

Whole texts are read in overlapping windows; the blended scores are decoded globally (``lavra.llm.tagger``). What is found is then
checked exactly: an item starts and ends at the ends of words, and has what every item of its kind has (digits for numbers, two words for
names and so on). The weights are trained by ``lavra.llm.pii_training`` from labelled spans and lie beside this file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.tagger import CharTagger

KINDS = ("EMAIL", "PHONE", "ID", "ADDRESS", "PERSON")
WEIGHTS = Path(__file__).with_name("pii_weights.npz")
_MASKED = re.compile(r"<<[^<>]*>>")
_WORD = re.compile(r"[^\W_]{2,}")


def spans_of(text: str, tags: np.ndarray) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the items that the tags of a text say, from 0; ends are exclusive."""
    out: list[tuple[int, int, str]] = []
    inside = np.flatnonzero(tags)
    if not len(inside):
        return out
    runs: list[list[int]] = []
    for i, tag in zip(inside.tolist(), tags[inside].tolist()):
        kind = (tag - 1) // 2
        if runs and runs[-1][1] == i and runs[-1][2] == kind and not (tag % 2 and not _inside_word(text, i)):
            runs[-1][1] = i + 1
        else:
            runs.append([i, i + 1, kind])
    for a, b, k in runs:
        while a > 0 and _inside_word(text, a) and not (out and a <= out[-1][1]):
            a -= 1
        while b < len(text) and _inside_word(text, b):
            b += 1
        while a < b and text[a] in " \t\r\n,;:.-–—)]}":
            a += 1
        while a < b and text[b - 1] in " \t\r\n,;:([{–—":
            b -= 1
        kind = _number_kind(text[a:b]) or KINDS[k] if KINDS[k] in ("PHONE", "ID") else KINDS[k]
        if a < b and _holds(text[a:b], kind) and not (out and a < out[-1][1]):
            out.append((a, b, kind))
    if out and "<<" in text:
        masked = [m.span() for m in _MASKED.finditer(text)]
        out = [s for s in out if not any(a < s[1] and s[0] < b for a, b in masked)]
    return out


#: Written forms that only a telephone number or only an identity number has.
_PHONE_FORM = re.compile(r"\+\d.*|\(\d{2,3}\).*|\d{2}\s9\s\d{4}\s\d{4}|\d{3}\s\d{4}\s\d{4}|\d{2}\.\d{4}\.\d{4}|\d{10}", re.S)
_ID_FORM = re.compile(r"\d{3}\.\d{3}\.\d{3}-\d\d|\d{3}\s\d{3}\s\d{3}\s\d\d|\d{11}|(?:[A-Z]{2}-)?\d{2}\.\d{3}\.\d{3}(?:-[\dx])?|[A-Z]{1,2}\d{6}", re.I)


def _number_kind(item: str) -> str | None:
    """What a number is by its written form, where the form decides."""
    return "PHONE" if _PHONE_FORM.fullmatch(item) else "ID" if _ID_FORM.fullmatch(item) else None


def _inside_word(text: str, at: int) -> bool:
    return (text[at - 1].isalnum() or text[at - 1] == "_") and (text[at].isalnum() or text[at] == "_")


def _holds(item: str, kind: str) -> bool:
    digits = sum(c.isdigit() for c in item)
    if kind == "EMAIL":
        return len(item) > 5 and ("@" in item or " at " in item.lower() or "arroba" in item.lower() or "at" in item.lower())
    if kind == "PHONE":
        return digits >= 7
    if kind == "ID":
        return digits >= 6
    if kind == "ADDRESS":
        return len(_WORD.findall(item)) >= 2
    return len(_WORD.findall(item)) >= 2 and digits <= 1


def _tagged(batches: Iterator[pa.RecordBatch], weights: bytes, make, names: list[str]) -> Iterator[pa.RecordBatch]:
    tagger = CharTagger.from_bytes(weights)
    for batch in batches:
        at, sizes = 0, pc.utf8_length(batch.column(1)).fill_null(0).to_pylist()
        while at < batch.num_rows:  # slices of a bounded number of characters, one long text at least
            size, end = 0, at
            while end < batch.num_rows and (end == at or size < 800_000):
                size += sizes[end]
                end += 1
            part = batch.slice(at, end - at)
            at = end
            texts = [t or "" for t in part.column(1).to_pylist()]
            found = [spans_of(t, tags) for t, tags in zip(texts, tagger.tag(texts))]
            yield pa.RecordBatch.from_arrays(make(part, texts, found), names=names)


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))


def find_personal_data(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, pii_kind, start_pos, end_pos``: each item of a text, characters counted from 1, ``end_pos`` the last one.

    Null and empty texts have no rows; a null key is kept; repeated rows give repeated items; existing ``<<...>>`` placeholders are no
    items; texts of any length are read whole; no other column is read. One narrow pass without a shuffle.
    """
    kind, weights = df.schema[key].dataType.simpleString(), WEIGHTS.read_bytes()

    def make(part: pa.RecordBatch, texts: list[str], found: list) -> list:
        flat = [(i, *s) for i, spans in enumerate(found) for s in spans]
        columns = list(zip(*flat)) if flat else ([], [], [], [])
        return [
            part.column(0).take(pa.array(columns[0], pa.int32())),
            pa.array(columns[3], pa.string()),
            pa.array([a + 1 for a in columns[1]], pa.int32()),
            pa.array(columns[2], pa.int32()),
        ]

    names = ["key", "pii_kind", "start_pos", "end_pos"]
    wanted = _rows(df, key, text).where("text <> ''")
    return wanted.mapInArrow(lambda b: _tagged(b, weights, make, names), f"key {kind}, pii_kind string, start_pos int, end_pos int").withColumnRenamed("key", key)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, last = [], 0
    for a, b, kind in spans:
        out += [text[last:a], f"<<{kind}>>"]
        last = b
    return "".join([*out, text[last:]])


def redact_personal_data(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, redactions``: the text with typed placeholders, all else unchanged, and the number of them.

    A null text stays null with no redactions, an empty one stays empty; the other cases are those of ``find_personal_data``.
    """
    kind, weights = df.schema[key].dataType.simpleString(), WEIGHTS.read_bytes()

    def make(part: pa.RecordBatch, texts: list[str], found: list) -> list:
        known = part.column(1).is_valid().to_pylist()
        done = [redact(t, s) if ok else None for t, s, ok in zip(texts, found, known)]
        return [part.column(0), pa.array(done, pa.string()), pa.array([len(s) for s in found], pa.int32())]

    names = ["key", "text", "redactions"]
    return _rows(df, key, text).mapInArrow(lambda b: _tagged(b, weights, make, names), f"key {kind}, text string, redactions int").withColumnRenamed("key", key).withColumnRenamed("text", text)
