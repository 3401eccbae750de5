"""Sections, sentence pieces and overlapping chunks of documents."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.scalars import is_heading, section_name
from lavra.functions.text import lines

START = "INÍCIO"
TARGET_TOKENS, OVERLAP_TOKENS = 1024, 128
_TOKENS = re.compile(r"[^\W\d_]+|\d{1,3}|[^\w\s]|_")
_PIECE_END = re.compile(r"(?<=[.!?…;])[ \t]+|\n+")
_CHAPTER = re.compile(r"^(?:CAP[IÍ]TULO|PARTE|ANEXO|APÊNDICE)\b", re.I)
_NUMBERED = re.compile(r"^\d+(?:\.\d+)*\.?\s+[A-ZÀ-Ú]")


def sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, section_no, section, start_line, end_line``: the parts between headings, lines counted from 0, ends exclusive.

    What stands before the first heading is ``INÍCIO``, number 0, and is left out if it has no line. Null texts have no rows, an empty
    text has one. Native: headings are found with one higher-order expression over the lines of a row.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), lines(F.regexp_replace(F.regexp_replace(F.col(f"`{text}`"), r"\r\n?", "\n"), r"\n\z", "")).alias("l")).where("l is not null")
    heads = F.filter(F.transform("l", lambda x, i: F.when(is_heading(x), F.struct(i.alias("at"), section_name(x).alias("name")))), lambda h: h.isNotNull())
    opening = F.array(F.struct(F.lit(0).alias("at"), F.lit(START).alias("name")))
    starts = F.when((F.size("heads") > 0) & (F.col("heads")[0]["at"] == 0), F.col("heads")).otherwise(F.concat(opening, "heads"))
    shift = F.when((F.size("heads") > 0) & (F.col("heads")[0]["at"] == 0), 1).otherwise(0)
    cut = rows.withColumn("heads", heads).select("key", shift.alias("shift"), F.size("l").alias("lines"), starts.alias("s"))
    placed = cut.select("key", "lines", "shift", "s", F.posexplode("s").alias("i", "x"))
    ends = F.coalesce(F.get(F.col("s"), F.col("i") + 1)["at"], F.col("lines"))
    return placed.select(F.col("key").alias(key), (F.col("i") + F.col("shift")).alias("section_no"), F.col("x.name").alias("section"), F.col("x.at").alias("start_line"), ends.alias("end_line"))


def sentence_pieces(text: Column) -> Column:
    """Array of the pieces of a text that is cut after ``.!?…;`` before blanks and at line ends; blank pieces are left out."""
    marked = F.regexp_replace(text, r"([.!?…;])[ \t]+", "$1\n")
    return F.filter(F.transform(F.split(marked, r"\n+"), lambda p: F.trim(p)), lambda p: p != "")


def count_tokens(text: str) -> int:
    """Words, groups of up to three digits and single marks: a count that needs no vocabulary."""
    return len(_TOKENS.findall(text))


def heading(line: str) -> bool:
    t = line.strip()
    return bool(t) and len(t) <= 90 and bool(_CHAPTER.search(t) or _NUMBERED.match(t) or (t.isupper() and " " in t))


def _name(line: str) -> str:
    bare = " ".join(re.sub(r"^\d+(?:\.\d+)*\.?\s+", "", line.strip()).strip(" -–—.").split())
    return (bare or "SEÇÃO")[:60]


def section_starts(text: str) -> tuple[list[int], list[str]]:
    """Offsets and names of the sections of a text, by line."""
    starts, names, at = [0], [START], 0
    for row in text.split("\n"):
        if heading(row):
            if at == starts[-1] and names[-1] == START and len(starts) == 1:
                names[0] = _name(row)
            else:
                starts.append(at)
                names.append(_name(row))
        at += len(row) + 1
    return starts, names


def pieces_of(text: str) -> list[tuple[str, int]]:
    out, at = [], 0
    for m in [*_PIECE_END.finditer(text), None]:
        end = m.start() if m else len(text)
        piece = text[at:end]
        if piece.strip():
            out.append((piece.strip(), at + len(piece) - len(piece.lstrip())))
        at = m.end() if m else at
    return out


def pack(sizes: list[int], target: int, overlap: int) -> Iterator[range]:
    """Ranges of pieces: greedy up to ``target``, each begun with the shortest tail of the one before that has ``overlap``.

    A piece above the target stands alone. Where the tail leaves no room for the next piece, it is dropped, so that every
    range brings at least one new piece.
    """
    at, first = 0, 0
    while at < len(sizes):
        total = sum(sizes[first:at])
        end = at
        while end < len(sizes) and total + sizes[end] <= target:
            total += sizes[end]
            end += 1
        if end == at:
            if first < at:
                first = at
                continue
            end = at + 1
        yield range(first, end)
        at, first, kept = end, end, 0
        while overlap > 0 and first > 0 and kept < overlap:
            first -= 1
            kept += sizes[first]


def chunk_documents(
    df: DataFrame, key: str, text: str, title: str | None = None, *, target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS, counter: Callable[[str], int] = count_tokens
) -> DataFrame:
    """``chunk_id, key, title, section, page, position, tokens, text``: overlapping chunks of whole sentences.

    ``page`` is the number of the section (from 1) in which the chunk starts; ``tokens`` is counted in the joined text.
    Null and blank texts have no chunks; a sentence above ``target`` is a chunk of its own; repeated rows are cut again; a null key gives
    null chunk ids. One narrow pass; a long text is worked line by line, never against itself.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, body in enumerate(batch.column(2).to_pylist()):
                if not body or not body.strip():
                    continue
                pieces = pieces_of(body)
                starts, names = section_starts(body)
                for n, r in enumerate(pack([counter(p) for p, _ in pieces], target, overlap)):
                    at = bisect_right(starts, pieces[r.start][1]) - 1
                    joined = " ".join(pieces[j][0] for j in r)
                    out.append((i, names[at], at + 1, n, counter(joined), joined))
            columns = list(zip(*out)) if out else [()] * 6
            taken = pa.array(columns[0], pa.int32())
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), *(pa.array(c, k) for c, k in zip(columns[1:], kinds))],
                names=["key", "title", "section", "page", "position", "tokens", "text"],
            )

    titled = F.col(f"`{title}`") if title else F.lit(None).cast("string")
    cut = df.select(F.col(f"`{key}`").alias("key"), titled.alias("title"), F.col(f"`{text}`").alias("text")).mapInArrow(
        run, f"key {kind}, title string, section string, page int, position int, tokens int, text string"
    )
    named = F.when(F.col("key").isNotNull(), F.concat(F.col("key").cast("string"), F.lit("-chunk-"), F.lpad(F.col("position").cast("string"), 3, "0")))
    long_ = F.when(F.col("position") > 999, F.concat(F.col("key").cast("string"), F.lit("-chunk-"), F.col("position").cast("string"))).otherwise(named)
    return cut.select(long_.alias("chunk_id"), F.col("key").alias(key), "title", "section", "page", "position", "tokens", "text")
