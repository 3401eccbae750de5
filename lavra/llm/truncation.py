"""Texts cut off by a field limit or in transfer: a structural completeness check.

A stack automaton reads each text for quotes, brackets and markup left open; the end of the text is tested for broken
characters, entities, tags and escapes, marks of omission, and for a terminator. Ends that need none (headings, titles,
keyword lists, places with a year, addresses, tables, page ends) are complete. Whether dots close a whole sentence or
stand for what was cut is decided by the corpus: dots close a sentence if its last two words mostly end sentences where they stand elsewhere.
A missing terminator counts only in sources whose texts usually have one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.session import durable

#: Share of the places of two words that must be ends of sentences before dots after them count as the end of a sentence.
ENDING_SHARE = 0.5
#: Share of a source's texts without terminator above which the lack of one says nothing.
USUAL_SHARE = 0.6

_PAIRS = {"“": "”", "«": "»", "(": ")", "[": "]", "{": "}"}
_MARKS = re.compile(r"[“”«»()\[\]{}]|\n\s*\n|(?<![^\s(\[{“«–—-])\"(?=\S)|(?<=\S)\"(?![^\s.,;:!?)\]}”»–—-])|(?<!<)<(/?)(i|b|u|em|strong|sup|sub|span|a|div|table|tr|td|ul|ol|h[1-6]|small|cite|blockquote|font|center)(?:\s[^<>\n]{0,80})?(/?)>(?!>)", re.I)
_CLOSED = re.compile(r"[.!?][\"”»’')\]]*$|[\"”»’')\]][.!?]$")
_BROKEN = re.compile(r"(?:�|<(?:/?[a-z][^<>\n]{0,60})?|&(?:#\d{0,6}|#x[0-9a-f]{0,5}|[a-z]{1,8})|\\(?:u[0-9a-f]{0,3}|x[0-9a-f]?)?|%[0-9a-f]?(?<=\w%[0-9a-f]))$", re.I)
_TAG_END = re.compile(r"[^\s.!?>]</?[a-z]+>?$", re.I)
_DOTS = re.compile(r"\.\.\.+[\"”»)]*$")
_OMITTED = re.compile(r"(?:[\[(]\s*(?:\.\.\.|…)\s*[\])]|…[\"”»)]*)$")
_PAGE = re.compile(r"^\W*(?:(?:p|pp|pág|pag|página|page|pagina|f|fl)\b\.?\s*)?(?:\d{1,4}|[ivxlc]{1,7})(?:\s*(?:de|of|/|sur)\s*\d{1,4})?\W*$", re.I)
_PLACE = re.compile(r"^[^\W\d_][^\n.!?]{1,60}, (?:1[5-9]|20)\d\d\.?$")
_ADDRESS = re.compile(r"(?:https?://|www\.|doi:|hdl:|ark:)\S+$|\S+@\S+\.\w+$", re.I)
_LIST = re.compile(r"[^\W\d_]{4,}\s?:\s*[^\W\d_][^:.;,]{0,60}(?:[.;,]\s+[^:.;,]{2,60})+[.;,]?$")
_NUMBERED = re.compile(r"^(?:\d{1,2}(?:\.\d{1,2})*|[IVX]{1,5})[.)]?\s+[^\W\d_]")
_SENTENCE = re.compile(r"[.!?]\s")
# Words that no sentence, title or heading ends in.
_INSIDE = re.compile(
    r"(?:,|\b(?:de|da|do|das|dos|e|em|na|no|nas|nos|um|uma|ao|à|com|para|por|pela|pelo|que|the|of|and|an|in|on|with|by|to|our|each|another|el|los|las|del|y|en|una|con|nuestro|nuestra|le|les|des|du|et|dans|une|avec|notre|chaque))$", re.I
)


def open_marks(text: str) -> int:
    """The stack automaton: how many quotes and brackets of the last paragraph, and elements of the whole text, are open at its end.

    Straight quotes open after a blank and close before one; a closing mark ends what was opened inside it and never closed.
    Only elements of running text count, so that placeholders and control strings are none; a paragraph's end closes quotes and
    brackets, not elements.
    """
    stack: list[str] = []
    for m in _MARKS.finditer(text):
        mark = m[0]
        if m[2]:
            name = m[2].lower()
            if m[3]:
                continue
            mark = f"</{name}>"
            if not m[1]:
                stack.append(mark)
                continue
        elif mark in _PAIRS:
            stack.append(_PAIRS[mark])
            continue
        elif mark == '"' and '"' not in stack:
            if m.end() < len(text) and not text[m.end()].isspace() and (m.start() == 0 or not text[m.start() - 1].isalnum()):
                stack.append('"')
            continue
        elif mark[0] == "\n":
            stack = [x for x in stack if x[0] == "<"]
            continue
        if mark in stack:
            while stack.pop() != mark:
                pass
    return len(stack)


def ending(text: str | None, title: str | None = None) -> tuple[str, str | None]:
    """How a text ends, and for ends in dots its last two words.

    ``blank``, ``complete`` and ``furniture`` are whole; ``broken``, ``omitted``, ``open`` and ``inside`` (after a word that ends nothing) are
    cut; ``dots`` and ``bare`` (no terminator) are for the corpus to decide.
    """
    if text is None or not text.strip():
        return "blank", None
    if text.rstrip(" \t\r\n").endswith("\x0c"):
        return "furniture", None
    end = text.rstrip()
    if _BROKEN.search(end[-70:]) or _TAG_END.search(end[-40:]):
        return "broken", None
    if _OMITTED.search(end[-12:]):
        return "omitted", None
    last = end[end.rfind("\n") + 1 :].strip()
    several = "\n" in end
    if several and (_PAGE.match(last) or last.count("\t") or not re.search(r"[^\W\d_]{3}", last)):
        return "furniture", None
    if _DOTS.search(end[-6:]):
        words = end[-200:].rstrip('."”»)').split()[-2:]
        if end.rstrip('."”»').endswith(")"):
            return "complete", None
        if len(words) < 2 or words[0][-1] in ",;:.!?)":  # a clause of one word
            return "omitted", None
        return "dots", " ".join(words).lower()
    if _CLOSED.search(end[-6:]):
        return ("open" if open_marks(end) else "complete"), None
    if _ADDRESS.search(last) or _PLACE.match(last):
        return "furniture", None
    if title and last.casefold() == title.strip().casefold():
        return "furniture", None
    if not several and len(end) <= 160 and not _SENTENCE.search(end) and not open_marks(end):
        return "furniture", None
    letters = [c for c in last if c.isalpha()]
    heading = letters and len(last) <= 90 and (all(c.isupper() for c in letters) or _NUMBERED.match(last))
    before = end[: len(end) - len(last)].rstrip()
    if several and heading and (not before or not before[-1].isalnum() or end[len(before) :].count("\n") > 1):
        return "furniture", None
    paragraph = end[max(end.rfind("\n\n"), end.rfind("\r\n\r\n"), len(end) - 400) :].strip()
    if _LIST.search(" ".join(paragraph.split())) and not _CLOSED.search(paragraph):
        return "furniture", None
    return ("inside" if _INSIDE.search(last) else "bare"), None


def assess_endings(df: DataFrame, key: str, text: str, source: str, title: str | None = None) -> DataFrame:
    """``key, source, ending, cut`` of every row of ``df``.

    Null, empty and blank texts are ``blank`` and not cut. A null source counts as a source of its own. Repeated rows stay
    repeated; very long texts are read whole; an empty table gives an empty result; other columns are not read.
    """
    kind = df.schema[key].dataType.simpleString()
    titled = F.col(f"`{title}`") if title else F.lit(None).cast("string")
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("text"), titled.alias("title"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [ending(x.as_py(), y.as_py()) for x, y in zip(b.column("text"), b.column("title"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("source"), pa.array([e for e, _ in found], pa.string()), pa.array([w for _, w in found], pa.string())],
                names=["key", "source", "ending", "words"],
            )

    ends = durable(rows.mapInArrow(run, f"key {kind}, source string, ending string, words string"))
    # all places of the pairs of words that some text's dots ask for, in the whole corpus; at most one pair for each text that ends in dots
    spaced = rows.where("text is not null").select(F.split(F.lower("text"), r"\s+").alias("w"))
    places = spaced.select(F.explode(F.expr("transform(slice(w, 2, size(w)), (x, i) -> struct(w[i] as first, x as second))")).alias("p")).select("p.*")
    places = places.where(~F.col("second").rlike(r"\.\.\.")).select(
        F.concat_ws(" ", "first", F.regexp_replace("second", r"[.,;:!?]+$", "")).alias("words"), F.col("second").rlike(r"(?<![.])[.!?]$").alias("ends")
    )
    asked = F.broadcast(ends.where("words is not null").select("words").distinct())
    known = places.join(asked, "words", "left_semi").groupBy("words").agg((F.count_if("ends") / F.count(F.lit(1))).alias("share"))
    usual = ends.groupBy("source").agg(F.try_divide(F.count_if(F.col("ending") == "bare"), F.count_if(F.col("ending") != "blank")).alias("bare_share"))
    cut = (
        F.col("ending").isin("broken", "omitted", "open", "inside")
        | ((F.col("ending") == "dots") & (F.coalesce(F.col("share"), F.lit(0.0)) < ENDING_SHARE))
        | ((F.col("ending") == "bare") & (F.coalesce(F.col("bare_share"), F.lit(0.0)) <= USUAL_SHARE))
    )
    # few rows end in dots: the others do not meet in the partition of the null key
    dotted = ends.where("words is not null").join(known, "words", "left")
    every = dotted.unionByName(ends.where("words is null").withColumn("share", F.lit(None).cast("double")))
    judged = every.join(usual.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
    return judged.select(F.col("key").alias(key), "source", "ending", cut.alias("cut"))


def truncation_by_source(assessed: DataFrame) -> DataFrame:
    """Texts, cut texts and the share of cut texts for each source."""
    return assessed.groupBy("source").agg(
        F.count(F.lit(1)).alias("texts"), F.count_if("cut").alias("cut_texts"), F.round(F.count_if("cut") / F.count(F.lit(1)), 6).alias("cut_share")
    )
