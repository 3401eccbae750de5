"""Oversized texts cut at natural boundaries, with overlap, by pointer doubling.

Every boundary of a text gets one successor: the farthest, best boundary within reach of a piece that begins with the
overlap before it. All cuts of the text follow from iterating that map, and the iteration is done by squaring: the table of
``2^k``-th successors is its own square root applied twice, so the cuts of a text come out in a logarithmic number of
vector operations, whatever the number of its pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP_LEAST, OVERLAP_MOST = 4000, 100, 400
# Boundaries from the best to the least: before a section's heading, after a paragraph, line, sentence, clause, word.
_LEVELS = (
    re.compile(r"\n(?=[ \t]*(?:\d{1,2}(?:\.\d{1,2})*[.)]?[ \t]+[^\W\d_]|[^\W\d_a-zß-öø-ÿ]{2}[^a-zß-öø-ÿ\n]{2,88}(?:\n|$)))"),
    re.compile(r"\n[ \t\r]*\n\s*"),
    re.compile(r"[.!?…:;][\"”»)\]]*\s+"),
    re.compile(r"\s+"),
)


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a piece may begin or end, ascending, with their level (0 is the best); both ends included."""
    level: dict[int, int] = {}
    for k in range(len(_LEVELS) - 1, -1, -1):
        for m in _LEVELS[k].finditer(text):
            level[m.end()] = k
    level[0] = level[len(text)] = 0
    at = np.array(sorted(level), dtype=np.int64)
    return at, np.array([level[p] for p in at.tolist()], dtype=np.int8)


def _with_fallbacks(text: str, at: np.ndarray, level: np.ndarray, limit: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Adds positions inside stretches without any boundary, so that every piece and every overlap can be formed."""
    gaps = np.flatnonzero(np.diff(at) > (most - least) // 2)
    if not len(gaps):
        return at, level
    step = max(1, (most - least) // 2)
    more = []
    for g in gaps:
        for p in range(int(at[g]) + step, int(at[g + 1]), step):
            for q in range(p, min(p + step // 4, int(at[g + 1]))):
                if not 0x300 <= ord(text[q]) < 0x370:  # not before a combining mark, where there is a place near
                    p = q
                    break
            more.append(p)
    every = np.unique(np.concatenate([at, np.array(more, dtype=np.int64)]))
    levels = np.full(len(every), len(_LEVELS), dtype=np.int8)
    levels[np.searchsorted(every, at)] = level
    return every, levels


def cut_text(text: str, limit: int = LIMIT, least: int = OVERLAP_LEAST, most: int = OVERLAP_MOST) -> list[tuple[int, int]]:
    """Spans of the pieces: each at most ``limit`` long, each later one beginning ``least`` to ``most`` before the last end."""
    size = len(text)
    if size <= limit:
        return [(0, size)]
    if not 0 <= least <= most < limit - most:
        raise ValueError("the overlap does not fit the limit")
    at, level = _with_fallbacks(text, *boundaries(text), limit, least, most)
    n = len(at)
    # where a piece that follows an end begins: the best boundary within the overlap's range, the latest of these
    lo, hi = np.searchsorted(at, at - most), np.searchsorted(at, at - least, side="right")
    begin = np.zeros(n, dtype=np.int64)
    first_of = {k: np.flatnonzero(level == k) for k in range(len(_LEVELS) + 1)}
    done = np.zeros(n, dtype=bool)
    for k, places in first_of.items():
        last = np.searchsorted(places, hi) - 1
        fits = ~done & (last >= 0)
        fits[fits] = places[last[fits]] >= lo[fits]
        begin[fits] = places[last[fits]]
        done |= fits
    begin[~done] = np.maximum(0, hi[~done] - 1)
    begin[0] = 0
    # the farthest legal end of the piece: the best level first, as long as the piece is at least half full
    start = at[begin]
    reach = np.searchsorted(at, start + limit, side="right") - 1
    successor = np.arange(n)
    chosen = reach == n - 1
    successor[chosen] = n - 1
    for k, places in first_of.items():
        last = np.searchsorted(places, reach, side="right") - 1
        fits = ~chosen & (last >= 0)
        fits[fits] = (at[places[last[fits]]] >= start[fits] + limit // 2) & (places[last[fits]] > np.flatnonzero(fits))
        successor[fits] = places[last[fits]]
        chosen |= fits
    successor[~chosen] = np.maximum(reach[~chosen], np.minimum(np.flatnonzero(~chosen) + 1, n - 1))
    # squaring: after each round ``path`` holds twice as many cuts and ``table`` leaps twice as far
    path, table = np.array([successor[0]]), successor
    while path[-1] != n - 1:
        path = np.concatenate([path, table[path]])
        table = table[table]
    ends = np.concatenate([[0], np.unique(path)])
    return [(int(at[begin[e]]), int(at[f])) for e, f in zip(ends[:-1], ends[1:])]


def split_oversized(df: DataFrame, key: str, text: str, kind: str, *, limit: int = LIMIT, least: int = OVERLAP_LEAST, most: int = OVERLAP_MOST) -> DataFrame:
    """Pieces of the texts above ``limit``: ``item_kind, item_key, piece_no, start_pos, n_chars, piece``.

    ``start_pos`` and ``piece_no`` count from 1. Null, empty and fitting texts give no rows. Rows repeated as a whole give
    their pieces once for each repetition; a null key stays null. Long texts are cut whole. The size is tested before any text
    leaves the JVM.
    """
    rows = df.where(F.length(F.col(f"`{text}`")) > limit).select(F.col(f"`{key}`").cast("string").alias("item_key"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text = b.column("text")[i].as_py()
                spans = cut_text(text, limit, least, most)
                if len(spans) < 2:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b.column("item_key")[i].as_py()] * len(spans), pa.string()),
                        pa.array(range(1, len(spans) + 1), pa.int32()),
                        pa.array([s + 1 for s, _ in spans], pa.int32()),
                        pa.array([e - s for s, e in spans], pa.int32()),
                        pa.array([text[s:e] for s, e in spans], pa.string()),
                    ],
                    names=["item_key", "piece_no", "start_pos", "n_chars", "piece"],
                )

    cut = rows.mapInArrow(run, "item_key string, piece_no int, start_pos int, n_chars int, piece string")
    return cut.select(F.lit(kind).alias("item_kind"), "item_key", "piece_no", "start_pos", "n_chars", "piece")
