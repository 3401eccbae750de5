"""Filling containers of fixed capacity by minimum bin slack over the histogram of item sizes.

Items of equal size are interchangeable, so the search needs only how many items of each size there are: at most
``capacity`` numbers, whatever the corpus holds. For each kind of container a subset-sum over a bitset finds the fullest
feasible combination around the largest item left; that combination is then used as often as the counts allow, which
exhausts at least one size. The corpus itself is only numbered within its sizes and looks its place up in the plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lavra.session import durable

#: Items of one size that one task numbers at most; larger groups are divided by a hash.
GROUP_ROWS = 200_000


def fullest(counts: dict[int, int], space: int) -> dict[int, int]:
    """The combination of available sizes with the largest sum up to ``space``: size to number used."""
    if space <= 0:
        return {}
    mask, reach = (1 << (space + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for size in sorted((s for s in counts if s <= space), reverse=True):
        left, lot = min(counts[size], space // size), 1
        while left > 0 and not reach >> space & 1:
            lot = min(lot, left)
            steps.append((reach, size, lot))
            reach |= reach << (size * lot) & mask
            left -= lot
            lot *= 2
        if reach >> space & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for before, size, lot in reversed(steps):
        if not before >> at & 1:
            at -= size * lot
            used[size] = used.get(size, 0) + lot
    return used


def plan_containers(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Kinds of containers as (how many, size to number in each); every item of the histogram is placed once."""
    counts = {s: n for s, n in histogram.items() if n > 0}
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError("a size is outside 1..capacity")
    plan = []
    while counts:
        first = max(counts)
        rest = {s: n for s, n in counts.items()}
        rest[first] -= 1
        if not rest[first]:
            del rest[first]
        used = fullest(rest, capacity - first)
        used[first] = used.get(first, 0) + 1
        times = min(counts[s] // n for s, n in used.items())
        plan.append((times, used))
        for s, n in used.items():
            counts[s] -= n * times
            if not counts[s]:
                del counts[s]
    return plan


def _lookup(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (size, first index, first container, items of the size in each, first position), by size and index."""
    rows, container, taken = [], 1, {}
    for times, used in plan:
        position = 1
        for size in sorted(used, reverse=True):
            rows.append((size, taken.get(size, 0), container, used[size], position))
            taken[size] = taken.get(size, 0) + used[size] * times
            position += used[size]
        container += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def fill_containers(items: DataFrame, key: str, size: str, capacity: int, *, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Container, position, ``key``, piece number and size of every piece.

    ``items`` has an integer size for each row. Sizes above ``capacity`` are divided into pieces of ``capacity`` and one
    remainder; no other item is divided. Null sizes and sizes below 1 need no space and are left out; repeated rows are
    items of their own; an empty table gives an empty result. Columns: ``container`` long from 1, ``position`` int
    from 1, ``key``, ``piece_no`` int from 1, ``tokens`` int. Other columns of ``items`` are not read.

    The driver holds the histogram (at most ``capacity`` rows) and the plan (at most one kind of container for each size).
    """
    pieces = (
        items.where(F.col(size) > 0)
        .select(F.col(key).alias("_key"), F.col(size).cast("long").alias("_size"))
        .withColumn("piece_no", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_size") / F.lit(capacity)).cast("int"))))
        .withColumn("tokens", F.least(F.lit(capacity), F.col("_size") - (F.col("piece_no") - 1) * F.lit(capacity)).cast("int"))
        .select("_key", "piece_no", "tokens")
    )
    histogram = {r["tokens"]: r["count"] for r in pieces.groupBy("tokens").count().collect()}
    lookup = _lookup(plan_containers(histogram, capacity))
    salts = max(1, -(-max(histogram.values(), default=1) // group_rows))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("_key", "piece_no"), F.lit(salts)))
    group = Window.partitionBy("tokens", "_salt").orderBy("_key", "piece_no")
    numbered = salted.withColumn("_index", F.row_number().over(group).cast("long") - 1)
    if salts > 1:
        before = Window.partitionBy("tokens").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
        offsets = salted.groupBy("tokens", "_salt").agg(F.count(F.lit(1)).alias("_n"))
        offsets = offsets.select("tokens", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
        numbered = numbered.join(offsets, ["tokens", "_salt"]).withColumn("_index", F.col("_index") + F.col("_offset"))
    kind = items.schema[key].dataType.simpleString()
    shift = 1 << 44
    starts = lookup[:, 0] * shift + lookup[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, index = b.column("tokens").to_numpy().astype(np.int64), b.column("_index").to_numpy()
            row = lookup[np.searchsorted(starts, tokens * shift + index, side="right") - 1]
            at = index - row[:, 1]
            container, position = row[:, 2] + at // row[:, 3], row[:, 4] + at % row[:, 3]
            yield pa.RecordBatch.from_arrays(
                [pa.array(container), pa.array(position.astype(np.int32)), b.column("_key"), b.column("piece_no"), b.column("tokens")],
                names=["container", "position", "_key", "piece_no", "tokens"],
            )

    placed = numbered.select("_key", "piece_no", "tokens", "_index").mapInArrow(
        place, f"container long, position int, _key {kind}, piece_no int, tokens int"
    )
    return placed.withColumnRenamed("_key", key)


def pack_texts(df: DataFrame, key: str, text: str, capacity: int = 2048, *, vocabulary: str | None = None) -> DataFrame:
    """Texts packed by their size in tokens; the sizes are written once and read for the plan and for the placing."""
    from lavra.llm.bpe import token_counts

    return fill_containers(durable(token_counts(df, key, text, vocabulary=vocabulary)), key, "tokens", capacity)
