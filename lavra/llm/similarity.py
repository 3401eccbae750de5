"""Near-duplicate texts: fast similarity sketches, banding, exact verification and classes.

A sketch has a fixed number of bins. In round ``i`` every shingle is thrown into one bin of each sketch with a hash of that
round; in the second half of the rounds round ``t + j`` throws every shingle into bin ``j``, so that after all rounds no bin is
empty. A bin keeps the least (round, hash), hence the bins of two texts agree with the probability of their Jaccard
similarity, concentrated as if drawn independently, and a long text needs only one or two rounds.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.session import durable

WIDTH = 5
LEAST_WORDS = 40
THRESHOLD = 0.6
BANDS, ROWS = 40, 4
_WORD = re.compile(r"\w+")
_MARKS = re.compile("[̀-ͯ]")
_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds) keyed by ``seed``."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Words to the hashes of their form without case and accents; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        plain = "".join(c for c in unicodedata.normalize("NFKD", word.casefold()) if not unicodedata.combining(c))
        h = self[word] = xxhash.xxh3_64_intdigest(plain)
        return h


_words = WordHashes()


def shingle_hashes(text: str | None, least_words: int = LEAST_WORDS, width: int = WIDTH) -> np.ndarray | None:
    """Ascending distinct hashes of the runs of ``width`` words; None for texts with fewer than ``least_words`` words."""
    if not text:
        return None
    if _MARKS.search(text):
        text = _MARKS.sub("", unicodedata.normalize("NFD", text))
    words = _WORD.findall(text)
    if len(words) < max(least_words, width):
        return None
    w = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(w) - width + 1
    runs = w[:n] * _P[0]
    for k in range(1, width):
        runs = _mix(runs, k) + w[k : k + n] * _P[k % len(_P)]
    return np.unique(_mix(runs, width))


def sketch(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``bins`` values for each non-empty set of hashes."""
    out = np.full(len(sets) * bins, _NONE, dtype=np.uint64)
    value = np.zeros(len(sets) * bins, dtype=np.uint64)
    open_ = np.arange(len(sets))
    for i in range(2 * bins):
        if not len(open_):
            break
        x = np.concatenate([sets[k] for k in open_])
        owner = np.repeat(open_, [len(sets[k]) for k in open_])
        h = _mix(x, i + 1)
        at = owner * bins + ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else owner * bins + (i - bins)
        out_round = np.full(len(sets) * bins, _NONE, dtype=np.uint64) if i else out
        np.minimum.at(out_round, at, h)
        fresh = (out_round != _NONE) & (value == 0)
        value[fresh] = _mix(out_round[fresh], i + 1) | np.uint64(1)
        open_ = np.flatnonzero((value.reshape(len(sets), bins) == 0).any(axis=1))
    return value.reshape(len(sets), bins)


def band_hashes(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = values.reshape(len(values), bands, rows)
    h = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(values), axis=0)
    for r in range(rows):
        h = _mix(h * _P[0] + parts[:, :, r], r + 1)
    return h.view(np.int64)


def _sketched(df: DataFrame, key: str, text: str, least_words: int, bands: int, rows: int) -> DataFrame:
    """``key, n`` (distinct shingles), ``digest`` (equal for equal sets) and ``bands`` of every text long enough."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_hashes(x.as_py(), least_words) for x in part.column(1)]
                kept = [i for i, s in enumerate(sets) if s is not None]
                if not kept:
                    continue
                found = [sets[i] for i in kept]
                hashes = band_hashes(sketch(found, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(kept, pa.int32())),
                        pa.array([len(s) for s in found], pa.int32()),
                        pa.array([xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in found], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * bands), pa.array(hashes.ravel())),
                    ],
                    names=["key", "n", "digest", "bands"],
                )

    rows_in = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("key is not null and text is not null")
    return rows_in.mapInArrow(run, f"key {kind}, n int, digest long, bands array<long>")


def _shingle_sets(df: DataFrame, least_words: int) -> DataFrame:
    kind = df.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_hashes(x.as_py(), least_words) for x in part.column("text")]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["key", "shingles"]
                )

    return df.select("key", "text").mapInArrow(run, f"key {kind}, shingles array<long>")


def near_duplicates(
    df: DataFrame, key: str, text: str, *, threshold: float = THRESHOLD, least_words: int = LEAST_WORDS, bands: int = BANDS, rows: int = ROWS
) -> tuple[DataFrame, DataFrame]:
    """(links, members): verified pairs of class representatives, and the representative of every text.

    ``links``: ``a < b, similarity`` for representatives whose sets of word runs have a Jaccard similarity of at least
    ``threshold``. ``members``: ``key, representative``; texts with equal sets (copies, also in other case or accents) share one, so
    a hot group of copies takes part in banding once. Null keys, null texts and texts below ``least_words`` are in neither. A key
    that is repeated with several texts is not expected: keys are unique.

    Banding joins representatives on (band, hash), and the join of a hot band is split by the engine where its partition is skewed; what
    agrees by chance is removed by comparing the whole sets. The sets are made again for candidates only: their keys are
    broadcast as far as their size allows, beyond that the texts meet them in a shuffle.
    """
    sketched = durable(_sketched(df, key, text, least_words, bands, rows))
    copies = sketched.groupBy("digest").agg(F.min("key").alias("representative"))
    members = durable(sketched.select("key", "n", "digest").join(copies, "digest").select("key", "n", "representative"))
    leaders = members.where("key = representative").select("key", "n")
    banded = sketched.join(leaders.select("key"), "key", "left_semi").select("key", F.explode("bands").alias("band"))
    pairs = (
        banded.alias("x")
        .join(banded.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.key") < F.col("y.key")))
        .select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
        .distinct()
    )
    pairs = durable(pairs)
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    texts = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).join(wanted, "key", "left_semi")
    sets = durable(_shingle_sets(texts, least_words))
    shared = F.size(F.array_intersect("sa", "sb"))
    links = (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")
        .select("a", "b", (shared / (F.size("sa") + F.size("sb") - shared)).alias("similarity"))
        .where(F.col("similarity") >= threshold)
    )
    return links, members.select("key", "representative")


def all_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """Every pair of texts behind the links, copies included: ``a < b``."""
    x, y = members.select(F.col("key").alias("ka"), F.col("representative").alias("a")), members.select(F.col("key").alias("kb"), F.col("representative").alias("b"))
    linked = links.select("a", "b").join(x, "a").join(y, "b").select("ka", "kb")
    # copies: only classes of several texts take part in the join on their representative
    several = members.groupBy("representative").count().where("count > 1").select("representative")
    grouped = members.join(several, "representative", "left_semi")
    u, v = grouped.alias("u"), grouped.alias("v")
    copied = u.join(v, (F.col("u.representative") == F.col("v.representative")) & (F.col("u.key") < F.col("v.key"))).select(
        F.col("u.key").alias("ka"), F.col("v.key").alias("kb")
    )
    both = linked.unionAll(copied)
    return both.select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))


def duplicate_classes(links: DataFrame, members: DataFrame) -> DataFrame:
    """``key, cluster_id, links``: one row for each text; ``cluster_id`` is the least key of the class, ``links`` the number of
    representatives that its own representative is linked to."""
    from lavra.operators.components import connected_components

    found = connected_components(links, "a", "b")
    degree = links.select("a").unionAll(links.select(F.col("b").alias("a"))).groupBy("a").agg(F.count(F.lit(1)).alias("links"))
    joined = members.join(found.withColumnRenamed("node", "representative"), "representative", "left").join(
        degree.withColumnRenamed("a", "representative"), "representative", "left"
    )
    return joined.select("key", F.coalesce("component", "representative").alias("cluster_id"), F.coalesce("links", F.lit(0)).alias("links"))
