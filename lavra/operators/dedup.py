"""Deduplication in three levels: exact digest, metadata key, and MinHash bands; then the fold that names the clusters.

A record's cluster depends only on earlier records that share a digest, a key or a band with it. Records are therefore linked
by what they share (each to the least record of the group, never all pairs), and the fold runs in input order inside a
connected component. Exact copies decide nothing but themselves, so only the first of each digest goes into bands and components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import fold, shingles, words
from lavra.operators.components import connected_components
from lavra.session import durable

PERMUTATIONS, WIDTH = 128, 5
#: Bands and rows that balance missed and false candidates at a similarity of 0.85 over 128 permutations.
BANDS, ROWS = 8, 16
_PRIME = np.uint64((1 << 61) - 1)


def text_digest(column) -> object:
    """SHA-256 of the folded text (no case, accents or runs of blanks)."""
    return F.sha2(fold(column), 256)


def keep_first(df: DataFrame, digest: str, order: str) -> DataFrame:
    """``df`` with ``cluster_id``, the least ``order`` of the rows with the same digest; a null digest is a cluster of its own.

    The least row is found by a partial aggregate, so a digest that a third of all rows share is no hot group; the join is
    broadcast or split by the engine as its size asks for.
    """
    firsts = df.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(order).alias("cluster_id"))
    return df.join(firsts, digest, "left").withColumn("cluster_id", F.coalesce("cluster_id", order))


def permutations(seed: int = 1, count: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 31, count, dtype=np.uint64), rng.integers(0, 1 << 61, count, dtype=np.uint64)


def minhash(df: DataFrame, key: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, bands``: one hash for each band of the MinHash signature over runs of five words; blank texts have no row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(count=bands * rows)
        for batch in batches:
            hashes = np.empty((batch.num_rows, bands), np.int64)
            for i, runs in enumerate(batch.column(1).to_pylist()):
                x = np.unique(np.fromiter((xxhash.xxh3_64_intdigest(s) >> 32 for s in runs), dtype=np.uint64, count=len(runs)))
                least = np.full(bands * rows, _PRIME, np.uint64)
                for at in range(0, len(x), 2048):  # bounded memory for very long texts
                    least = np.minimum(least, ((x[at : at + 2048, None] * a + b) % _PRIME).min(axis=0))
                hashes[i] = [xxhash.xxh3_64_intdigest(least[k * rows : (k + 1) * rows].tobytes(), seed=k) - (1 << 63) for k in range(bands)]
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(hashes.ravel()))], names=["key", "bands"])

    cut = df.select(F.col(f"`{key}`").alias("key"), words(F.col(f"`{text}`")).alias("w")).where("size(w) > 0").select("key", shingles(F.col("w"), WIDTH).alias("s"))
    return cut.mapInArrow(run, f"key {kind}, bands array<long>").withColumnRenamed("key", key)


def _to_least(rows: DataFrame, group: list[str]) -> DataFrame:
    """Links from every row of a group to its least one: as many links as rows, whatever the size of the group."""
    least = rows.groupBy(*group).agg(F.min("ord").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(least, group).where("ord <> b").select(F.col("ord").alias("a"), "b")


def leader_clusters(df: DataFrame, key: str, text: str, metadata_key: str, order: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, cluster_id, level``: the sequential clusters of the records in the order of ``order`` (unique, not null).

    A record joins the earliest cluster that its digest, else its metadata key, else one of its bands names; else it leads
    its own. ``level`` is ``digest``, ``key``, ``near`` or null for leaders. Blank and null texts lead clusters of their own and
    register nothing; a blank or null metadata key names nothing. Only leaders are met by their bands.
    """
    base = df.select(F.col(f"`{order}`").alias("ord"), F.col(f"`{key}`").alias("key"), F.col(f"`{metadata_key}`").alias("mkey"), F.col(f"`{text}`").alias("text"))
    base = base.withColumn("digest", F.when(F.trim("text") != "", text_digest(F.col("text"))))
    known = durable(base.select("ord", "key", F.nullif("mkey", F.lit("")).alias("mkey"), "digest"))
    firsts = known.where("digest is not null").groupBy("digest").agg(F.min("ord").alias("first"))
    members = durable(known.join(firsts, "digest", "left"))
    leaders = members.where("ord = first")
    banded = durable(base.join(leaders.select("ord"), "ord", "left_semi").transform(lambda d: minhash(d, "ord", "text", bands, rows)))
    by_band = banded.select("ord", F.posexplode("bands").alias("band", "hash"))
    links = _to_least(by_band, ["band", "hash"]).unionAll(_to_least(leaders.where("mkey is not null").select("ord", "mkey"), ["mkey"]))
    parts = connected_components(durable(links.distinct()), "a", "b")
    inputs = leaders.join(banded, "ord", "left").join(parts.withColumnRenamed("node", "ord"), "ord", "inner")
    kind = df.schema[order].dataType.simpleString()

    def folded(group: pd.DataFrame) -> pd.DataFrame:
        by_key: dict = {}
        by_band: dict = {}
        out = []
        for r in group.sort_values("ord").itertuples():
            met = [by_band[b] for b in enumerate(r.bands if r.bands is not None else ()) if b in by_band]
            if r.mkey is not None and r.mkey in by_key:
                out.append((r.ord, by_key[r.mkey], "key"))
            elif met:
                out.append((r.ord, min(met), "near"))
                if r.mkey is not None:
                    by_key[r.mkey] = min(met)
            else:
                out.append((r.ord, r.ord, None))
                if r.mkey is not None:
                    by_key[r.mkey] = r.ord
                for b in enumerate(r.bands if r.bands is not None else ()):
                    by_band.setdefault(b, r.ord)
        return pd.DataFrame(out, columns=["first", "lead", "how"])

    told = inputs.select("component", "ord", "mkey", "bands").groupBy("component").applyInPandas(folded, f"first {kind}, lead {kind}, how string")
    joined = members.join(told, "first", "left").select(
        "ord", "key", F.coalesce("lead", "first", "ord").alias("lead"), F.when(F.col("first") < F.col("ord"), "digest").otherwise(F.col("how")).alias("level")
    )
    names = known.select(F.col("ord").alias("lead"), F.col("key").alias("cluster_id"))
    return joined.join(names, "lead").select(F.col("key").alias(key), "cluster_id", "level")


def cluster_stats(clusters: DataFrame, key: str) -> DataFrame:
    """One row: records, distinct clusters, and records that another one leads."""
    return clusters.agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("cluster_id").alias("clusters"), F.count_if(F.col("cluster_id") != F.col(key)).alias("duplicates")
    )
