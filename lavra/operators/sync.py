"""Plans of synchronisation between listings: what is uploaded, skipped or a copy of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucket_plan(local: DataFrame, remote: DataFrame, prefix: str = "") -> DataFrame:
    """``path, key, action``: ``skip`` where the remote size is the local one, else ``upload``. Listings have ``path, size`` and ``key, size``."""
    named = local.select("path", "size", F.concat(F.lit(prefix.rstrip("/") + "/" if prefix else ""), "path").alias("key"))
    there = remote.select("key", F.col("size").alias("remote_size"))
    return named.join(there, "key", "left").select("path", "key", F.when(F.col("size").eqNullSafe(F.col("remote_size")) & F.col("size").isNotNull(), "skip").otherwise("upload").alias("action"))


def drive_plan(local: DataFrame, remote: DataFrame) -> DataFrame:
    """``path, action, same_as``: by content first, then by path and size; equal files of one run are uploaded once.

    Listings have ``path, size, hash``. ``skip``: same path with the same content, or the same path and size; ``duplicate``: the content is
    at another path (``same_as``, the least), there or earlier in this run; else ``upload``. A null hash matches nothing.
    """
    by_hash = remote.where("hash is not null").groupBy("hash").agg(F.min("path").alias("there"))
    by_path = remote.groupBy("path").agg(F.max("size").alias("remote_size"), F.max("hash").alias("remote_hash"))
    own = local.where("hash is not null").groupBy("hash").agg(F.min("path").alias("first"))
    joined = local.join(by_hash, "hash", "left").join(by_path, "path", "left").join(own, "hash", "left")
    action = (
        F.when(F.col("remote_hash") == F.col("hash"), "skip")
        .when(F.col("there").isNotNull(), "duplicate")
        .when(F.col("size") == F.col("remote_size"), "skip")
        .when(F.col("first") < F.col("path"), "duplicate")
        .otherwise("upload")
    )
    planned = joined.withColumn("action", action)
    return planned.select("path", "action", F.when(F.col("action") == "duplicate", F.coalesce("there", "first")).alias("same_as"))


def migration_plan(bucket: DataFrame, drive: DataFrame) -> DataFrame:
    """Keys of a bucket (``key, size, hash``) that are to be copied to a drive."""
    return drive_plan(bucket.withColumnRenamed("key", "path"), drive).where("action = 'upload'").select(F.col("path").alias("key"))


def remote_tree(listing: DataFrame) -> DataFrame:
    """``hash, path, size`` of a listing in which files without a SHA-256 are known by ``md5:`` and their MD5."""
    return listing.select(F.coalesce("sha256", F.concat(F.lit("md5:"), "md5")).alias("hash"), "path", "size")
