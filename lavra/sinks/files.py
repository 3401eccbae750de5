"""Writers. Tables are written by Spark's commit protocol; single files replace their target in one step."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from collections.abc import Iterable
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.scalars import safe_name


def write_atomic(path: str | Path, data: bytes | str) -> None:
    """Writes beside the target, syncs, and replaces the target; a failure leaves the old file."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data.encode() if isinstance(data, str) else data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def write_lines(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Lines of JSON, UTF-8 as it is, keys in order; null fields are left out."""
    df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value")).write.mode(mode).text(folder)


def write_manifest(path: str | Path, manifest: dict) -> None:
    write_atomic(path, json.dumps(manifest, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n")


def write_each(df: DataFrame, folder: str, key: str, column: str, suffix: str) -> None:
    """One file for each row, named by the key made safe; a null value gives no file. The executors write to a folder that they share."""

    def write(rows: Iterable) -> None:
        for r in rows:
            write_atomic(Path(folder) / f"{r['_name']}{suffix}", r["_value"])

    named = df.select(safe_name(F.col(key).cast("string")).alias("_name"), F.col(column).alias("_value")).where("_value is not null")
    named.foreachPartition(write)


def write_partitioned(df: DataFrame, folder: str, by: str, mode: str = "overwrite") -> None:
    """One Parquet dataset with a folder for each value of ``by``: what per-record files are at scale."""
    df.write.mode(mode).partitionBy(by).parquet(folder)


def save_document(root: str | Path, key: str, content: bytes, content_type: str, disposition: str | None = None) -> dict:
    """Writes a PDF payload and gives its descriptor. Raises for a payload that is no whole PDF."""
    if content_type.split(";")[0].strip().lower() != "application/pdf" or not content.startswith(b"%PDF-") or b"%%EOF" not in content[-1024:]:
        raise ValueError(f"{key}: the payload is no PDF")
    name = f"{key}.pdf"
    for part in (disposition or "").split(";"):
        field, _, value = part.strip().partition("=")
        if field.lower() in ("filename", "filename*"):
            name = unquote(value.strip('"').rpartition("''")[2]) or name
    safe = "".join(c if c.isalnum() and c.isascii() or c in "._-" else "_" for c in name).strip("._") or "document.pdf"
    path = Path(root) / key / safe
    write_atomic(path, content)
    return {"path": str(path), "original_filename": name, "byte_count": len(content), "sha256": hashlib.sha256(content).hexdigest(), "content_type": "application/pdf", "pdf_valid": True}


def write_index(entries: DataFrame, folder: str, digest: str, dimensions: int, counts: dict[str, int]) -> None:
    """Entries in Parquet with a manifest of two phases: ``building`` before, ``complete`` after. Raises if the index exists."""
    manifest = Path(folder) / "manifest.json"
    if manifest.exists():
        raise FileExistsError(folder)
    told = {"digest": digest, "dimensions": dimensions, "counts": counts}
    write_manifest(manifest, {**told, "status": "building"})
    entries.write.mode("overwrite").parquet(f"{folder}/entries")
    write_manifest(manifest, {**told, "status": "complete"})


def append_answers(df: DataFrame, folder: str) -> None:
    write_lines(df, folder, "append")


def upload(df: DataFrame, put, attempts: int = 2, sleep=None) -> DataFrame:
    """``path, status``: ``put(path)`` is tried ``attempts`` times for each planned upload, with waits that double."""
    import time

    import pandas as pd

    def run(batches):
        for part in batches:
            out = []
            for path in part["path"]:
                status = "failed"
                for n in range(attempts):
                    try:
                        put(path)
                        status = "uploaded"
                        break
                    except OSError:
                        (sleep or time.sleep)(2.0**n)
                out.append((path, status))
            yield pd.DataFrame(out, columns=["path", "status"])

    return df.where("action = 'upload'").select("path").mapInPandas(run, "path string, status string")
