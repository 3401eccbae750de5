"""Readers of files: export tables, manifests, record folders, lines of JSON, binary files and their texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.scalars import nonblank

CHUNK_SCHEMA = "chunk_id string, bdtd_id string, title string, abstract string, source_url string, section string, text string"


def read_export(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV export with headings (a byte-order mark is dropped), values over several lines and doubled quotes. Raises if a required column is missing."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"columns missing in {path}: {missing}")
    return df


def numbered_export(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """An export with ``csv_row``, contiguous numbers from 2 (the heading is row 1) in file order."""
    df = read_export(spark, path, required)
    schema = T.StructType([T.StructField("csv_row", T.LongType(), False), *df.schema.fields])
    return spark.createDataFrame(df.rdd.zipWithIndex().map(lambda x: (x[1] + 2, *x[0])), schema)  # numbers need the sizes of the partitions before


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The ``records`` of a JSON manifest, one row for each. Raises if there is no such list."""
    df = spark.read.json(path, multiLine=True)
    if "records" not in df.columns or not isinstance(df.schema["records"].dataType, T.ArrayType):
        raise ValueError(f"{path} has no list of records")
    return df.select(F.explode("records").alias("r")).select("r.*")


def read_records(spark: SparkSession, folder: str, schema: str, key: str = "bdtd_id") -> DataFrame:
    """Record files of a folder: broken files and those without a key are left out; of equal keys the last file name wins."""
    fields = T.StructType.fromDDL(schema)
    wanted = T.StructType([*fields.fields, T.StructField("_broken", T.StringType())])
    df = spark.read.schema(wanted).option("columnNameOfCorruptRecord", "_broken").json(folder, multiLine=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    rows = df.withColumn("file", F.col("_metadata.file_path")).where(F.col("_broken").isNull() & nonblank(F.col(key)).isNotNull())
    names = [f.name for f in fields.fields if f.name != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names, "file"), "file").alias("r")).select(key, "r.*")


def read_chunks(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Chunk rows from lines of JSON; blank lines are skipped. A line that is no object, or lacks a chunk id, document or text, raises
    when it is read (``strict``) or is left out."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    rows = raw.select("value", F.from_json("value", CHUNK_SCHEMA, {"mode": "PERMISSIVE"}).alias("r"))
    good = nonblank(F.col("r.chunk_id")).isNotNull() & nonblank(F.col("r.bdtd_id")).isNotNull() & nonblank(F.col("r.text")).isNotNull()
    if not strict:
        return rows.where(good).select("r.*")
    checked = F.when(good, F.col("r")).otherwise(F.raise_error(F.concat(F.lit("invalid chunk: "), F.left("value", F.lit(200)))))
    return rows.select(checked.alias("r")).select("r.*")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size`` of all files below a folder, paths relative to it; contents are not read."""
    root = folder.rstrip("/").removeprefix("file://") + "/"
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    relative = F.substring(F.col("path"), F.instr(F.col("path"), root) + len(root), F.length("path"))
    return df.select(relative.alias("path"), F.col("length").alias("size"))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, content`` of all files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "content")


def extract_texts(files: DataFrame, pages_of: Callable[[bytes], list[str | None]] | None = None, least: int = 50) -> DataFrame:
    """``path, pages, text, valid``: ``pages_of`` gives the pages of a file; a page that fails is empty, pages are joined by an empty line.

    ``valid`` asks for a page and at least ``least`` characters. A file that cannot be read has no pages.
    """
    read = pages_of or _pdf_pages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for r in part.itertuples():
                try:
                    pages = [p or "" for p in read(bytes(r.content))]
                except Exception:  # an unreadable file is a row with no pages
                    pages = []
                text = "\n\n".join(pages)
                out.append((r.path, len(pages), text, bool(pages) and len(text.strip()) >= least))
            yield pd.DataFrame(out, columns=["path", "pages", "text", "valid"])

    return files.select("path", "content").mapInPandas(run, "path string, pages int, text string, valid boolean")


def _pdf_pages(content: bytes) -> list[str]:
    try:
        from io import BytesIO

        from pypdf import PdfReader
    except ImportError as e:
        raise RuntimeError("no library for PDF files is installed; give pages_of") from e
    pages = []
    for page in PdfReader(BytesIO(content)).pages:
        try:
            pages.append(page.extract_text() or "")
        except Exception:  # one broken page does not lose the others
            pages.append("")
    return pages


def wanted_lines(rows: DataFrame, ids: DataFrame, key: str = "chunk_id", per: str = "bdtd_id") -> tuple[DataFrame, DataFrame]:
    """(the rows with wanted ids, the number of all rows for each of their documents)."""
    found = rows.join(ids.select(key).distinct(), key, "left_semi")
    return found, rows.join(found.select(per).distinct(), per, "left_semi").groupBy(per).agg(F.count(F.lit(1)).alias("rows"))


def document_path(root: str, path):
    """Absolute paths as they are, others below ``root``."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))
