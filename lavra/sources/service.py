"""A paged search service with look-ups by key, as a Spark data source; the transport is a replaceable function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.scalars import retry_after

Fetch = Callable[[str, dict], tuple[int, dict, dict]]
RETRIES, SPACING, KEYS_PER_REQUEST = 3, 0.5, 25


class ServiceError(RuntimeError):
    def __init__(self, status: int | None, message: str):
        super().__init__(message)
        self.status = status


class Client:
    """Calls ``fetch(path, parameters) -> (status, headers, body)`` with spacing, retries and waits.

    Statuses 429 and from 500 on are tried again, after the Retry-After header or twice as long each time; other statuses from 400 on raise.
    """

    def __init__(self, fetch: Fetch, retries: int = RETRIES, spacing: float = SPACING, sleep: Callable[[float], None] = time.sleep):
        self.fetch, self.retries, self.spacing, self.sleep = fetch, retries, spacing, sleep

    def get(self, path: str, parameters: dict) -> dict:
        for attempt in range(self.retries + 1):
            self.sleep(self.spacing)
            status, headers, body = self.fetch(path, parameters)
            if status < 400:
                return body
            if (status != 429 and status < 500) or attempt == self.retries:
                raise ServiceError(status, f"{path} answered {status}")
            wait = retry_after(headers.get("Retry-After"))
            self.sleep(wait if wait is not None else 2.0**attempt)
        raise ServiceError(None, "not reached")


def search_pages(client: Client, terms: list[str], limit: int, target: int | None = None, max_pages: int | None = None) -> Iterator[tuple[int, list[dict]]]:
    """(page, records) until the target is met, a page is empty or short, or a page repeats an earlier one."""
    seen, found, page = set(), 0, 1
    while max_pages is None or page <= max_pages:
        body = client.get("search", {"lookfor": " OR ".join(terms), "type": "AllFields", "sort": "year", "page": page, "limit": limit})
        records = body.get("records") or []
        fingerprint = tuple(sorted(str(r.get("id")) for r in records))
        if not records or fingerprint in seen:
            return
        seen.add(fingerprint)
        found += len(records)
        yield page, records
        if len(records) < limit or (target is not None and found >= target):
            return
        page += 1


def look_up(client: Client, ids: list[str]) -> dict[str, dict]:
    """Details by id; a request that is refused as too long (400, 414), and ids that it leaves out, are asked for one by one."""
    out: dict[str, dict] = {}
    try:
        for r in client.get("record", {"id[]": ids}).get("records") or []:
            if r.get("id") in ids:
                out[r["id"]] = r
    except ServiceError as e:
        if e.status not in (400, 414):
            raise
    if len(ids) > 1:
        for i in ids:
            if i not in out:
                try:
                    out.update(look_up(client, [i]))
                except ServiceError:
                    pass
    return out


def attach(ids: DataFrame, key: str, make_client: Callable[[], Client], per_request: int = KEYS_PER_REQUEST) -> DataFrame:
    """``key, details, error``: details as JSON for each distinct id, asked for in batches by the executors."""
    import json

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for part in batches:
            wanted = part[key].dropna().tolist()
            for at in range(0, len(wanted), per_request):
                asked, error = wanted[at : at + per_request], None
                try:
                    got = look_up(client, asked)
                except ServiceError as e:
                    got, error = {}, str(e)
                rows = [(i, json.dumps(got[i], ensure_ascii=False) if i in got else None, None if i in got else error or "not_returned") for i in asked]
                yield pd.DataFrame(rows, columns=[key, "details", "error"])

    return ids.select(key).distinct().mapInPandas(run, f"{key} string, details string, error string")


def saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page, ids``: saved search pages (``search-page-N.json``), for work without a network."""
    df = spark.read.json(path, multiLine=True).withColumn("file", F.col("_metadata.file_name"))
    return df.select(F.regexp_extract("file", r"([0-9]+)\.json$", 1).cast("int").alias("page"), F.transform("records", lambda r: r["id"]).alias("ids"))
