"""Keyed fetching behind a cache: documents and pictures come from a fetch function; what fails becomes a row, not an exception."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Answers worth another try.
RETRY = {403, 429, 500, 502, 503}


class Unavailable(Exception):
    """A source that has no such item, or no access to it."""

    def __init__(self, reason: str, status: int = 0):
        super().__init__(reason)
        self.status = status


def offline(key: str) -> bytes:
    raise Unavailable("no network source configured")


def with_retry(fetch: Callable[[str], bytes], tries: int = 3, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], bytes]:
    """Repeat on the answers worth it, waiting ``wait * 2 ** n`` seconds."""

    def again(key: str) -> bytes:
        for n in range(tries):
            try:
                return fetch(key)
            except Unavailable as e:
                if e.status not in RETRY or n == tries - 1:
                    raise
                sleep(wait * 2**n)
        raise Unavailable("no try left")

    return again


def fetch_all(keys: DataFrame, key: str, fetch: Callable[[str], bytes] = offline) -> DataFrame:
    """(key, content, error) of every distinct key; one of content and error is null. Keys are spread over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            content, error = [], []
            for k in b.column(0).to_pylist():
                try:
                    content.append(fetch(k))
                    error.append(None)
                except Exception as e:  # noqa: BLE001
                    content.append(None)
                    error.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(content, pa.binary()), pa.array(error, pa.string())], names=["key", "content", "error"])

    wanted = keys.select(F.col(key).cast("string").alias("key")).dropna().distinct()
    return wanted.mapInArrow(run, "key string, content binary, error string")


def cached(keys: DataFrame, key: str, cache: DataFrame, fetch: Callable[[str], bytes] = offline) -> tuple[DataFrame, DataFrame]:
    """(rows from the cache and fetched ones, only the fetched): the second is what to append to the cache. Only misses are fetched."""
    wanted = keys.select(F.col(key).cast("string").alias("key")).dropna().distinct()
    hits = cache.select("key", "content").join(wanted, "key", "left_semi").withColumn("error", F.lit(None).cast("string"))
    fresh = fetch_all(wanted.join(cache.select("key"), "key", "left_anti"), "key", fetch)
    return hits.unionByName(fresh), fresh.filter("content is not null")


def same_file(url: Column, stated: Column) -> Column:
    """The file names of a link and of the document agree (extension and case aside): the guard before a picture is taken."""
    stem = lambda c: F.lower(F.regexp_replace(F.substring_index(c, "/", -1), r"\.[A-Za-z0-9]+$", ""))
    return F.coalesce(stem(url) == stem(stated), F.lit(False))
